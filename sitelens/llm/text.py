"""Arrow text columns as flat byte arrays: words, hashes and document spans without Python strings.

Everything here works on one Arrow batch inside a task.  Words are maximal runs of bytes
outside ``[\\x20\\x09-\\x0D]``; in UTF-8 that is the same as on code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer on 64-bit integers (splitmix64)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64, one more than rows) and UTF-8 bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return off - off[0], raw[off[0] : off[-1]]


def cuts(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer row is a range of its own."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b
        a = b


class Powers:
    """Prefix hashes of a sequence modulo 2**64: the hash of any part costs two look-ups."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        base = int(rng.integers(1 << 62, dtype=np.int64)) * 8 + 5
        self.base, self.inverse = U64(base % (1 << 64)), U64(pow(base, -1, 1 << 64))
        self.of_byte = rng.integers(0, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
        self.up, self.down = np.ones(1, U64), np.ones(1, U64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, base, U64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, U64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def part(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self.down[start]


BYTES = Powers(11)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the row offsets counted in words."""
    solid = ~SPACE[data]
    before, after = np.empty_like(solid), np.empty_like(solid)
    if len(data):
        before[0], before[1:] = False, solid[:-1]
        after[-1], after[:-1] = False, solid[1:]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        before[edges] = False
        after[edges[edges > 0] - 1] = False
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """The words at the spans that ``word_spans`` found."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[~SPACE[data]])])


def word_ids(words: pa.LargeBinaryArray) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """An integer per word, equal for equal bytes and only for them, and the distinct words."""
    encoded = words.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The XXH3 hash of every word, taken once per distinct word."""
    ids, distinct = word_ids(word_array(data, starts, ends))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.to_pylist()), U64, len(distinct))[ids]


def hashed_words(column: pa.Array, most: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Of row ranges: first row, last row + 1, word hashes, row offsets counted in words."""
    offsets, data = flat(column)
    for a, b in cuts(offsets, most):
        own = offsets[a : b + 1] - offsets[a]
        part = data[offsets[a] : offsets[b]]
        starts, ends, rows = word_spans(part, own)
        yield a, b, word_hashes(part, starts, ends), rows


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """The row of each item."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each of the groups of these sizes."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
