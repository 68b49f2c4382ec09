"""Byte repeats by a suffix sort whose comparisons are hash look-ups."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.keys import keyed, restored
from sitelens.llm.repeats import Blocks, Method, covered, runs, spans
from sitelens.llm.text import BYTES, U64, Powers, cuts, flat, mix, within

LENGTH, GRAM = 100, 32
PIECE = 1 << 20
POSITION = U64((1 << 21) - 1)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def piece_blocks(data: np.ndarray, offsets: np.ndarray) -> Blocks | None:
    """Blocks of rows that together have about one piece of bytes; rows count from 0."""
    n = len(data)
    lengths = np.diff(offsets)
    if n < LENGTH or not (lengths >= LENGTH).any():
        return None
    prefix = BYTES.prefix(BYTES.of_byte[data])
    grams = mix((prefix[GRAM:] - prefix[:-GRAM]) * BYTES.down[: n - GRAM + 1])
    ranked = (grams & ~POSITION) | np.arange(len(grams)).astype(U64)
    anchor_at = (sliding_min(ranked, LENGTH - GRAM + 1) & POSITION).astype(np.int64)
    steps = np.zeros(n + 1, np.int64)
    long = lengths >= LENGTH
    np.add.at(steps, offsets[:-1][long], 1)
    np.add.at(steps, offsets[1:][long] - LENGTH + 1, -1)
    valid = np.cumsum(steps[: len(anchor_at)]) > 0
    start, count = runs(valid, anchor_at)
    at = anchor_at[start]
    digest = mix(BYTES.part(prefix, start, start + count + (LENGTH - 1)) + ((at - start) * 128 + count).astype(U64))
    row = np.searchsorted(offsets, start, "right") - 1
    return Blocks(row, start - offsets[row], count, at - start, grams[at], digest)


def blocks(column: pa.Array) -> Iterator[Blocks]:
    offsets, data = flat(column)
    for a, b in cuts(offsets, PIECE):
        lo, hi = int(offsets[a]), int(offsets[b])
        if b - a > 1 or hi - lo <= PIECE:
            found = piece_blocks(data[lo:hi], offsets[a : b + 1] - lo)
            if found:
                found.row += a
                yield found
            continue
        for at in range(lo, hi, PIECE):  # one long text: windows by where they start
            end = min(hi, at + PIECE + LENGTH - 1)
            found = piece_blocks(data[at:end], np.array([0, end - at]))
            if found:
                found.row += a
                found.start += at - lo
                yield found


def parts(text: bytes, wanted: list[tuple[int, int]]) -> list[bytes]:
    return [text[s : s + n + LENGTH - 1] for s, n in wanted]


class Suffixes:
    """Suffixes of one byte string, compared on their first ``LENGTH`` bytes through prefix hashes."""

    def __init__(self, data: np.ndarray, hashes: Powers):
        self.data, self.hashes = data, hashes
        self.prefix = hashes.prefix(hashes.of_byte[data])

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Length of the common extension, up to ``LENGTH``, by binary search over hashes."""
        same, step = np.zeros(len(p), np.int64), 1 << (LENGTH.bit_length() - 1)
        while step:
            ahead = same + step
            fits = ahead <= LENGTH
            ahead = np.where(fits, ahead, same)
            equal = self.hashes.part(self.prefix, p + same, p + ahead) == self.hashes.part(self.prefix, q + same, q + ahead)
            same = np.where(equal & fits, ahead, same)
            step >>= 1
        return same

    def order(self, at: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stable merge sort of suffixes ``at`` inside each of the adjacent buckets.

        All buckets are merged at once, run by run of doubling width.  An element's place in a
        merge is found by binary search in the neighbouring run; each comparison takes a
        common extension and the byte behind it.  Also gives, for each place, whether the
        suffix equals the one before it in its bucket.
        """
        n = len(at)
        first = np.concatenate(([True], bucket[1:] != bucket[:-1])) if n else np.zeros(0, bool)
        head = np.flatnonzero(first)
        size = np.diff(np.append(head, n))
        base, size_of = np.repeat(head, size), np.repeat(size, size)
        local = np.arange(n) - base
        at, which, width = at.copy(), np.arange(n), 1
        while (size > width).any():
            run_at = local // width
            other = (run_at ^ 1) * width
            active = np.flatnonzero((size_of > width) & (other < size_of))
            low = other[active] + base[active]
            top = np.minimum(other[active] + width, size_of[active]) + base[active]
            begin, mine, right = low.copy(), at[active], (run_at[active] & 1) == 1
            todo = np.flatnonzero(low < top)
            while len(todo):
                mid = (low[todo] + top[todo]) >> 1
                p, q = mine[todo], at[mid]
                same = self.common(p, q)
                ends = same == LENGTH
                step = np.minimum(same, LENGTH - 1)
                greater = np.where(ends, right[todo], self.data[q + step] < self.data[p + step])
                low[todo[greater]] = mid[greater] + 1
                top[todo[~greater]] = mid[~greater]
                todo = todo[low[todo] < top[todo]]
            place = np.arange(n)
            pair = (run_at[active] // 2) * 2 * width
            place[active] = base[active] + pair + local[active] - run_at[active] * width + (low - begin)
            moved, moved_which = np.empty_like(at), np.empty_like(which)
            moved[place], moved_which[place] = at, which
            at, which, width = moved, moved_which, 2 * width
        equal = np.zeros(n, bool)
        if n:
            later = np.flatnonzero(~first)
            equal[later] = self.common(at[later - 1], at[later]) == LENGTH
        return which, equal

    def verified(self, p: np.ndarray, q: np.ndarray) -> bool:
        """Whether suffixes found equal by hash are equal byte by byte."""
        reach = np.arange(LENGTH)
        return all(
            (self.data[p[i : i + 8192, None] + reach] == self.data[q[i : i + 8192, None] + reach]).all()
            for i in range(0, len(p), 8192)
        )


def repeated(texts: list[bytes], group: np.ndarray, key: np.ndarray, start: np.ndarray, n: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """For every window of blocks in order of (group, key, start): is an equal one before it?

    Windows meet in buckets of one anchor and distance to it, in order of document and place;
    the suffix sort is stable, so the first of equal neighbours is the earliest.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    base = np.concatenate(([0], np.cumsum([len(t) for t in texts])))[:-1]
    block = np.repeat(np.arange(len(texts)), n)
    j = within(n)
    at = base[block] + j
    bucket = group[block] * 256 + lead[block] - j + 128
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    alone = np.ones(len(b), bool)
    alone[1:] &= b[1:] != b[:-1]
    alone[:-1] &= b[1:] != b[:-1]
    order = order[~alone]
    out = np.zeros(len(at), bool)
    seed = 23
    while len(order):
        suffixes = Suffixes(data, Powers(seed) if seed != 23 else BYTES)
        which, equal = suffixes.order(at[order], bucket[order])
        later = np.flatnonzero(equal)
        ranked = order[which]
        if suffixes.verified(at[ranked[later - 1]], at[ranked[later]]):
            out[ranked[later]] = True
            break
        seed += 1  # a collision: sort again under another base
    return out


METHOD = Method(blocks, parts, repeated, strict=False)
ROWS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def judged(docs: DataFrame) -> DataFrame:
    """``keyed`` documents with the repeated ranges of their bytes."""
    return covered(docs, METHOD)


def kept_bytes(text: bytes, repeats: pa.Scalar) -> tuple[bytes, int, int]:
    """What is left, how many bytes went, in how many runs."""
    start, end = spans(repeats, LENGTH, len(text))
    if not len(start):
        return text, 0, 0
    left = b"".join(text[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(text)]))
    return left, len(text) - len(left), len(start)


def texts_of(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    offsets, data = flat(batch.column("text"))
    for i in range(batch.num_rows):
        yield i, data[offsets[i] : offsets[i + 1]].tobytes()


def byte_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, after removing repeats.

    A byte goes if it lies in a 100-byte string that also starts earlier: in a document before
    it by (doc_id, nulls first; text), or earlier in the same text.  Null texts are empty;
    texts under 100 bytes and an empty table lose nothing; rows that repeat a doc_id count as
    documents of their own.  Only anchors (one of about 35 bytes) are shuffled, not suffixes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeats, ids = batch.column("repeats"), batch.column("doc_id")
            rows = []
            for i, text in texts_of(batch):
                left, removed, n = kept_bytes(text, repeats[i])
                rows.append((len(text), removed, n, hashlib.sha256(left).hexdigest()))
            columns = [pa.array(x, t) for x, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()])]
            if rows:
                yield pa.RecordBatch.from_arrays([ids, *columns], [c.split()[0] for c in ROWS.split(", ")])

    return judged(keyed(docs)).select("doc_id", "text", "repeats").mapInArrow(run, ROWS)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``, other columns as they were.

    A character that loses some of its bytes goes as a whole; ``n_chars``, if there is such a
    column, counts what is left; null texts stay null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeats = batch.column("repeats")
            left = [kept_bytes(text, repeats[i])[0].decode("utf-8", "ignore") for i, text in texts_of(batch)]
            null = batch.column("text").is_null().to_pylist()
            text = pa.array([None if x else t for x, t in zip(null, left)], pa.string())
            yield pa.RecordBatch.from_arrays([text, batch.column("_row")], ["text", "_row"])

    # doc_id is read although it is in _row: ``covered`` then exchanges the texts once for both its joins
    rows = judged(keyed(docs, carry=True)).select("doc_id", "text", "repeats", "_row")
    schema = rows.select("text", "_row").schema
    out = restored(rows.mapInArrow(run, schema), docs.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out
