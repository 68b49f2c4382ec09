"""Repeated word sequences by recompression: rounds that name runs and pairs alike everywhere."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sitelens.llm.keys import keyed
from sitelens.llm.repeats import Blocks, Method, covered, runs, spans
from sitelens.llm.suffix import texts_of
from sitelens.llm.text import U64, Powers, cuts, flat, mix, rows_of, within, word_array, word_hashes, word_ids, word_spans

WINDOW = 13
HALF = WINDOW // 2 + 1
ROUNDS = 2
PIECE = 1 << 20
WORDS = Powers(31)
_TAG = np.array([0xC2B2AE3D27D4EB4F * (2 * i + 1) % (1 << 64) for i in range(2 * ROUNDS + 2)], U64)


def run_round(sym: np.ndarray, row: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Names after every run of one symbol became a symbol of its own; the new index of each old one."""
    new = np.ones(len(sym), bool)
    new[1:] = (sym[1:] != sym[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(sym)))
    name = np.where(size > 1, mix(sym[first] + size.astype(U64) * _TAG[2 * turn]), sym[first])
    return name, np.cumsum(new) - 1


def is_left(sym: np.ndarray, turn: int) -> np.ndarray:
    """The half of the alphabet that a symbol belongs to in this round."""
    return (mix(sym ^ _TAG[2 * turn + 1]) & U64(1)).astype(bool)


def pair_round(sym: np.ndarray, row: np.ndarray, left: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Names after every (left, right) pair became one symbol; the new index of each old one."""
    joined = np.zeros(len(sym), bool)
    joined[1:] = left[:-1] & ~left[1:] & (row[1:] == row[:-1])
    first = np.flatnonzero(~joined)
    pair = np.append(joined[1:], False)[first]
    after = sym[np.minimum(first + 1, len(sym) - 1)]
    name = np.where(pair, mix(mix(sym[first] + _TAG[2 * turn + 1]) * U64(0x9FB21C651E98DF25) + after), sym[first])
    return name, np.cumsum(~joined) - 1


def anchors(words: np.ndarray, row: np.ndarray, start: np.ndarray, length: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """For windows of ``length`` words: the name and first word of the symbol that anchors each.

    A window keeps track of its interior symbols: those that no continuation outside it could
    change.  A run round costs it its first and last run; a pair round costs it a first symbol
    that might be a pair's second half, and a last one that might be a first half.  What is
    inside therefore depends on the window's words alone.  The anchor is the interior symbol of
    most words (then of smallest hash, then leftmost) on the last level that has interior
    symbols; words themselves are level 0, so there always is one.  One run round and
    ``ROUNDS`` pair rounds give symbols of one to four words, of which a window of 13 words
    nearly always holds some.
    """
    name, where = np.zeros(len(start), U64), np.zeros(len(start), np.int64)
    live = np.arange(len(start))
    x, y = start.copy(), start + length
    sym, place = words, np.arange(len(words))

    def freeze(which: np.ndarray, x: np.ndarray, y: np.ndarray, level: int) -> None:
        if not len(which):
            return
        width = np.minimum(np.diff(np.append(place, len(words))), length + 1)
        order = (U64(15) - width.astype(U64)) << U64(60) | mix(sym ^ _TAG[level]) >> U64(4)
        best, at = order[x], x.copy()
        for j in range(1, int((y - x).max())):
            here = np.minimum(x + j, len(sym) - 1)
            better = (x + j < y) & (order[here] < best)
            best, at = np.where(better, order[here], best), np.where(better, here, at)
        name[which], where[which] = best, place[at]

    for level in range(ROUNDS + 1):
        if level:
            left = is_left(sym, level)
            names, to = pair_round(sym, row, left, level)
            a, b = x + ~left[x], y - left[y - 1]
        else:
            names, to = run_round(sym, row, level)
            a, b = x, y
        ok = b > a
        a, b = to[np.minimum(a, len(to) - 1)], to[b - 1] + 1
        if not level:
            a, b = a + 1, b - 1
            ok = b > a
        freeze(live[~ok], x[~ok], y[~ok], level)
        live, x, y = live[ok], a[ok], b[ok]
        head = np.ones(len(sym), bool)
        head[1:] = to[1:] != to[:-1]
        sym, place, row = names, place[head], row[head]
        if not len(live):
            return name, where
    freeze(live, x, y, ROUNDS + 1)
    return name, where


def in_context(name: np.ndarray, prefix: np.ndarray, start: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Names of anchors made one with the ``HALF`` words from the anchor on, or up to it, that lie in the window.

    A symbol of a few common words anchors windows of many contents, all of which would have to
    be compared; few contents share half a window as well.  Which side is read depends on the
    anchor's place in the window, so equal windows still have equal names.
    """
    ahead = where - start <= WINDOW - HALF
    first = np.where(ahead, where, where - (HALF - 1))
    return mix(name ^ mix(WORDS.part(prefix, first, first + HALF) + ahead.astype(U64)))


def piece_blocks(words: np.ndarray, offsets: np.ndarray) -> Blocks | None:
    counts = np.diff(offsets)
    long = counts >= WINDOW
    if not long.any():
        return None
    n = np.where(long, counts - WINDOW + 1, 0)
    start = np.repeat(offsets[:-1], n) + within(n)
    row = rows_of(offsets)
    name, where = anchors(words, row, start)
    prefix = WORDS.prefix(words)
    name = in_context(name, prefix, start, where)
    of = row[start]
    # two rows never share a place; two levels may, so the name counts as well
    first, size = runs(np.ones(len(start), bool), mix(name) + where.astype(U64))
    s, at = start[first], where[first]
    digest = mix(WORDS.part(prefix, s, s + size + (WINDOW - 1)) + ((at - s) * 128 + size).astype(U64))
    return Blocks(of[first], s - offsets[of[first]], size, at - s, name[first], digest)


def blocks(column: pa.Array) -> Iterator[Blocks]:
    offsets, data = flat(column)
    for a, b in cuts(offsets, PIECE):
        own = offsets[a : b + 1] - offsets[a]
        text = data[offsets[a] : offsets[b]]
        starts, ends, rows = word_spans(text, own)
        words = word_hashes(text, starts, ends)
        step = 1 << 18
        if b - a > 1 or len(words) <= step:
            found = piece_blocks(words, rows)
            if found:
                found.row += a
                yield found
            continue
        for at in range(0, len(words), step):
            # the margin changes no anchor: anchors look at nothing outside their window
            end = min(len(words), at + step + WINDOW - 1)
            found = piece_blocks(words[at:end], np.array([0, end - at]))
            if found:
                found.row += a
                found.start += at
                yield found


def parts(text: bytes, wanted: list[tuple[int, int]]) -> list[bytes]:
    words = text.split()
    return [b" ".join(words[s : s + n + WINDOW - 1]) for s, n in wanted]


def _numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words as integers that are equal only for equal bytes, and the offsets of the texts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    starts, ends, rows = word_spans(data, offsets)
    return word_ids(word_array(data, starts, ends))[0].astype(U64), rows


def repeated(texts: list[bytes], group: np.ndarray, key: np.ndarray, start: np.ndarray, n: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """For every window of blocks in order of (group, key, start): is an equal one in an earlier document?

    Windows with one name are verified word by word, on the words' bytes; a window
    that shares only the name of its neighbours is compared under a name of its own.
    """
    words, rows = _numbered(texts)
    block = np.repeat(np.arange(len(texts)), n)
    at = rows[:-1][block] + within(n)
    name = mix(WORDS.part(WORDS.prefix(mix(words + _TAG[3])), at, at + WINDOW) + group[block].astype(U64) * _TAG[1])
    reach = np.arange(WINDOW)
    while True:
        order = np.argsort(name, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = name[order][1:] != name[order][:-1]
        later = np.flatnonzero(~new)
        odd = [
            i[(words[at[order[i - 1]][:, None] + reach] != words[at[order[i]][:, None] + reach]).any(axis=1)]
            for i in np.array_split(later, max(1, len(later) // 65536))
        ]
        odd = np.concatenate(odd) if odd else later
        if not len(odd):
            break
        name[order[odd]] = mix(name[order[odd]] + _TAG[2])
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    out = np.zeros(len(order), bool)
    out[order] = key[block[order]] > key[block[order[first]]]
    return out


METHOD = Method(blocks, parts, repeated, strict=True)
ROWS = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def word_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, after removing repeated words.

    A word goes if it lies in 13 consecutive words that also occur in a document before this
    one by (doc_id, nulls first; text).  Names are 64-bit hashes of what they stand for, so
    every task names runs and pairs alike without a table of names; the blocks that symbols
    anchor are what Spark shuffles, and equal names are verified on the words.  Null texts have
    no words; texts under 13 words and an empty table lose nothing; rows that repeat a doc_id
    count as documents of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeats, rows = batch.column("repeats"), []
            for i, text in texts_of(batch):
                words = text.split()
                start, end = spans(repeats[i], WINDOW, len(words))
                left = words
                if len(start):
                    left = [w for a, b in zip([0, *end.tolist()], [*start.tolist(), len(words)]) for w in words[a:b]]
                rows.append((len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()))
            if rows:
                columns = [pa.array(x, t) for x, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.string()])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], [c.split()[0] for c in ROWS.split(", ")])

    return covered(keyed(docs), METHOD).select("doc_id", "text", "repeats").mapInArrow(run, ROWS)
