"""Exact repeats of fixed-length windows over a corpus, found through content-chosen anchors.

Every window of a document picks an anchor from its own content alone, so equal windows pick
equal anchors at equal distances.  Consecutive windows with one anchor form a block, the only
thing that is shuffled: (anchor, digest of the block's content, document, place).

1. ``located``: blocks meet by anchor, sorted by Spark (spilling), and are read as a stream.
   A later block with an earlier block's digest repeats as a whole.  Where one anchor has
   several contents, the first block of each goes on to step 2.  Copies inside one Arrow batch
   are settled before the shuffle, so a copied text sends a row per batch, not per copy.
2. ``settled``: the bytes of those few blocks are fetched and their windows compared exactly.
   An anchor with more contents than one task should hold sends its windows one by one, as
   128-bit digests and keyed by them, so that such an anchor is spread over all tasks.
3. ``covered``: the repeated ranges are joined to the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.scale import staged
from sitelens.llm.text import flat, within

REPEAT, SEVERAL, HOT = 1, 2, 3
GROUP_ROWS = 10_000
TASK_BYTES = 1 << 20
N_BITS = 7
HOT_LEAD = -1


@dataclass
class Blocks:
    """Runs of consecutive windows: row, first window, windows, distance to the anchor, names."""

    row: np.ndarray
    start: np.ndarray
    n: np.ndarray
    lead: np.ndarray
    anchor: np.ndarray
    digest: np.ndarray


@dataclass(frozen=True)
class Method:
    """What differs between kinds of windows.

    ``blocks`` yields the blocks of an Arrow text column; ``parts`` gives the bytes of wanted
    blocks of one text; ``repeated`` tells which windows of blocks with one anchor have an
    earlier equal; ``strict`` asks for an earlier document.
    """

    blocks: Callable[[pa.Array], Iterator[Blocks]]
    parts: Callable[[bytes, list[tuple[int, int]]], list[bytes]]
    repeated: Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    strict: bool


def runs(valid: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of equal ``name`` among ``valid`` neighbours."""
    if not len(valid):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = valid.copy()
    new[1:] &= (name[1:] != name[:-1]) | ~valid[:-1]
    last = valid.copy()
    last[:-1] &= new[1:] | ~valid[1:]
    start = np.flatnonzero(new)
    return start, np.flatnonzero(last) + 1 - start


def joined(row: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First member and windows of the chains of blocks that follow each other in a row.

    A chain is cut so that its windows fit in ``2 * N_BITS`` bits.
    """
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + n[:-1])
    chain = np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
    reach = (start - start[chain]) >> (2 * N_BITS - 1)
    new[1:] |= reach[1:] != reach[:-1]
    first = np.flatnonzero(new)
    return first, np.add.reduceat(n, first)


BLOCK_ROWS = "_key long, place long, anchor long, digest long"


def block_rows(docs: DataFrame, method: Method) -> DataFrame:
    """A row per block; ``place`` packs start, the settled flag, windows and lead.

    Settled blocks that follow each other in a text are one row, whose windows take the bits of the lead too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("_key").to_numpy(zero_copy_only=False)
            found = list(method.blocks(batch.column("text")))
            if not found:
                continue
            row, start, n, lead, anchor, digest = (
                np.concatenate([getattr(b, c) for b in found]) for c in ("row", "start", "n", "lead", "anchor", "digest")
            )
            key = keys[row]
            anchor, digest = anchor.view(np.int64), digest.view(np.int64)
            order = np.lexsort((start, key, digest))
            d, a, k = digest[order], anchor[order], key[order]
            first = np.ones(len(order), bool)
            first[1:] = (d[1:] != d[:-1]) | (a[1:] != a[:-1])
            later = ~first
            if method.strict:
                later &= k != k[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            done = np.zeros(len(order), bool)
            done[order] = later
            place = (start << (2 * N_BITS + 1)) | (n << N_BITS) | lead
            # settled rows only pass through: neighbours as one row, dealt out by their place
            at, size = joined(row[done], start[done], n[done])
            own = np.flatnonzero(done)[at]
            settled_place = (start[own] << (2 * N_BITS + 1)) | (1 << (2 * N_BITS)) | size
            key, place, anchor, digest = (
                np.concatenate([x[~done], y])
                for x, y in ((key, key[own]), (place, settled_place), (anchor, digest[own] ^ (start[own] << 7) ^ key[own]), (digest, digest[own]))
            )
            for at in range(0, len(key), 1 << 17):
                part = slice(at, at + (1 << 17))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[part]) for x in (key, place, anchor, digest)], ["_key", "place", "anchor", "digest"]
                )

    return docs.select("_key", "text").mapInArrow(run, BLOCK_ROWS)


FOUND = "_key long, start long, n int, lead int, anchor long, kind int"


def located(docs: DataFrame, method: Method) -> DataFrame:
    """(_key, start, n, lead, anchor, kind): repeated blocks, and blocks to compare further."""

    def resolve(anchor, digest, key, place, hot: bool, before: tuple | None) -> pa.RecordBatch:
        """Rows of whole anchor groups, or a stretch of one hot group after ``before``."""
        settled = (place >> (2 * N_BITS)) & 1 == 1
        new_a = np.ones(len(anchor), bool)
        new_a[1:] = (anchor[1:] != anchor[:-1]) | settled[1:] | settled[:-1]
        new_c = new_a.copy()
        new_c[1:] |= digest[1:] != digest[:-1]
        first_key = key[np.maximum.accumulate(np.where(new_c, np.arange(len(key)), 0))]
        if before and len(key) and before[0] == digest[0] and not settled[0]:
            went_on = np.cumsum(new_c) == 1
            first_key = np.where(went_on, before[1], first_key)
            new_c[0] = False
        repeat = ((key != first_key) if method.strict else ~new_c) & ~settled
        if hot:
            several = np.ones(len(key), bool)
        else:
            group = np.cumsum(new_a) - 1
            several = (np.bincount(group, new_c) >= 2)[group]
        kind = np.where(settled | repeat, REPEAT, np.where(several, HOT if hot else SEVERAL, 0)).astype(np.int32)
        keep = kind > 0
        mask = (1 << N_BITS) - 1
        p, whole = place[keep], settled[keep]
        n = np.where(whole, p & ((1 << 2 * N_BITS) - 1), (p >> N_BITS) & mask)
        columns = (key[keep], p >> (2 * N_BITS + 1), n.astype(np.int32), np.where(whole, 0, p & mask).astype(np.int32), anchor[keep], kind[keep])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], [c.split()[0] for c in FOUND.split(", ")]), (
            (digest[-1], first_key[-1]) if len(key) else before
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4
        hot, before = None, None
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "digest", "_key", "place")]
            held = [np.concatenate(x) for x in zip(held, new)] if len(held[0]) else new
            if hot is not None:
                end = int(np.searchsorted(held[0], hot, "right"))
                out, before = resolve(*(x[:end] for x in held), True, before)
                yield out
                held = [x[end:] for x in held]
                if len(held[0]):
                    hot = before = None
            if not len(held[0]):
                continue
            end = int(np.searchsorted(held[0], held[0][-1], "left"))
            if end:
                yield resolve(*(x[:end] for x in held), False, None)[0]
                held = [x[end:] for x in held]
            if len(held[0]) > GROUP_ROWS and hot is None:
                hot = held[0][0]
                out, before = resolve(*held, True, None)
                yield out
                held = [x[:0] for x in held]
        if len(held[0]):
            yield resolve(*held, False, None)[0]

    rows = block_rows(docs, method).repartition("anchor").sortWithinPartitions("anchor", "digest", "_key", "place")
    return staged(rows.mapInArrow(run, FOUND))


PARTS = "_key long, start long, n int, lead int, anchor long, part binary, done boolean"


def settled(docs: DataFrame, found: DataFrame, method: Method) -> DataFrame:
    """(_key, start, n): repeated windows among the blocks whose anchor has several contents."""
    wanted = (
        found.filter(F.col("kind") != REPEAT)
        .groupBy("_key")
        .agg(F.collect_list(F.struct("start", "n", "lead", "anchor", "kind")).alias("wanted"))
    )
    names = [c.split()[0] for c in PARTS.split(", ")]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = flat(batch.column("text"))
            lists = batch.column("wanted")
            rows: list[tuple] = []
            hot: list[tuple] = []
            size = 0
            for i, key in enumerate(batch.column("_key").to_pylist()):
                ask = lists[i].values
                start, n, lead, anchor, kind = (ask.field(c).to_numpy() for c in ("start", "n", "lead", "anchor", "kind"))
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                cold = kind == SEVERAL
                parts = method.parts(text, list(zip(start[cold].tolist(), n[cold].tolist())))
                for s, k, e, a, part in zip(start[cold].tolist(), n[cold].tolist(), lead[cold].tolist(), anchor[cold].tolist(), parts):
                    rows.append((key, s, k, e, a, part, False))
                    size += len(part)
                if not cold.all():
                    at = (np.repeat(start[~cold], n[~cold]) + within(n[~cold])).tolist()
                    hot += [(key, s, part) for s, part in zip(at, method.parts(text, [(s, 1) for s in at]))]
                if size > TASK_BYTES:
                    yield table(rows)
                    rows, size = [], 0
                if len(hot) > 50_000:
                    yield table(spread(hot))
                    hot = []
            if rows:
                yield table(rows)
            if hot:
                yield table(spread(hot))

    def spread(hot: list[tuple]) -> list[tuple]:
        """Single windows as digests, keyed by them; those with an equal before them here are done."""
        hot = [(key, s, hashlib.blake2b(part, digest_size=16).digest()) for key, s, part in hot]
        names = [int.from_bytes(x[2][:8], "little", signed=True) for x in hot]
        order = sorted(range(len(hot)), key=lambda i: (names[i], hot[i][0], hot[i][1]))
        out, before, first = [], None, None
        for i in order:
            key, s, part = hot[i]
            if part != before:
                before, first, done = part, key, False
            else:
                done = not method.strict or key != first
            out.append((key, s, 1, HOT_LEAD, names[i] ^ (hash((key, s)) if done else 0), None if done else part, done))
        return out

    def compare(rows: list[np.ndarray]) -> tuple[pa.RecordBatch, np.ndarray]:
        key, start, n, lead, anchor, part, done = rows
        window = np.repeat(np.arange(len(key)), n)
        at = start[window] + within(n)
        hit = done[window].copy()
        alone = ~done & (lead == HOT_LEAD)
        first: dict[bytes, int] = {}
        for i in np.flatnonzero(alone[window]):  # one window a row: a row's digest names it
            earlier = first.setdefault(part[window[i]], i)
            hit[i] = key[window[i]] > key[window[earlier]] if method.strict else earlier != i
        live = np.flatnonzero(~done & ~alone)
        if len(live):
            group = np.cumsum(np.concatenate(([True], anchor[live][1:] != anchor[live][:-1]))) - 1
            hit[np.isin(window, live)] = method.repeated(list(part[live]), group, key[live], start[live], n[live].astype(np.int64), lead[live].astype(np.int64))
        found = np.flatnonzero(hit)
        first, length = runs(hit, window)
        table = pa.RecordBatch.from_arrays(
            [pa.array(key[window[first]]), pa.array(at[first]), pa.array(length.astype(np.int32))], ["_key", "start", "n"]
        )
        open_rows = np.ones(len(key), bool)
        open_rows[window[found]] = False
        return table, open_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = None, 0
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            size += batch.column("part").nbytes
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            if size > TASK_BYTES:
                end = int(np.searchsorted(held[4], held[4][-1], "left"))
                if end:
                    yield compare([x[:end] for x in held])[0]
                    held = [x[end:] for x in held]
                elif (held[2] == 1).all():
                    # one window's copies: only those without an earlier equal must be remembered
                    table, open_rows = compare(held)
                    yield table
                    held = [x[open_rows] for x in held]
                size = sum(len(x) for x in held[5] if x is not None)
        if held is not None and len(held[0]):
            yield compare(held)[0]

    # all columns of docs, as ``covered`` reads them: both joins then share one exchange of the texts
    fetched = docs.join(wanted, "_key").mapInArrow(fetch, PARTS)
    return fetched.repartition("anchor").sortWithinPartitions("anchor", "_key", "start").mapInArrow(run, "_key long, start long, n int")


def covered(docs: DataFrame, method: Method) -> DataFrame:
    """``docs`` with ``repeats``: the (start, n) runs of windows that also start earlier."""
    found = located(docs, method)
    docs = docs.filter("_key IS NOT NULL")  # always so; said here because the inner join would add it to its side alone
    ranges = found.filter(F.col("kind") == REPEAT).select("_key", "start", "n").unionAll(settled(docs, found, method))
    of_doc = ranges.groupBy(F.col("_key").alias("_k")).agg(F.collect_list(F.struct("start", "n")).alias("repeats"))
    return docs.join(of_doc, F.col("_key") == F.col("_k"), "left").drop("_k")


def spans(repeats: pa.Scalar, length: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs covered by windows of ``length`` in a row of ``size``."""
    if not repeats.is_valid or not len(repeats.values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = repeats.values.field("start").to_numpy()
    end = start + repeats.values.field("n").to_numpy() + (length - 1)
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(start)) - 1]
