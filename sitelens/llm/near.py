"""Near-duplicate documents: BagMinHash signatures of word shingles, bands, verified overlap."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.scale import staged
from sitelens.llm.graph import components
from sitelens.llm.keys import keyed, restored
from sitelens.llm.text import U64, flat, hashed_words, mix, rows_of, within, word_array, word_ids, word_spans

SHINGLE, SIMILARITY = 5, 0.8
BANDS, BAND_ROWS = 32, 5
FEW_PAIRS = 2
ODD_WORDS = 32
_STEP = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64) for i in range(64)], U64)


def shingle_hashes(words: np.ndarray, rows: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``width`` words; a shorter row with words is one shingle."""
    counts = np.diff(rows)
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    row = np.repeat(np.arange(len(n)), n)
    at = np.repeat(rows[:-1], n) + within(n)
    size = np.repeat(np.minimum(counts, width), n)
    out = size.astype(U64)
    for j in range(width):
        here = np.minimum(at + j, max(len(words) - 1, 0))
        out += np.where(j < size, words[here] * _STEP[j], U64(0)) if len(words) else U64(0)
        out = mix(out)
    return out, row


def bags(words: np.ndarray, rows: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The multisets: (row, shingle of 48 bits, count), ordered by row."""
    shingles, row = shingle_hashes(words, rows, width)
    out: list[tuple] = []
    # the row takes the top 16 bits of one sort key
    for low in range(0, max(len(rows) - 1, 1), 1 << 16):
        here = slice(*np.searchsorted(row, [low, low + (1 << 16)]))
        key = np.sort(((row[here] - low).astype(U64) << U64(48)) | (shingles[here] >> U64(16)))
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(key)))
        own = key[first]
        out.append(((own >> U64(48)).astype(np.int64) + low, own & U64((1 << 48) - 1), count))
    return tuple(np.concatenate(x) for x in zip(*out))


def exact_bags(column: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The multisets without hashes: (row, count, code), a code for each different shingle of the column.

    Words are numbered by their bytes, and runs of words by the numbers of their two parts.
    """
    offsets, data = flat(column)
    starts, ends, rows = word_spans(data, offsets)
    words = word_ids(word_array(data, starts, ends))[0] + 1
    row, counts = rows_of(rows), np.diff(rows)
    last = rows[1:][row]

    def paired(left: np.ndarray, right: np.ndarray, reach: int) -> np.ndarray:
        """Numbers of (left at a place, right ``reach`` places on in the row; 0 beyond it)."""
        at = np.arange(len(words)) + reach
        after = np.where(at < last, right[np.minimum(at, max(len(words) - 1, 0))], 0) if len(words) else words
        return np.unique(left * (int(right.max(initial=0)) + 1) + after, return_inverse=True)[1].astype(np.int64) + 1

    code, size = words, 1
    while size < width:
        step = size if 2 * size <= width else 1
        code = paired(code, code if step == size else words, size)
        size += step
    starts_one = within(counts) < np.repeat(np.maximum(counts - width + 1, 1), counts)
    codes = int(code.max(initial=0)) + 1
    key, count = np.unique(row[starts_one] * codes + code[starts_one], return_counts=True)
    return key // codes, count.astype(np.int64), key % codes


def signatures(row: np.ndarray, item: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """BagMinHash registers (n x m) of weighted sets; equal registers estimate weighted Jaccard.

    Weights are cut at the integers and grouped in a hierarchy of intervals (0, 1], (1, 2],
    (2, 4], (4, 8] ...  Each (item, interval) is a Poisson process whose rate is the interval's
    length times ``m``; each point falls into a random register and on a random unit of its
    interval, and counts if the item's weight covers that unit.  So an item costs the logarithm
    of its weight.  Points are made in ascending order only up to a horizon at which all
    registers of a row are expected to be full; rows with an empty register go further.
    """
    registers = np.full((n, m), np.inf)
    if not len(item):
        return registers
    total = np.bincount(row, weight, n)
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1
    owner = np.repeat(np.arange(len(item)), levels)
    level = within(levels)
    start = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    length = np.where(level == 0, 1, start)
    seed = mix(item[owner] * U64(0xD1342543DE82EF95) + _STEP[level])
    covers = weight[owner] - start
    r = row[owner]
    horizon = np.where(total > 0, (math.log(m) + 4) / np.maximum(total, 1), 0.0)
    alive, time, turn = np.arange(len(owner)), np.zeros(len(owner)), np.ones(len(owner), np.int64)
    waiting: list[tuple] = []
    step = 1
    while True:
        while len(alive):
            k = np.arange(step)
            draw = mix(seed[alive][:, None] + (turn[:, None] + k).astype(U64) * U64(0xA0761D6478BD642F))
            gap = -np.log(((draw >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            # one point after the other, so that the sums are the same however points are grouped
            gap /= (length[alive] * m)[:, None]
            gap[:, 0] += time
            at = np.cumsum(gap, axis=1)
            limit = horizon[r[alive]][:, None]
            place = mix(draw ^ U64(0xE7037ED1A0B428DB))
            register = ((place & U64(0xFFFFFFFF)) * U64(m) >> U64(32)).astype(np.int64)
            unit = (place >> U64(32)).astype(np.int64) % length[alive][:, None]
            good = (at <= limit) & (unit < covers[alive][:, None])
            np.minimum.at(registers, (np.broadcast_to(r[alive][:, None], at.shape)[good], register[good]), at[good])
            on = at[:, -1] <= limit[:, 0]
            # a process that passed its horizon may have to go on from its last point before it
            over = ~on
            before = (at[over] <= limit[over]).sum(axis=1)
            last = np.where(before > 0, at[over][np.arange(over.sum()), np.maximum(before - 1, 0)], time[over])
            waiting.append((alive[over], last, turn[over] + before))
            alive, time, turn = alive[on], at[on, -1], turn[on] + step
            step = min(64, 2 * step)
        short = np.isinf(registers).any(axis=1) & (total > 0)
        if not short.any():
            return registers
        horizon[short] *= 2
        alive, time, turn = (np.concatenate(x) for x in zip(*waiting))
        again = short[r[alive]]
        alive, time, turn = alive[again], time[again], turn[again]
        waiting, step = [], 8


def odd_sketches(row: np.ndarray, item: np.ndarray, count: np.ndarray, n: int, words: int = ODD_WORDS) -> np.ndarray:
    """One bitmap of ``64 * words`` bits (n x words) per bag: a bit is the parity of the units in it.

    A unit is one occurrence of an item.  Units that two bags share cancel out, so the bits in
    which two bitmaps differ never outnumber the units in which the bags differ.
    """
    unit = mix(np.repeat(item, count) + within(count).astype(U64) * U64(0x9E3779B97F4A7C15))
    size = 64 * words
    out = np.zeros((n, words), U64)
    bit = (unit >> U64(32)).astype(np.int64) % size
    place, times = np.unique(np.repeat(row, count) * size + bit, return_counts=True)
    place = place[times % 2 == 1]
    np.bitwise_or.at(out.reshape(-1), place // 64, U64(1) << (place % 64).astype(U64))
    return out


def sketch(docs: DataFrame, width: int = SHINGLE, bands: int = BANDS, rows_per_band: int = BAND_ROWS) -> DataFrame:
    """(_key, doc_id, same, n, bands, odd) of ``keyed`` documents: digest of the words, shingles,
    band hashes, parity bitmap.

    A text without words has a null digest.
    """
    schema = "_key long, doc_id long, same binary, n long, bands array<long>, odd array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = flat(batch.column("text"))
            raw = memoryview(data)
            for a, b, words, rows in hashed_words(batch.column("text"), 1 << 20):
                row, item, count = bags(words, rows, width)
                found = signatures(row, item, count, b - a, bands * rows_per_band).view(U64)
                band = np.zeros((b - a, bands), U64) + np.arange(1, bands + 1).astype(U64)
                for j in range(rows_per_band):
                    band = mix(band * U64(0x9FB21C651E98DF25) + found[:, j::rows_per_band])
                texts = (bytes(raw[offsets[i] : offsets[i + 1]]) for i in range(a, b))
                same = [hashlib.blake2b(b" ".join(t.split()), digest_size=16).digest() if n else None for t, n in zip(texts, np.diff(rows))]
                n = np.bincount(row, count, b - a).astype(np.int64)
                odd = odd_sketches(row, item, count, b - a)
                lists = (
                    pa.ListArray.from_arrays(np.arange(b - a + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel().view(np.int64)))
                    for x in (band, odd)
                )
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a) for c in ("_key", "doc_id")), pa.array(same, pa.binary()), pa.array(n), *lists],
                    ["_key", "doc_id", "same", "n", "bands", "odd"],
                )

    return docs.select("_key", "doc_id", "text").mapInArrow(run, schema)


def overlaps(pairs: DataFrame, texts: DataFrame, threshold: float, width: int = SHINGLE) -> DataFrame:
    """The ``pairs(u, v)`` whose bags reach ``threshold``; ``texts(same, text)`` has each text once.

    A pair links if min-sums over max-sums of the shingle counts reach the threshold; shingles are
    compared by the words' bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = flat(batch.column("tu"))[0] + flat(batch.column("tv"))[0]
            keep = np.zeros(batch.num_rows, bool)
            a = 0
            while a < batch.num_rows:
                b = min(batch.num_rows, a + 50_000, max(a + 1, int(np.searchsorted(sizes, sizes[a] + (1 << 21), "right")) - 1))
                keep[a:b] = linked(batch.column("tu").slice(a, b - a), batch.column("tv").slice(a, b - a))
                a = b
            yield batch.select(["u", "v"]).filter(pa.array(keep))

    def linked(tu: pa.Array, tv: pa.Array) -> np.ndarray:
        row, count, code = exact_bags(pa.concat_arrays([tu.cast(pa.large_string()), tv.cast(pa.large_string())]), width)
        other = row >= len(tu)
        ku, kv = (code[x] * len(tu) + row[x] % len(tu) for x in (~other, other))
        _, i, j = np.intersect1d(ku, kv, assume_unique=True, return_indices=True)
        both = np.bincount(row % len(tu), count, len(tu))
        shared = np.bincount(row[~other][i], np.minimum(count[~other][i], count[other][j]), len(tu))
        return shared >= threshold * (both - shared) - 1e-9

    tu = texts.select(F.col("same").alias("u"), F.col("text").alias("tu"))
    tv = texts.select(F.col("same").alias("v"), F.col("text").alias("tv"))
    return pairs.join(tu, "u").join(tv, "v").select("u", "v", "tu", "tv").mapInArrow(run, "u binary, v binary")


def bucket_pairs(live: DataFrame, odd: DataFrame, threshold: float) -> DataFrame:
    """Pairs (u, v) of different labels that meet in a bucket of ``live`` and may reach ``threshold``.

    Similarity t of bags of a and b units means that they differ in at most
    (a + b)(1 - t) / (1 + t) units.  A pair whose parity bitmaps (``odd(_key, odd)``) differ in
    more bits cannot link and never leaves the join.  Of the buckets that a pair shares, the
    lowest one emits it.
    """
    ends = live.groupBy("same").agg(
        F.min(F.struct("_key", "label", "n")).alias("s"), F.sort_array(F.collect_set("bucket")).alias("buckets")
    )
    ends = staged(ends.select("same", "s.*", "buckets").join(odd, "_key").drop("_key"))
    side = ends.select("*", F.explode("buckets").alias("bucket"))
    side = side.withColumn("earlier", F.expr("filter(buckets, x -> x < bucket)")).drop("buckets")
    apart = " + ".join(f"bit_count(a.odd[{i}] ^ b.odd[{i}])" for i in range(ODD_WORDS))
    on = (
        "a.bucket = b.bucket AND a.same < b.same AND a.label != b.label"
        f" AND least(a.n, b.n) >= {threshold} * greatest(a.n, b.n)"
        f" AND {apart} <= (a.n + b.n) * {(1 - threshold) / (1 + threshold)!r}D + 1e-6D"
        " AND NOT arrays_overlap(a.earlier, b.earlier)"
    )
    return side.alias("a").join(side.alias("b"), F.expr(on)).selectExpr("a.same AS u", "b.same AS v")


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Component labels after more ``links(u, v)``: only what they join is contracted."""
    if labels is None:
        return components(links)
    of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}"))
    joined = links.join(of("u"), "u", "left").join(of("v"), "v", "left")
    ends = joined.select(F.coalesce("lu", "u").alias("u"), F.coalesce("lv", "v").alias("v"))
    step = components(ends).select(F.col("node").alias("label"), F.col("label").alias("next"))
    fresh = links.select(F.col("u").alias("node")).union(links.select("v")).distinct().join(labels, "node", "left_anti")
    every = labels.union(fresh.select("node", F.col("node").alias("label")))
    return staged(every.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label")))


def near_classes(
    docs: DataFrame, threshold: float = SIMILARITY, width: int = SHINGLE, bands: int = BANDS, rows_per_band: int = BAND_ROWS
) -> DataFrame:
    """(_key, doc_id, class_id, kept) of ``keyed`` documents; see ``near_duplicates``."""
    sketched = staged(sketch(docs, width, bands, rows_per_band))
    nodes = sketched.filter("same IS NOT NULL").groupBy("same").agg(F.min(F.struct("_key", "n", "bands")).alias("s"))
    banded = nodes.select("same", F.col("s._key").alias("_key"), F.col("s.n").alias("n"), F.explode("s.bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("_c")).filter("_c > 1").select("bucket")
    members = staged(banded.join(shared, "bucket"))
    rows = members.count()
    labels = compared = before = None
    if rows:
        texts = staged(docs.select("_key", "text").join(members.select("_key", "same").distinct(), "_key").select("same", "text"))
    fits = f"least(a.n, s.n) >= {threshold} * greatest(a.n, s.n)"
    live, last = members.withColumn("label", F.col("same")), not rows
    turn = 0
    while not last:
        buckets = live.groupBy("bucket").agg(
            F.min("label").alias("lo"),
            F.max("label").alias("hi"),
            F.count("*").alias("c"),
            F.min(F.struct(F.xxhash64("same", F.lit(turn)).alias("p"), "same", "label", "n")).alias("s"),
        )
        live = staged(live.join(buckets.filter("lo != hi").select("bucket", "c", "s"), "bucket"))
        left = live.agg(F.expr("coalesce(sum((c - 1) / 2), 0)")).first()[0]
        if not left:
            break
        last = left <= FEW_PAIRS * rows or before is not None and left > before / 2
        before = left
        if last:
            pairs = bucket_pairs(live, sketched.select("_key", "odd"), threshold)
        else:
            star = live.alias("a").filter(f"a.label != s.label AND {fits}")
            pairs = star.selectExpr("least(same, s.same) AS u", "greatest(same, s.same) AS v").distinct()
        pairs = staged(pairs if compared is None else pairs.join(compared, ["u", "v"], "left_anti"))
        compared = pairs if compared is None else compared.union(pairs)
        links = staged(overlaps(pairs, texts, threshold, width))
        labels = merged(labels, links)
        if not last:
            known = labels.select(F.col("node").alias("same"), F.col("label").alias("_l"))
            live = live.drop("c", "s", "label").join(known, "same", "left").withColumn("label", F.coalesce("_l", "same")).drop("_l")
        turn += 1
    found = sketched.select("_key", "doc_id", F.col("same").alias("node"))
    if labels is not None:
        found = found.join(labels, "node", "left").withColumn("node", F.coalesce("label", "node"))
    found = found.select("_key", "doc_id", F.coalesce(F.hex("node"), F.concat(F.lit("row "), F.col("_key"))).alias("class"))
    first = found.groupBy("class").agg(F.min(F.struct("_key", "doc_id")).alias("first"))
    return found.join(first, "class").select(
        "_key", "doc_id", F.col("first.doc_id").alias("class_id"), (F.col("_key") == F.col("first._key")).alias("kept")
    )


def near_duplicates(docs: DataFrame, threshold: float = SIMILARITY, width: int = SHINGLE) -> DataFrame:
    """(doc_id, class_id, kept): documents connected by links of weighted Jaccard >= ``threshold``.

    ``class_id`` is the doc_id of the class's first row by (doc_id, text), which alone is kept.
    Texts with equal words are one node from the start, whatever their white space.  A pair at
    the threshold shares a band with probability 1 - (1 - 0.8^5)^32 = 0.999997.

    In each round every bucket compares its members to one member drawn at random, and what
    links is one component from then on; members of one component need no comparison, so
    groups of copies dissolve in a round or two.  When the pairs left between different
    components are no more than a few per member, or a round no longer halves them, all of
    them are compared, so that no candidate pair is left out; pairs that the parity bitmaps
    refute are never emitted.  A group whose members are just
    too far apart to link is the costly case: each of its pairs must be refuted.

    Documents without words are classes of their own.  Repeated rows are copies of the first;
    a null doc_id comes before all others.  An empty table gives an empty result.
    """
    return near_classes(keyed(docs), threshold, width).select("doc_id", "class_id", "kept")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies of an earlier one, with the columns of ``docs``."""
    rows = keyed(docs, carry=True)
    kept = near_classes(rows).filter("kept").select("_key")
    return restored(rows.join(kept, "_key", "left_semi"), docs.columns)
