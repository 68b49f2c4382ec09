"""Collocations of two to five words per language, from counts of the longest windows only.

Every word starts one window: itself and the words that follow it, up to five, padded with nulls
at the end of its piece.  Only those windows are counted; ROLLUP over their word columns sums the
windows with equal prefixes, and a prefix sum is the count of that phrase.  Besides, pairs of frequent
words are counted, to end windows before rare ones; no n-gram of any other order is ever listed.

Windows of numbered words are exchanged once, in packed blocks dealt by their first three words; the
task that has all windows with these words ends them before the first rare prefix, so ROLLUP, which
lists every prefix of its input, meets frequent ones only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitelens.functions.scale import broadcast_within, has_at_most, staged
from sitelens.llm.text import U64, cuts, flat, mix, word_spans

LONGEST, MIN_COUNT, TOP, ABSORBED = 5, 100, 2000, 100
#: removes a write's shuffle files at its end, as in ``shards``, which tasks need not load for it
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: rows up to which frequent words, and frequent pairs of words, are sent to every task; more pairs are sent as marks
KNOWN_ROWS = 1_000_000
#: bits of marks for each pair, and the logarithm of how many bits there are at most, and of how many one task sets
PAIR_BITS, MOST_BITS, PART_BITS = 16, 28, 20
#: bytes of text that one step of a task works on; a longer text is a step of its own
STEP_BYTES = 1 << 22
#: windows that a task hands over at once
OUT_ROWS = 1 << 16
#: windows that a task holds before it sums or deals them
HELD_ROWS = 1 << 19
#: words of the table for each task that windows are dealt to; a word starts one window at most
DEALT_WORDS = 1 << 21
#: words of a window that choose its task
DEALT_BY = 3

#: byte -> byte: A-Z in lower case, ends of pieces as line feeds
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[*b".,;:!?\n\v\f\r"]] = 10
_END = np.zeros(256, np.int64)
_END[10] = 1


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """Per language and step of a batch: the words in order, and the number of each word's piece."""
    langs = pc.fill_null(batch.column("lang").cast(pa.string()), "und")
    for lang in pc.unique(langs):
        offsets, raw = flat(batch.column("text").filter(pc.equal(langs, lang)))
        for a, b in cuts(offsets, STEP_BYTES):
            own = offsets[a : b + 1] - offsets[a]
            data = _PLAIN[raw[offsets[a] : offsets[b]]]
            starts, ends, rows = word_spans(data, own)
            if not len(starts):
                continue
            size = np.zeros(len(starts) + 1, np.int64)
            np.cumsum(ends - starts, out=size[1:])
            inside = np.zeros(len(data) + 1, np.int8)
            inside[starts] += 1
            inside[ends] -= 1
            solid = data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
            words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(size), pa.py_buffer(solid))
            row = np.repeat(np.arange(b - a), np.diff(rows))
            yield lang.as_py(), words, np.cumsum(_END[data])[starts] + row


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def _staged(df: DataFrame) -> DataFrame:
    """``staged``, and the shuffle files of the write are removed at its end."""
    conf = df.sparkSession.conf
    cleaned = conf.get(CLEAN, None)
    conf.set(CLEAN, "true")
    try:
        return staged(df)
    finally:
        conf.set(CLEAN, cleaned) if cleaned is not None else conf.unset(CLEAN)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n); counted inside each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, _ in _pieces(batch):
                found = pc.value_counts(words)
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]).take(pa.array(np.zeros(n, np.int64))), found.field(0).cast(pa.string()), found.field(1)],
                    ["lang", "word", "n"],
                )

    rows = docs.mapInArrow(run, "lang string, word string, n long")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _places(lang: str, code: np.ndarray, bits: int) -> np.ndarray:
    """The mark of each pair among ``2 ** bits``."""
    return (mix(code.astype(U64) ^ U64(zlib.crc32(lang.encode()) << 32)) >> U64(64 - bits)).astype(np.int64)


class Known:
    """Words, and pairs of them, that occur often enough to be part of a candidate.

    ``pairs`` are the sorted codes of every language, or marks: one bit for each hash of a pair.  Marks
    have all frequent pairs and a few rare ones, which only make some windows longer.
    """

    def __init__(self, words: dict[str, pa.Array], pairs: dict[str, np.ndarray] | np.ndarray | None = None):
        self.words, self.pairs = words, pairs

    def joined(self, lang: str, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair is among the known ones."""
        code = self.code(lang, left, right)
        if isinstance(self.pairs, np.ndarray):
            at = _places(lang, code, len(self.pairs).bit_length() + 2)
            return (self.pairs[at >> 3] >> (at & 7).astype(np.uint8) & 1).view(bool)
        pairs = self.pairs.get(lang, np.zeros(0, np.int64))
        if not len(pairs):
            return np.zeros(len(code), bool)
        return pairs[np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)] == code

    def ids(self, lang: str, words: pa.Array) -> np.ndarray:
        """Index of each word among the known ones of its language; -1 where it is not known."""
        known = self.words.get(lang)
        if known is None:
            return np.full(len(words), -1, np.int64)
        encoded = words.dictionary_encode()
        of_word = pc.fill_null(pc.index_in(encoded.dictionary.cast(pa.string()), known), -1).to_numpy(zero_copy_only=False)
        return of_word.astype(np.int64)[encoded.indices.to_numpy(zero_copy_only=False)]

    def code(self, lang: str, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left * max(1, len(self.words.get(lang, ()))) + right


def _by_lang(rows: pa.Table, column: str) -> dict[str, pa.Array]:
    langs, values = rows["lang"].combine_chunks(), rows[column].combine_chunks()
    return {x: values.filter(pc.equal(langs, x)) for x in pc.unique(langs).to_pylist()}


def _pair_counts(docs: DataFrame, known) -> DataFrame:
    """(lang, code, n) of adjacent known words: the word columns at lead 0 and 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, piece in _pieces(batch):
                ids = known.value.ids(lang, words)
                both = (piece[1:] == piece[:-1]) & (ids[1:] >= 0) & (ids[:-1] >= 0)
                code, n = _counted(known.value.code(lang, ids[:-1][both], ids[1:][both]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]).take(pa.array(np.zeros(len(code), np.int64))), pa.array(code), pa.array(n)], ["lang", "code", "n"]
                )

    rows = docs.mapInArrow(run, "lang string, code long, n long")
    return rows.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def _marks(pairs: DataFrame) -> np.ndarray:
    """Bits of all ``pairs`` (lang, code), as ``Known`` has them; set in parts by the tasks, so their size alone reaches the driver."""
    bits = max(3, min(MOST_BITS, (PAIR_BITS * pairs.count()).bit_length()))
    part_bits = min(bits, PART_BITS)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in pc.unique(batch.column("lang")):
                code = batch.filter(pc.equal(batch.column("lang"), lang)).column("code").to_numpy(zero_copy_only=False)
                at = np.unique(_places(lang.as_py(), code, bits))
                part, place = (at >> part_bits).astype(np.int32), (at & ((1 << part_bits) - 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(place)], ["part", "place"])

    def packed(rows: pa.Table) -> pa.Table:
        own = np.zeros(1 << part_bits, bool)
        own[rows["place"].to_numpy()] = True
        return pa.table({"part": rows["part"].slice(0, 1), "marks": pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())})

    marks = np.zeros(1 << (bits - 3), np.uint8)
    rows = pairs.select("lang", "code").mapInArrow(places, "part int, place int").groupBy("part")
    for part in rows.applyInArrow(packed, "part int, marks binary").collect():
        own = np.frombuffer(part.marks, np.uint8)
        marks[part.part * len(own) : (part.part + 1) * len(own)] = own
    return marks


def _distinct(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of integer ``columns`` (-1: none) once each and in order, and their counts or the sums of ``counts``.

    Prefixes are ranked, rows never copied side by side.
    """
    key = columns[0].astype(np.int64)
    for i, c in enumerate(columns[1:], 2):
        key *= int(c.max(initial=-1)) + 2
        key += c + 1
        order = np.argsort(key)
        ordered = key[order]
        new = np.ones(len(key), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        if i < len(columns):
            key[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    at = order[first]
    n = np.diff(first, append=len(order)) if counts is None or not len(first) else np.add.reduceat(counts[order], first)
    return [c[at] for c in columns], n


def _step_windows(
    batch: pa.RecordBatch, longest: int, known: Known | None
) -> Iterator[tuple[str, list[np.ndarray], np.ndarray, pa.Array | None]]:
    """Per language and step: columns of word numbers (-1: none), counts, and the words so numbered if they are not ``known``."""
    for lang, words, piece in _pieces(batch):
        goes_on, table = piece[1:] == piece[:-1], None
        if known is None:
            encoded = words.dictionary_encode()
            ids, table = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int32), encoded.dictionary.cast(pa.string())
        else:
            ids = known.ids(lang, words)
            goes_on &= (ids[1:] >= 0) & (ids[:-1] >= 0)
            if known.pairs is not None:
                goes_on &= known.joined(lang, ids[:-1], ids[1:])
            ids = ids.astype(np.int32)
        del words, piece
        starts = goes_on
        if known is not None and known.pairs is not None:
            starts = goes_on & np.append(goes_on[1:], np.zeros(min(1, len(goes_on)), bool))
        first = np.flatnonzero(starts)
        columns, alive = [ids[first]], np.ones(len(first), bool)
        for lead in range(1, longest):
            at = first + lead
            alive &= (at < len(ids)) & goes_on[np.minimum(at - 1, len(goes_on) - 1)]
            columns.append(np.where(alive, ids[np.minimum(at, len(ids) - 1)], np.int32(-1)))
        columns, n = _distinct(columns)
        yield lang, columns, n, table


def window_batches(batches: Iterator[pa.RecordBatch], longest: int, known: Known | None = None) -> Iterator[pa.RecordBatch]:
    """(lang, w1, .., n) of every step, at most ``OUT_ROWS`` rows at once; words are numbers with ``known``, else texts.

    Where ``known`` has pairs, they are counted, so only windows of three words or more are given.
    """
    names = ["lang", *[f"w{i}" for i in range(1, longest + 1)], "n"]
    for batch in batches:
        for lang, columns, n, table in _step_windows(batch, longest, known):
            for i in range(0, len(n), OUT_ROWS):
                rows = [pa.array(c[i : i + OUT_ROWS], mask=c[i : i + OUT_ROWS] < 0) for c in columns]
                rows = rows if known is not None else [table.take(r) for r in rows]
                size = len(rows[0])
                own = pa.array([lang]).take(pa.array(np.zeros(size, np.int64)))
                yield pa.RecordBatch.from_arrays([own, *rows, pa.array(n[i : i + OUT_ROWS])], names)


def _summed(parts: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    return _distinct([np.concatenate(c) for c in zip(*(columns for columns, _ in parts), strict=True)], np.concatenate([n for _, n in parts]))


def _packed(columns: list[np.ndarray], n: np.ndarray) -> bytes:
    """Ordered windows as bytes: the first words as differences, bytes of equal weight side by side, zstd."""
    rows = [np.diff(columns[0], prepend=0), *(c + 1 for c in columns[1:]), n & 0xFFFFFFFF, n >> 32]
    flat_rows = np.array(rows, "<u4").view(np.uint8).reshape(len(rows), len(n), 4)
    return pa.compress(np.ascontiguousarray(flat_rows.transpose(0, 2, 1)), "zstd", asbytes=True)


def _unpacked(block: bytes, size: int, longest: int) -> tuple[list[np.ndarray], np.ndarray]:
    raw = np.frombuffer(pa.decompress(block, (longest + 2) * 4 * size, "zstd"), np.uint8).reshape(longest + 2, 4, size)
    rows = np.ascontiguousarray(raw.transpose(0, 2, 1)).view("<u4")[:, :, 0]
    n = rows[longest].astype(np.int64) | rows[longest + 1].astype(np.int64) << 32
    return [np.cumsum(rows[0], dtype=np.int32), *(r.astype(np.int32) - 1 for r in rows[1:longest])], n


def window_blocks(batches: Iterator[pa.RecordBatch], longest: int, known: Known, tasks: int) -> Iterator[pa.RecordBatch]:
    """(task, lang, size, block) of packed windows; those with equal first ``DEALT_BY`` words go to the same task."""

    def dealt(lang: str, columns: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
        key = np.full(len(n), zlib.crc32(lang.encode()), U64)
        for c in columns[:DEALT_BY]:
            key = mix(key + c.astype(U64))
        task = (key % U64(tasks)).astype(np.uint16 if tasks <= 1 << 16 else np.int64)
        order = np.argsort(task, kind="stable")
        task, columns, n = task[order], [c[order] for c in columns], n[order]
        edges = np.append(np.flatnonzero(np.diff(task.astype(np.int64), prepend=-1)), len(n)).tolist()
        spans = [(i, min(i + OUT_ROWS, b)) for a, b in zip(edges[:-1], edges[1:], strict=True) for i in range(a, b, OUT_ROWS)]
        blocks = [_packed([c[a:b] for c in columns], n[a:b]) for a, b in spans]
        return pa.RecordBatch.from_pydict(
            {
                "task": pa.array(task[[a for a, _ in spans]].astype(np.int32)),
                "lang": pa.array([lang] * len(spans), pa.string()),
                "size": pa.array([b - a for a, b in spans], pa.int32()),
                "block": pa.array(blocks, pa.binary()),
            }
        )

    held: dict[str, list] = {}
    rows = 0
    for batch in batches:
        for lang, columns, n, _ in _step_windows(batch, longest, known):
            if len(n):
                held.setdefault(lang, []).append((columns, n))
                rows += len(n)
            if rows >= HELD_ROWS:
                yield from (dealt(x, *_summed(parts)) for x, parts in held.items())
                held, rows = {}, 0
    yield from (dealt(x, *_summed(parts)) for x, parts in held.items())


def _to_frequent(columns: list[np.ndarray], n: np.ndarray, min_count: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ordered windows, each ended before its first rare prefix; those with a rare prefix of ``DEALT_BY`` words are left out.

    Sums of frequent prefixes stay what they were, if all windows with equal first ``DEALT_BY`` words are here.
    """
    new, alive, kept = np.zeros(len(n), bool), np.ones(len(n), bool), None
    new[:1] = True
    columns = list(columns)
    for i, c in enumerate(columns):
        new[1:] |= c[1:] != c[:-1]
        if i + 1 >= DEALT_BY:
            often = np.add.reduceat(n, np.flatnonzero(new)) >= min_count
            alive &= often[np.cumsum(new) - 1] & (c >= 0)
            kept = alive.copy() if kept is None else kept
            columns[i] = np.where(alive, c, np.int32(-1))
    if kept is None:
        return columns, n
    return _distinct([c[kept] for c in columns], n[kept])


def frequent_windows(batches: Iterator[pa.RecordBatch], longest: int, min_count: int) -> Iterator[pa.RecordBatch]:
    """(lang, w1, .., n) of the blocks of a task, ordered by lang: windows summed and cut to frequent prefixes."""
    names = ["lang", *[f"w{i}" for i in range(1, longest + 1)], "n"]

    def done(lang: str, parts: list) -> Iterator[pa.RecordBatch]:
        columns, n = _to_frequent(*_summed(parts), min_count)
        for i in range(0, len(n), OUT_ROWS):
            rows = [pa.array(c[i : i + OUT_ROWS], mask=c[i : i + OUT_ROWS] < 0) for c in columns]
            own = pa.array([lang]).take(pa.array(np.zeros(len(rows[0]), np.int64)))
            yield pa.RecordBatch.from_arrays([own, *rows, pa.array(n[i : i + OUT_ROWS])], names)

    now, parts, rows, most = None, [], 0, HELD_ROWS
    for batch in batches:
        for lang, size, block in zip(*(batch.column(x) for x in ("lang", "size", "block")), strict=True):
            lang, size = lang.as_py(), size.as_py()
            if parts and lang != now:
                yield from done(now, parts)
                parts, rows, most = [], 0, HELD_ROWS
            now = lang
            parts.append(_unpacked(block.as_buffer(), size, longest))
            rows += size
            if rows > most:
                parts = [_summed(parts)]
                rows = len(parts[0][1])
                most = max(HELD_ROWS, 2 * rows)
    if parts:
        yield from done(now, parts)


def _windows(docs: DataFrame, longest: int, known=None, min_count: int = MIN_COUNT, total: int = 0) -> DataFrame:
    """(lang, w1, .., n): windows of two words or more, padded with nulls, and their counts.

    With ``known`` a window also ends before the first pair of words that is not known, and its words
    are their numbers in ``known``.  Known pairs are counted already: beside them windows have three words
    or more, and end before the first prefix of three or more that occurs under ``min_count`` times.
    ``total`` words of the table set how many tasks find that.
    """
    names = [f"w{i}" for i in range(1, longest + 1)]
    if known is not None:
        tasks = max(1, -(-total // DEALT_WORDS))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return window_blocks(batches, longest, known.value, tasks)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return frequent_windows(batches, longest, min_count)

        blocks = docs.mapInArrow(deal, "task int, lang string, size int, block binary")
        dealt = blocks.repartitionById(tasks, F.col("task")).sortWithinPartitions("lang")
        return dealt.mapInArrow(cut, f"lang string, {', '.join(f'{x} int' for x in names)}, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return window_batches(batches, longest)

    rows = docs.mapInArrow(run, f"lang string, {', '.join(f'{x} string' for x in names)}, n long")
    return rows.groupBy("lang", *names).agg(F.sum("n").alias("n"))


def _spelled(phrases: DataFrame, names: list[str], known) -> DataFrame:
    """``phrases`` (lang, words, k, f) with their words as one text."""
    if known is None:
        return phrases.select("lang", F.concat_ws(" ", *names).alias("phrase"), "k", "f")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in pc.unique(batch.column("lang")):
                own = batch.filter(pc.equal(batch.column("lang"), lang))
                spelled = [known.value.words[lang.as_py()].take(own.column(x)) for x in names]
                phrase = pc.binary_join_element_wise(*spelled, " ", null_handling="skip")
                yield pa.RecordBatch.from_arrays([own.column("lang"), phrase, own.column("k"), own.column("f")], ["lang", "phrase", "k", "f"])

    return phrases.mapInArrow(run, "lang string, phrase string, k int, f long")


def _spelled_pairs(pairs: DataFrame, known) -> DataFrame:
    """``pairs`` (lang, code, n) as phrases (lang, phrase, k, f)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in pc.unique(batch.column("lang")):
                own = batch.filter(pc.equal(batch.column("lang"), lang))
                words = known.value.words[lang.as_py()]
                left, right = np.divmod(own.column("code").to_numpy(zero_copy_only=False), len(words))
                phrase = pc.binary_join_element_wise(words.take(pa.array(left)), words.take(pa.array(right)), " ")
                two = pa.array(np.full(own.num_rows, 2, np.int32))
                yield pa.RecordBatch.from_arrays([own.column("lang"), phrase, two, own.column("n")], ["lang", "phrase", "k", "f"])

    return pairs.select("lang", "code", "n").mapInArrow(run, "lang string, phrase string, k int, f long")


def phrase_counts(docs: DataFrame, words: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, k, f): phrases of two words or more that occur ``min_count`` times or more.

    ``words`` are the counts of all words.  A phrase that is frequent has only frequent words and
    frequent pairs, so a window may end before the first rare pair and every count that is kept
    stays exact.  Frequent words are sent to the tasks where they are ``KNOWN_ROWS`` at most, and with them
    the frequent pairs, as marks where they are more; beyond that many words windows are padded by the ends of
    pieces alone.  Pairs that are sent were counted to find them, so no window of two words is counted again.
    """
    context, known, counted = docs.sparkSession.sparkContext, None, None
    frequent = words.filter(F.col("n") >= min_count)
    if has_at_most(frequent, KNOWN_ROWS):
        vocabulary = _by_lang(frequent.orderBy("lang", F.desc("n"), "word").select("lang", "word").toArrow(), "word")
        known = context.broadcast(Known(vocabulary))
        counted = _staged(_pair_counts(docs, known).filter(F.col("n") >= min_count))
        if has_at_most(counted, KNOWN_ROWS):
            codes = _by_lang(counted.select("lang", "code").toArrow(), "code")
            pairs = {x: np.sort(c.to_numpy(zero_copy_only=False)) for x, c in codes.items()}
        else:
            pairs = _marks(counted)
        known = context.broadcast(Known(vocabulary, pairs))
    names = [f"w{i}" for i in range(1, longest + 1)]
    total = words.agg(F.sum("n")).first()[0] or 0
    top = _windows(docs, longest, known, min_count, total)
    level = F.lit(longest) - F.size(F.array_remove(F.array(*[F.grouping(x) for x in names]), 0))
    sums = top.rollup("lang", *names).agg(F.sum("n").alias("f"), level.alias("k"), F.grouping("lang").alias("all_langs"))
    frequent = sums.filter(
        (F.col("all_langs") == 0) & (F.col("k") >= (2 if counted is None else 3)) & (F.col("f") >= min_count) & F.get(F.array(*names), F.col("k") - 1).isNotNull()
    )
    phrases = _spelled(frequent.select("lang", *names, F.col("k").cast("int").alias("k"), "f"), names, known)
    return phrases if counted is None else phrases.unionByName(_spelled_pairs(counted, known))


def scored(phrases: DataFrame, words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``phrases`` with the counts l and r of their lowest-scoring cut, n and score, in exact integers."""
    single = words.filter(F.col("n") >= min_count).select("lang", F.col("word").alias("phrase"), F.col("n").alias("f"))
    counts = phrases.select("lang", "phrase", "f").unionByName(single)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    parts = phrases.withColumn("w", F.split("phrase", " ")).selectExpr(
        "lang", "phrase", "f AS a", "w", "explode(sequence(1, size(w) - 1)) AS cut"
    ).selectExpr(
        "lang", "phrase", "a", "cut", "array_join(slice(w, 1, cut), ' ') AS head", "array_join(slice(w, cut + 1, size(w)), ' ') AS rest"
    )
    wide = "cast({} AS decimal(19,0)) * cast({} AS decimal(19,0))"
    return (
        parts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
        .join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .join(broadcast_within(totals), "lang")
        .withColumn("score", F.expr(f"({wide.format('1000L * a', 'n')}) div ({wide.format('l', 'r')})"))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("_c"))
        .select("lang", "phrase", "a", "_c.l", "_c.r", "n", "_c.score")
    )


def maximal(phrases: DataFrame, percent: int = ABSORBED) -> DataFrame:
    """``phrases`` without those inside a longer one that has ``percent`` of their count or more."""
    inner = (
        "flatten(transform(sequence(2, size(w) - 1), s -> "
        "transform(sequence(1, size(w) - s + 1), i -> array_join(slice(w, i, s), ' '))))"
    )
    longer = (
        phrases.filter("k > 2")
        .withColumn("w", F.split("phrase", " "))
        .selectExpr("lang", "f", f"explode({inner}) AS phrase")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("_most"))
    )
    return phrases.join(longer, ["lang", "phrase"], "left").filter(f"coalesce(100 * _most < {percent} * f, true)").drop("_most")


def collocations(
    docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP, percent: int = ABSORBED
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of every language.

    Null texts count as empty, a null language is ``und``; copies count each; other columns are
    not read, and an empty table gives an empty result.  The ranking is a limit per language that
    Spark applies before the exchange too.
    """
    docs = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    words = _staged(word_counts(docs))
    phrases = _staged(phrase_counts(docs, words, longest, min_count))
    kept = maximal(phrases, percent).select("lang", "phrase")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored(phrases, words, min_count)
        .join(kept, ["lang", "phrase"], "left_semi")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
