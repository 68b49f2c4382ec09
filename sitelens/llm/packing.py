"""Tokenised documents packed into fixed-length sequences by a histogram of lengths."""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.scale import staged
from sitelens.llm.text import flat

SEQUENCE, END_ID = 2048, 1
CACHED_WORDS = 300_000
#: bytes of ids that a task hands over at once
HELD_BYTES = 1 << 24
RANK_BUCKETS = 64


class WordTokenizer:
    """Ids of a word-level BPE file, with a memory of words.

    The file's pre-tokenizer never joins across white space, and its normalizer works on
    characters, so the ids of a text are those of its words.  A text of plain characters is
    lower-cased and split here, and only words not met lately go to the model; any other text
    goes chunk by chunk, its odd chunks through the library's full path.  The memory is
    bounded by dropping the older half, which changes speed only.
    """

    MARKS = "¡«»¿–—‘’“”…€"
    LETTERS = "a-zß-öø-ÿ"
    PLAIN = re.compile(f"[ \t\n\r\x0b\x0c!-~À-ÖØ-öø-ÿ{MARKS}]*")
    PIECE = re.compile(f"[{LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^ \t\n\r\x0b\x0c0-9{LETTERS}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.tokenize = self.whole.model.tokenize
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # how the byte-level step writes each character, asked of the library itself
        plain = [*map(chr, range(33, 127)), *map(chr, range(0xC0, 0x100)), *self.MARKS]
        self.shown = {ord(c): "".join(p for p, _ in level.pre_tokenize_str(c)) for c in plain}
        self.new: dict = {}
        self.old: dict = {}

    def _word(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = array("I", [t.id for t in self.tokenize(word.translate(self.shown))]).tobytes()
        return self._keep(word, ids)

    def _keep(self, word: str | bytes, ids: bytes) -> bytes:
        if len(self.new) >= CACHED_WORDS:
            self.new, self.old = {}, self.new
        if len(word) <= 64:
            self.new[word] = ids
        return ids

    def _chunk(self, chunk: bytes) -> bytes:
        ids = self.new.get(chunk) or self.old.get(chunk)
        if ids is None:
            text = chunk.decode("utf-8", "replace")
            if self.PLAIN.fullmatch(text) and "<|" not in text:
                return self._plain(text)
            ids = array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        return self._keep(chunk, ids)

    def _plain(self, text: str) -> bytes:
        words = self.PIECE.findall(text.lower())
        for word in set(words).difference(self.new):
            self._word(word)
        out = list(map(self.new.get, words))
        if None in out:  # long words, or the memory was just halved
            out = [ids or self._word(word) for word, ids in zip(words, out)]
        return b"".join(out)

    def encode(self, raw: bytes) -> bytes:
        """The ids as unsigned 32-bit integers in the machine's (little-endian) order."""
        text = raw.decode("utf-8", "replace")
        if self.PLAIN.fullmatch(text) and "<|" not in text:
            return self._plain(text)
        return b"".join(map(self._chunk, raw.split()))


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker and file, kept between tasks."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, path: str, size: int = SEQUENCE, end_id: int = END_ID, with_ids: str | None = None) -> DataFrame:
    """Each document's ids, then ``end_id``, cut every ``size``; a null text has only ``end_id``.

    ``with_ids`` adds the ids as integers of that numpy type (``"<u2"``, ``"<u4"``); ids that do
    not fit raise an error.  They are narrowed here: a second Python step behind this one would
    take a worker of its own per task, and in time each worker holds a tokenizer and its memory.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode
        for batch in batches:
            offsets, data = flat(batch.column("text"))
            raw = memoryview(data)
            out: list[list] = [[] for _ in range(6)]
            held = 0
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                ids = encode(bytes(raw[offsets[i] : offsets[i + 1]])) + end
                tokens = len(ids) // 4
                slim = narrowed(ids) if with_ids else b""
                width = len(slim) // tokens
                for start in range(0, tokens, size):
                    part = ids[4 * start : 4 * (start + size)]
                    row = (doc, start, len(part) // 4, zlib.crc32(part), tokens, slim[width * start : width * (start + size)])
                    for column, value in zip(out, row):
                        column.append(value)
                held += len(slim)
                if held > HELD_BYTES:
                    yield table(out)
                    out, held = [[] for _ in range(6)], 0
            yield table(out)

    def narrowed(raw: bytes) -> bytes:
        ids = np.frombuffer(raw, "<u4")
        if ids.max() > np.iinfo(with_ids).max:
            raise ValueError(f"ids beyond {with_ids}")
        return ids.astype(with_ids).tobytes()

    def table(out: list[list]) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in out[:5]] + ([pa.array(out[5], pa.binary())] if with_ids else [])
        return pa.RecordBatch.from_arrays(columns, names)

    schema = PIECES + (", ids binary" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, schema)


def patterns(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, dict[int, int]]]:
    """Shortest-pack-first over the histogram: (number of sequences, copies by length) per pattern.

    Lengths are placed longest first.  Each goes to the open pattern with the most room, as
    often as that pattern has sequences; a pattern that meets fewer pieces than it has
    sequences splits its count in two.  A length that fits nowhere opens sequences that hold
    as many of it as fit.  The input is bounded by ``size`` entries whatever the corpus.
    """
    room: dict[int, list[tuple[int, dict[int, int]]]] = {}
    done: list[tuple[int, dict[int, int]]] = []

    def put(space: int, count: int, held: dict[int, int]) -> None:
        if count:
            (room.setdefault(space, []) if space else done).append((count, held))

    for length in sorted((x for x in histogram if histogram[x]), reverse=True):
        left = histogram[length]
        while left and room and (space := max(room)) >= length:
            count, held = room[space].pop()
            if not room[space]:
                del room[space]
            # as many copies at once as keep this pattern the one with the most room
            rival = max(room, default=0)
            copies = max(1, min((space - max(rival, length - 1)) // length, left // count)) if count <= left else 1
            used = min(count, left // copies)
            put(space, count - used, held)
            put(space - copies * length, used, {**held, length: held.get(length, 0) + copies})
            left -= used * copies
        if left:
            each = size // length
            put(size - each * length, left // each, {length: each})
            if left % each:
                put(size - left % each * length, 1, {length: left % each})
    return done + [x for rows in room.values() for x in rows]


def slots(found: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, copies, first sequence, offset): where each length's ranks go."""
    next_rank: Counter = Counter()
    out, sequence = [], 0
    for count, held in found:
        offset = 0
        for length, copies in sorted(held.items(), reverse=True):
            out.append((length, next_rank[length], count * copies, copies, sequence, offset))
            next_rank[length] += count * copies
            offset += length * copies
        sequence += count
    return out


def ranked(df: DataFrame, key: str, *order: str) -> DataFrame:
    """``df`` with ``rank`` 0, 1, ... inside each ``key``, without a key in one task.

    Rows of a key are dealt over hash buckets; a window numbers them inside (key, bucket), and
    the buckets' counts, summed up per key, give each bucket its first rank.
    """
    dealt = df.withColumn("_bucket", F.expr(f"pmod(xxhash64({', '.join(order)}), {RANK_BUCKETS})"))
    counts = dealt.groupBy(key, "_bucket").agg(F.count("*").alias("_n"))
    first = counts.selectExpr(
        f"{key} AS _k", "_bucket AS _b", f"sum(_n) OVER (PARTITION BY {key} ORDER BY _bucket) - _n AS _first"
    )
    numbered = dealt.selectExpr(
        "*", f"row_number() OVER (PARTITION BY {key}, _bucket ORDER BY {', '.join(order)}) - 1 AS _own"
    )
    return (
        numbered.join(first, (F.col(key) == F.col("_k")) & (F.col("_bucket") == F.col("_b")))
        .withColumn("rank", F.expr("_first + _own"))
        .drop("_k", "_b", "_bucket", "_first", "_own")
    )


def pack(cut: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``cut`` (any rows with ``length`` from 1 to ``size``) with ``sequence_id`` and ``offset``.

    The histogram of lengths, at most ``size`` rows, is solved on the driver; its slots are
    joined back to the rows by (length, rank).  Sequences are gapless from 0, and so are the
    offsets inside each.  ``cut`` must be a written table: it is read twice.
    """
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(patterns(histogram, size))
    schema = "_length long, _rank0 long, _ranks long, _copies long, _sequence0 long, _offset0 long"
    # as ranges per length; a slot is found by the blocks of ranks it overlaps
    block = 4096
    where = spark.createDataFrame(table, schema).withColumn(
        "_block", F.explode(F.expr(f"sequence(_rank0 div {block}, (_rank0 + _ranks - 1) div {block})"))
    )
    rows = ranked(cut, "length", *cut.columns).withColumn("_b", F.expr(f"rank div {block}"))
    return (
        rows.join(
            where,
            (F.col("length") == F.col("_length"))
            & (F.col("_b") == F.col("_block"))
            & (F.col("rank") >= F.col("_rank0"))
            & (F.col("rank") < F.col("_rank0") + F.col("_ranks")),
        )
        .withColumn("sequence_id", F.expr("_sequence0 + (rank - _rank0) div _copies"))
        .withColumn("offset", F.expr("_offset0 + ((rank - _rank0) % _copies) * length"))
        .select(*cut.columns, "sequence_id", "offset")
    )


def packed_documents(docs: DataFrame, path: str, size: int = SEQUENCE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Texts are tokenised once; the small table of pieces is staged.  Empty and null texts are
    one piece (the end id).  Rows that repeat a doc_id are packed each on its own.  An empty
    table gives no rows.
    """
    return pack(staged(pieces(docs, path, size)), size)
