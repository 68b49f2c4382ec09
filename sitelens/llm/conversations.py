"""Cheapest repair of the turn structure of conversations, with the edits as an audit string.

A repaired conversation has roles ``s?(ua)+`` or no rows.  Rows become symbols (role, fault); equal
neighbours collapse to runs.  Cost vectors over the four states of the pattern travel backwards,
each run in one product with cached binary powers of its symbol's min-plus matrix.  The audit is
then unrolled forwards, run by run.

Rows of one conversation are turned into runs in parallel, by blocks of turns; what meets in one
task per conversation are runs (two numbers each), and later its rows as a stream, one at a time,
because the result holds one string per conversation and one digest of its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.scale import null_safe_join, staged

#: turns per block
BLOCK = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

START, S, U, A = range(4)
#: the state after a user or assistant row that is put there
_NEXT = (U, U, A, U)
#: role class (s, u, a, other) -> state -> state after keeping such a row
_KEPT = ({START: S}, {START: U, S: U, A: U}, {U: A}, {})
_ROLES = {U: "user", A: "assistant"}
#: faults: none, truncated, and those that must be deleted
FINE, CUT_OFF, GONE = range(3)
_NEVER = 1 << 60
Vector = tuple[int, ...]


def _times(m: tuple[Vector, ...], v: Vector) -> Vector:
    return tuple(min(a + b for a, b in zip(row, v)) for row in m)


def _after_inserts(v: Vector) -> Vector:
    """Costs when empty rows may be put in first; two in a row lead back, so two rounds do."""
    for _ in range(2):
        v = tuple(min(c, INSERT + v[_NEXT[q]]) for q, c in enumerate(v))
    return v


#: costs of ending in each state
END: Vector = _after_inserts((0, _NEVER, _NEVER, 0))


def _options(symbol: int, q: int) -> Iterator[tuple[str, int, int]]:
    """(edit, its cost, next state) for a row of this symbol."""
    role, fault = divmod(symbol, 3)
    yield "D", DELETE, q
    if fault != GONE:
        extra = TRUNCATED if fault == CUT_OFF else 0
        if q in _KEPT[role]:
            yield "K", KEEP + extra, _KEPT[role][q]
        yield "R", REROLE + extra, _NEXT[q]


@cache
def power(symbol: int, bit: int) -> tuple[Vector, ...]:
    """Min-plus matrix of ``2 ** bit`` rows of this symbol, inserted rows included."""
    if bit:
        half = power(symbol, bit - 1)
        columns = [_times(half, tuple(row[j] for row in half)) for j in range(4)]
    else:
        columns = []
        for j in range(4):
            goal = [0 if q == j else _NEVER for q in range(4)]
            row = tuple(min(cost + goal[to] for _, cost, to in _options(symbol, q)) for q in range(4))
            columns.append(_after_inserts(row))
    return tuple(tuple(min(_NEVER, c[q]) for c in columns) for q in range(4))


def before_run(symbol: int, length: int, v: Vector) -> Vector:
    bit = 0
    while length >> bit:
        if length >> bit & 1:
            v = _times(power(symbol, bit), v)
        bit += 1
    return v


@cache
def _step(symbol: int, v: Vector) -> Vector:
    v = _times(power(symbol, 0), v)
    least = min(v)
    return tuple(c - least for c in v)


@cache
def _choice(symbol: int, v: Vector, q: int) -> tuple[str, int]:
    """Least of the cheapest edits of one row and what is put in before it, given the costs after it."""
    best, out = _times(power(symbol, 0), v), ""
    while True:
        ways = [(edit, to, False) for edit, cost, to in _options(symbol, q) if cost + v[to] == best[q]]
        if INSERT + best[_NEXT[q]] == best[q]:
            ways.append(("I", _NEXT[q], True))
        edit, q, more = min(ways)
        out += edit
        if not more:
            return out, q


def _closing(q: int) -> str:
    out = ""
    while q not in (START, A):
        out, q = out + "I", _NEXT[q]
    return out


def cheapest(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """Cost and audit of a conversation given as (symbol, length) runs."""
    after = [END]
    for symbol, length in reversed(runs):
        after.append(before_run(symbol, length, after[-1]))
    cost, q, audit = after.pop()[START], START, []
    for symbol, length in runs:
        v = after.pop()
        least = min(v)
        chain = [tuple(c - least for c in v)]
        while len(chain) < length and (len(chain) < 2 or chain[-1] != chain[-2]):
            chain.append(_step(symbol, chain[-1]))
        for left in range(length - 1, -1, -1):
            piece, q = _choice(symbol, chain[min(left, len(chain) - 1)], q)
            audit.append(piece)
    audit.append(_closing(q))
    return cost, "".join(audit)


def lines_of(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """conv_id, turn, role, text, copies, digest: equal rows are one line with their number.

    Null roles and texts are one space.  ``copies`` names a column with the number of times a row
    counts; a row that counts zero times only makes its conversation known.
    """
    spaced = [F.coalesce(F.col(x).cast("string"), F.lit(" ")).alias(x) for x in ("role", "text")]
    weight = F.col(copies) if copies else F.lit(1)
    lines = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *spaced, weight.cast("long").alias("copies"))
    lines = lines.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    return lines.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _symbols(lines: DataFrame) -> DataFrame:
    """Per line: the symbol of its first copy; later copies are duplicates."""
    blanks = "' \\t\\n\\u000b\\f\\r'"
    live = lines.filter("copies > 0").selectExpr(
        "conv_id",
        "turn",
        "role",
        "digest",
        "copies",
        f"trim(TRAILING {blanks} FROM text) AS body",
    ).selectExpr(
        "conv_id",
        "turn",
        "role",
        "digest",
        "copies",
        "body = '' AS blank",
        "right(body, 1) NOT IN ('.', '!', '?') AS open",
        "cast(instr('sua', left(role, 1)) AS int) AS class",
        "floor(turn / " + str(BLOCK) + ") AS block",
    )
    first = live.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    met = null_safe_join(live, first, ["conv_id", "role", "digest"])
    return met.selectExpr(
        "conv_id",
        "block",
        "turn",
        "role",
        "digest",
        "copies",
        "CASE WHEN role = '' OR class = 0 THEN 3 ELSE class - 1 END AS class",
        f"CASE WHEN blank THEN 'blank' WHEN NOT turn <=> first.turn THEN 'duplicate' WHEN open THEN 'truncated' ELSE 'none' END AS fault",
    )


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of sorted batches by key, as a stream: a group is read before the next one is asked for."""
    rows = (row for batch in batches for row in batch.to_pylist())
    row = next(rows, None)
    while row is not None:
        key = tuple(row[k] for k in keys)

        def group():
            nonlocal row
            while row is not None and tuple(row[k] for k in keys) == key:
                yield row
                row = next(rows, None)

        yield key, (own := group())
        for _ in own:
            pass


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Batches of rows; long strings end a batch early."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(x) for x in row if isinstance(x, (str, bytes, list)))
        if len(held) >= size or weight >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _runs(rows: DataFrame, kind: str) -> DataFrame:
    """One row per conversation and block: its runs, counts, turns and outer role classes."""
    counts = ["blank", "duplicate", "truncated", "illegal", "turns", "low", "high"]
    schema = f"conv_id {kind}, block long, symbols array<int>, lengths array<long>, ends array<int>, {', '.join(f'{c} long' for c in counts)}"

    def block(key: tuple, group: Iterator[dict]) -> tuple:
        symbols: list[int] = []
        lengths: list[int] = []
        n = dict.fromkeys(["blank", "duplicate", "truncated", "none"], 0)
        illegal = turns = 0
        first = last = low = turn = None
        for row in group:
            role, copies, fault = row["class"], row["copies"], row["fault"]
            again = copies if fault in ("blank", "duplicate") else copies - 1
            n[fault] += copies - again
            n["blank" if fault == "blank" else "duplicate"] += again
            new = [(3 * role + (CUT_OFF if fault == "truncated" else FINE), copies - again), (3 * role + GONE, again)]
            for symbol, length in new:
                if length and symbols and symbols[-1] == symbol:
                    lengths[-1] += length
                elif length:
                    symbols.append(symbol)
                    lengths.append(length)
            illegal += copies - 1 + (last is not None and (last, role) not in _LEGAL)
            first, last = role if first is None else first, role
            if row["turn"] is not None and row["turn"] != turn:
                turn, turns = row["turn"], turns + 1
                low = turn if low is None else low
        return (*key, symbols, lengths, [first, last], n["blank"], n["duplicate"], n["truncated"], illegal, turns, low, turn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_id, batches = _peeked(batches)
        if of_id is not None:
            fields = [("conv_id", of_id), ("block", pa.int64()), ("symbols", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int64()))]
            fields += [("ends", pa.list_(pa.int32())), *[(c, pa.int64()) for c in counts]]
            yield from _batches((block(k, g) for k, g in _grouped(batches, ["conv_id", "block"])), pa.schema(fields))

    ordered = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role", "digest")
    return ordered.mapInArrow(run, schema)


def _peeked(batches: Iterator[pa.RecordBatch]) -> tuple[pa.DataType | None, Iterator[pa.RecordBatch]]:
    """Type of conv_id, and the batches."""
    head = next(batches, None)
    if head is None:
        return None, iter(())

    def whole():
        yield head
        yield from batches

    return head.schema.field("conv_id").type, whole()


_STATS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def audits(lines: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation with rows."""
    kind = lines.schema["conv_id"].dataType.simpleString()

    def whole(conv, group: Iterator[dict]) -> tuple:
        runs: list[tuple[int, int]] = []
        n = dict.fromkeys(["blank", "duplicate", "truncated", "illegal", "turns"], 0)
        last = low = high = None
        for row in group:
            for symbol, length in zip(row["symbols"], row["lengths"]):
                if runs and runs[-1][0] == symbol:
                    length += runs.pop()[1]
                runs.append((symbol, length))
            for c in n:
                n[c] += row[c]
            if last is not None:
                n["illegal"] += (last, row["ends"][0]) not in _LEGAL
            last = row["ends"][1]
            if row["low"] is not None:
                low, high = row["low"] if low is None else low, row["high"]
        gaps = 0 if low is None else high - low + 1 - n["turns"]
        cost, audit = cheapest(runs)
        return conv, gaps, n["blank"], n["duplicate"], n["truncated"], n["illegal"], cost, audit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_id, batches = _peeked(batches)
        if of_id is not None:
            schema = pa.schema([("conv_id", of_id), *[(c, pa.int64()) for c in _STATS], ("audit", pa.string())])
            yield from _batches((whole(k[0], g) for k, g in _grouped(batches, ["conv_id"])), schema)

    ordered = _runs(_symbols(lines), kind).repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return ordered.mapInArrow(run, f"conv_id {kind}, {', '.join(f'{c} long' for c in _STATS)}, audit string")


def _replay(audit: str, group: Iterator[dict]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation, row by row."""
    q, edits = START, iter(audit)
    for row in group:
        for _ in range(row["copies"]):
            while (edit := next(edits)) == "I":
                q = _NEXT[q]
                yield _ROLES[q], ""
            if edit == "K":
                q = _KEPT["sua".index(row["role"][0])][q]
                yield row["role"], row["text"]
            elif edit == "R":
                q = _NEXT[q]
                yield _ROLES[q], row["text"]
    for _ in edits:
        q = _NEXT[q]
        yield _ROLES[q], ""


def _replayed(lines: DataFrame, found: DataFrame, make: Callable, fields: list[tuple[str, pa.DataType]], ddl: str) -> DataFrame:
    """``make(audit row, repaired rows)`` of every conversation, its lines read once as a sorted stream."""
    kind = lines.schema["conv_id"].dataType.simpleString()
    heads = found.selectExpr("conv_id", f"array({', '.join(_STATS)}) AS stats", "audit AS text")
    both = heads.unionByName(lines.filter("copies > 0"), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_id, batches = _peeked(batches)
        if of_id is None:
            return

        def rows():
            for (conv,), group in _grouped(batches, ["conv_id"]):
                head = next(group)
                yield from ((conv, *out) for out in make(head, _replay(head["text"], group)))

        yield from _batches(rows(), pa.schema([("conv_id", of_id), *fields]))

    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", F.col("stats").isNull(), "turn", "role", "digest")
    return ordered.mapInArrow(run, f"conv_id {kind}, {ddl}")


def messages(rows: DataFrame) -> DataFrame:
    """conv_id, seq, role, text: the repaired conversations as rows, ``seq`` from 0."""
    lines = staged(lines_of(rows))
    fields = [("seq", pa.int64()), ("role", pa.string()), ("text", pa.string())]

    def make(head: dict, repaired: Iterator[tuple[str, str]]) -> Iterator[tuple]:
        for seq, (role, text) in enumerate(repaired):
            yield seq, role, text

    return _replayed(lines, audits(lines), make, fields, "seq long, role string, text string")


def repairs(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 per conversation.

    Rows are ordered by turn (nulls first); rows of one turn by role and SHA-256 of the text, so
    the result does not depend on the input's order.  Equal rows count one by one, the later ones
    as duplicates.  A null conv_id is a conversation of its own; an empty role or one that does not
    start with s, u or a cannot be kept.  Texts may be of any length: they pass one at a time.  An
    empty table gives an empty result, other columns are not read.
    """
    lines = staged(lines_of(rows, copies))
    fields = [*[(c, pa.int64()) for c in _STATS], ("audit", pa.string()), ("repaired_sha256", pa.string())]

    def make(head: dict, repaired: Iterator[tuple[str, str]]) -> Iterator[tuple]:
        digest, between = hashlib.sha256(), ""
        for role, text in repaired:
            digest.update(f"{between}{role}:{text}".encode())
            between = "\n"
        yield *head["stats"], head["text"], digest.hexdigest()

    done = _replayed(lines, audits(lines), make, fields, f"{', '.join(f'{c} long' for c in _STATS)}, audit string, repaired_sha256 string")
    none = lines.groupBy("conv_id").agg(F.sum("copies").alias("n")).filter("n = 0")
    empty = none.select("conv_id", *[F.lit(0).cast("long").alias(c) for c in _STATS], F.lit("").alias("audit"), F.sha2(F.lit(""), 256).alias("repaired_sha256"))
    return done.unionByName(empty)


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: conversations damaged by a checksum of ``conv_id:turn``.

    Of twenty residues 0 drops a row, 1 empties its text, 2 takes its sentence ends, 3 repeats it
    and 4 makes it the user's; nulls are one space.
    """
    text, role = (F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("text", "role"))
    key = F.concat_ws(":", *[F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", "turn")])
    kind = F.crc32(key) % 20
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def repaired(rows: DataFrame) -> DataFrame:
    """Repairs of the damaged ``rows``."""
    return repairs(damaged(rows), "copies")
