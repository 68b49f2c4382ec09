"""Benchmark decontamination by winnowing (DataFrame functions only).

A window is ``width`` consecutive words of an item (the whole item where it has fewer words).
Of the ``width - gram + 1`` word n-grams in every window of a document the one of smallest hash
is a fingerprint.  A shared window has the same smallest n-gram on both sides, so every
occurrence of a window of the benchmark is met; hits are extended to the whole window and held
against its words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.scale import broadcast_within, staged
from sitelens.llm.keys import keyed

WIDTH, GRAM = 10, 5
#: low bits of a fingerprint that hold the position; a Spark string has fewer words than that
PLACE_BITS = 30
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def plain_words(text: str):
    """Words of a text column with A-Z in lower case; none where it is null."""
    lowered = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, _SEPARATORS), "")


def _grams(words: str, gram: int) -> str:
    """SQL: per position the hash of the n-gram that starts there, the position in its low bits."""
    parts = ", ".join(["w", *[f"get(x, i + {j})" for j in range(1, gram)]])
    hashed = f"(xxhash64({parts}) & {-(1 << PLACE_BITS)}L) | cast(i AS bigint)"
    return f"transform(array({words}), x -> transform(slice(x, 1, greatest(size(x) - {gram - 1}, 0)), (w, i) -> {hashed}))[0]"


def fingerprints(words: str, width: int, gram: int) -> str:
    """SQL: the distinct smallest n-grams (leftmost of equal ones) of all windows of ``width`` words."""
    span = width - gram + 1
    if span == 1:
        return _grams(words, gram)
    least = f"array_min(slice(v, i + 1, {span}))"
    windows = f"transform(slice(v, 1, greatest(size(v) - {span - 1}, 0)), (y, i) -> {least})"
    return f"transform(array({_grams(words, gram)}), v -> array_distinct({windows}))[0]"


def _hash(column: str):
    return F.shiftrightunsigned(column, PLACE_BITS)


def _place(column: str):
    return F.col(column).bitwiseAND((1 << PLACE_BITS) - 1).cast("int")


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (win, m, g) and groups (g, items): ``g`` stands for the items that hold a window.

    Items with equal ids are one item; a null id is written as an empty string.
    """
    words = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), plain_words("text").alias("w")
    ).filter("size(w) > 0")
    wins = words.select("item", "w", F.least(F.size("w"), F.lit(width)).alias("m")).selectExpr(
        "item", "m", "explode(transform(sequence(1, size(w) - m + 1), i -> array_join(slice(w, i, m), ' '))) AS win"
    )
    held = staged(wins.groupBy("win", "m").agg(F.sort_array(F.collect_set("item")).alias("items")))
    groups = staged(held.select("items").distinct().withColumn("g", F.monotonically_increasing_id()))
    return staged(held.join(groups, "items").select("win", "m", "g")), groups


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids, as strings) per document.

    ``n_hit`` counts the words inside any occurrence of a window of ``benchmark``.  Null and
    empty texts have no words; rows that repeat a doc_id are documents of their own; an empty
    benchmark hits nothing, an empty table gives an empty result.  Other columns are dropped.

    Fingerprints leave the text pass as one staged array per document and are joined to the
    distinct (hash, offset) of the windows: a fingerprint has at most ``width - gram + 1``
    offsets, whatever number of items holds it.  Only documents with a candidate are read
    again.  Documents that hold the same windows share one list of items, so a passage that a
    third of all documents and items share is joined once per set of windows, not per pair.
    """
    windows, groups = benchmark_windows(benchmark, width)
    lengths = sorted(r.m for r in windows.select("m").distinct().collect())  # at most ``width`` values
    plans = [(m, gram if m == width else m) for m in lengths]
    documents = keyed(docs).select("_key", "doc_id", "text")
    marks = [f"{fingerprints('w', m, k)} AS fp{m}" for m, k in plans]
    sketched = staged(
        documents.select("_key", "doc_id", plain_words("text").alias("w")).selectExpr(
            "_key", "doc_id", "cast(size(w) AS bigint) AS n_words", *marks
        )
    )
    empty = F.array().cast("array<string>")
    if not plans:
        return sketched.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), empty.alias("items"))

    starts = None
    for m, k in plans:
        own = windows.filter(F.col("m") == m).selectExpr(f"array_min({_grams("split(win, ' ')", k)}) AS v")
        known = staged(own.select(_hash("v").alias("h"), _place("v").alias("offset")).distinct())
        met = (
            sketched.select("_key", "n_words", F.explode(f"fp{m}").alias("v"))
            .select("_key", "n_words", _hash("v").alias("h"), _place("v").alias("at"))
            .join(broadcast_within(known), "h")
            .select("_key", "n_words", (F.col("at") - F.col("offset")).alias("start"), F.lit(m).alias("m"))
            .filter(f"start >= 0 AND start + {m} <= n_words")
        )
        starts = met if starts is None else starts.unionByName(met)
    candidates = staged(starts.groupBy("_key").agg(F.collect_set(F.struct("start", "m")).alias("starts")))

    reread = documents.join(broadcast_within(candidates.select("_key")), "_key", "left_semi")
    occurrences = (
        reread.join(candidates, "_key")
        .select("_key", "starts", plain_words("text").alias("w"))
        .selectExpr(
            "_key",
            "inline(transform(starts, s -> named_struct('start', s.start, 'm', s.m, 'win', array_join(slice(w, s.start + 1, s.m), ' '))))",
        )
        .join(broadcast_within(windows), ["win", "m"])
    )
    covered = (
        "aggregate(sort_array(spans), named_struct('n', 0L, 'upto', 0L), (a, s) -> named_struct("
        "'n', a.n + greatest(0L, s.start + s.m - greatest(a.upto, s.start)), 'upto', greatest(a.upto, s.start + s.m)), a -> a.n)"
    )
    hits = staged(
        occurrences.groupBy("_key")
        .agg(
            F.expr("collect_list(named_struct('start', cast(start AS bigint), 'm', cast(m AS bigint)))").alias("spans"),
            F.sort_array(F.collect_set("g")).alias("held"),
        )
        .select("_key", F.expr(covered).alias("n_hit"), "held")
    )
    lists = (
        hits.select("held")
        .distinct()
        .select("held", F.explode("held").alias("g"))
        .join(groups, "g")
        .groupBy("held")
        .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    )
    return (
        sketched.select("_key", "doc_id", "n_words")
        .join(hits.join(lists, "held").select("_key", "n_hit", "items"), "_key", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", empty).alias("items"),
        )
    )
