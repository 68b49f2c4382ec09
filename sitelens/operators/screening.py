"""Checks over written answers and documents, on whole texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions.measures import share_pct
from sitelens.functions.text import contains_folded, mentions, text_blocks


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def banned_phrases(answers: DataFrame, phrases: Sequence[str], text: str = "text") -> DataFrame:
    """Each answer with the first banned phrase it contains; NULL when it passes."""
    hits = F.filter(_texts(phrases), lambda p: contains_folded(F.col(text), p))
    return answers.withColumn("banned", F.try_element_at(hits, F.lit(1))).withColumn(
        "passed", F.col("banned").isNull()
    )


def phrase_counts(answers: DataFrame, phrases: Sequence[str], text: str = "text") -> DataFrame:
    """Answers containing each phrase; every phrase found in an answer counts."""
    hits = F.filter(_texts(phrases), lambda p: contains_folded(F.col(text), p))
    return (
        answers.select(F.explode(hits).alias("phrase")).groupBy("phrase").agg(F.count("*").alias("answers"))
    )


def pass_rates(screened: DataFrame, kind: str) -> DataFrame:
    return screened.groupBy(kind).agg(
        F.count_if("passed").alias("passed"),
        F.count("*").alias("total"),
        F.round(share_pct(F.count_if("passed"), F.count("*")), 4).alias("pct_passed"),
    )


def classify(
    answers: DataFrame,
    entities: Sequence[str],
    markers: dict[str, Sequence[str]],
    text: str = "text",
    head_chars: int | None = None,
) -> DataFrame:
    """The entity an answer recommends and which marker groups it uses.

    The pick is the entity mentioned most, the earliest on a tie.  ``head_chars``
    limits the search for the pick to the opening of the text; by default the whole
    text counts.
    """
    opening = F.col(text) if head_chars is None else F.substring(text, 1, head_chars)
    scored = F.transform(
        _texts(entities),
        lambda e: F.struct(
            mentions(opening, e).alias("count"),
            (-F.position(e, opening)).alias("earliness"),
            e.alias("entity"),
        ),
    )
    best = F.array_max(F.filter(scored, lambda s: s["count"] > 0))
    return answers.select(
        "*",
        best["entity"].alias("recommendation"),
        *[
            F.exists(_texts(words), lambda m: contains_folded(F.col(text), m)).alias(flag)
            for flag, words in markers.items()
        ],
    )


def consensus(classified: DataFrame, column: str = "recommendation") -> DataFrame:
    """The most frequent pick and its share of all answers; ties by name."""
    counts = classified.groupBy(column).agg(F.count("*").alias("votes"))
    total = classified.agg(F.count("*")).scalar()
    picked = counts.filter(F.col(column).isNotNull()).orderBy(F.desc("votes"), column).limit(1)
    return picked.select(
        F.col(column).alias("consensus"), "votes", F.round(share_pct(F.col("votes"), total) / 100, 4).alias("rate")
    )


def _names(entities: Sequence[str], part: Column) -> Column:
    return F.exists(_texts(entities), lambda e: F.contains(part, e))


def without_named_blocks(
    documents: DataFrame,
    entities: Sequence[str],
    boundary: str,
    heading: str,
    text: str = "text",
) -> DataFrame:
    """Drop the headed blocks that name an entity and report what is left.

    ``boundary`` splits a text into blocks, ``heading`` is the pattern a block must
    start with to be removable.  Lines that still name an entity are counted.
    """
    removable = lambda b: F.regexp_like(b, F.lit(f"^(?:{heading})")) & _names(entities, b)
    split = documents.withColumn("_blocks", text_blocks(F.col(text), boundary))
    kept = split.withColumn("cleaned", F.array_join(F.filter("_blocks", lambda b: ~removable(b)), "\n"))
    return kept.withColumn("n_blocks", F.size("_blocks").cast("long")).withColumn(
        "removed_blocks", F.size(F.filter("_blocks", removable)).cast("long")
    ).withColumn(
        "residual_lines", F.size(F.filter(F.split("cleaned", "\n"), lambda x: _names(entities, x))).cast("long")
    ).drop("_blocks")


def residual_mentions(
    documents: DataFrame,
    entities: Sequence[str],
    boundary: str,
    heading: str,
    text: str = "text",
) -> DataFrame:
    """(doc_id, kind, position, text): what was removed, and what still names an entity, in full.

    ``removed_block`` rows hold the first line of a removed block and the block's number;
    ``residual_line`` rows a line of the cleaned text that names an entity, and its number.  Both
    count from 1.  A document whose text is null has neither.
    """
    removable = F.regexp_like("part", F.lit(f"^(?:{heading})")) & _names(entities, F.col("part"))
    blocks = documents.select("doc_id", F.posexplode(text_blocks(F.col(text), boundary)).alias("at", "part")).filter(removable)
    cleaned = without_named_blocks(documents.select("doc_id", text), entities, boundary, heading, text)
    lines = cleaned.select("doc_id", F.posexplode(F.split("cleaned", "\n")).alias("at", "part")).filter(_names(entities, F.col("part")))

    def rows(df: DataFrame, kind: str, shown: Column) -> DataFrame:
        return df.select("doc_id", F.lit(kind).alias("kind"), (F.col("at") + 1).cast("long").alias("position"), F.trim(shown).alias("text"))

    return rows(blocks, "removed_block", F.split("part", "\n")[0]).unionByName(rows(lines, "residual_line", F.col("part")))
