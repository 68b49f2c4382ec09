"""One integer per row that keeps the order of doc_id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.scale import staged


def keyed(docs: DataFrame, carry: bool = False) -> DataFrame:
    """``docs`` reduced to ``_key, doc_id, text``; ``_key`` is unique and ordered by doc_id.

    Where doc_id has neither nulls nor repeats it is the key itself.  Otherwise rows are
    ordered by (doc_id, nulls first; text, nulls first), and rows with one doc_id count as
    separate documents in that order.  Other columns are dropped, or with ``carry`` kept in
    the struct ``_row``, where their names cannot clash.
    """
    rest = [c for c in docs.columns if c != "text"]
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *([F.struct(*rest).alias("_row")] if carry else []),
    )
    repeated = docs.groupBy("doc_id").count().filter("doc_id IS NULL OR count > 1")
    if repeated.isEmpty():
        return docs.withColumn("_key", F.col("doc_id"))
    ordered = docs.orderBy(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return staged(ordered.withColumn("_key", F.monotonically_increasing_id()))


def restored(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The documents that ``keyed(..., carry=True)`` took apart, in the order of ``columns``."""
    return rows.select(*[F.col("text") if c == "text" else F.col("_row")[c].alias(c) for c in columns])
