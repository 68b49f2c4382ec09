"""Row counts and column profiles from Parquet footers, without reading data.

Spark answers counts, and minima and maxima of numbers and dates, from footers if its Parquet
reader is the one that aggregates can be pushed to; these jobs use that reader and put the
session's settings back.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from sitelens.operators.quality import PROFILE, named, profile_metrics, profile_rows

_READER = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


@contextmanager
def footer_reader(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in _READER}
    try:
        for k, v in _READER.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def counted(spark: SparkSession, path: str) -> DataFrame:
    """One row with the number of rows; to be planned within ``footer_reader``."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


def row_counts(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, int]:
    """Rows of every table, from its footers."""
    with footer_reader(spark):
        return {name: counted(spark, path).first()["n"] for name, path in paths.items()}


def in_footers(schema: StructType, metric: str) -> bool:
    """Whether footers hold a metric of the profile: counts, and the ranges of dates."""
    return metric[:3] not in ("_lo", "_hi") or isinstance(schema[int(metric[3:])].dataType, DateType)


def footer_profile(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """The profile of tables on disk; only timestamp columns are read, the rest is in the footers."""
    rows: list[tuple] = []
    for name, path in paths.items():
        schema = spark.read.parquet(path).schema
        metrics = profile_metrics(schema)
        held = {k: c for k, c in metrics.items() if in_footers(schema, k)}
        with footer_reader(spark):
            seen = spark.read.parquet(path).agg(*named(held)).first().asDict()
        if rest := {k: c for k, c in metrics.items() if k not in held}:
            seen |= spark.read.parquet(path).agg(*named(rest)).first().asDict()
        rows += profile_rows(name, schema, seen)
    return spark.createDataFrame(rows, PROFILE)
