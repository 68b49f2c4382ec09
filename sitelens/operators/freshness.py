"""How old is each source, and is the last build too old to be trusted?"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.temporal import days_between


class Source(NamedTuple):
    """A table with its event date and the column new rows are recognised by."""

    name: str
    df: DataFrame
    event_column: str | None
    landing_column: str


def build_metadata(sources: Sequence[Source], built_at: datetime) -> DataFrame:
    """Row count and newest event per source, from one pass over each."""
    rows = []
    for s in sources:
        newest = F.to_date(F.max(s.event_column)) if s.event_column else F.lit(None).cast("date")
        rows.append(
            s.df.agg(F.count("*").alias("row_count"), newest.alias("max_event_date")).select(
                F.lit(built_at).cast("timestamp_ntz").alias("built_at"),
                F.lit(f"raw.{s.name}").alias("source_table"),
                "row_count",
                F.lit(s.event_column).cast("string").alias("event_column"),
                "max_event_date",
                F.lit(s.landing_column).alias("incremental_column"),
            )
        )
    stacked = reduce(DataFrame.unionByName, rows)
    today = F.lit(built_at.date())
    return stacked.withColumn("days_behind_today", days_between(F.col("max_event_date"), today))


def stale_builds(metadata: DataFrame, now: datetime, max_hours: int = 26) -> DataFrame:
    """Sources whose build is older than ``max_hours``."""
    deadline = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(max_hours))
    return metadata.filter(F.col("built_at") < deadline)


def observations_monthly(observations: DataFrame) -> DataFrame:
    """Patient x month x code rollup; abnormal means flagged other than empty or N."""
    flag = F.col("abnormal_flag")
    return observations.groupBy(
        "patient_id",
        F.trunc(F.to_date("observation_dt"), "MM").alias("observation_month"),
        "observation_loinc",
    ).agg(
        F.max("observation_name").alias("observation_name"),
        F.count("*").alias("n_observations"),
        F.avg("value_numeric").alias("avg_value_numeric"),
        F.count_if(flag.isNotNull() & ~flag.isin("", "N")).alias("n_abnormal"),
    )


def lag_days(df: DataFrame, start: str, end: str) -> DataFrame:
    """Whole days from ``start`` to ``end``, for rows that have both."""
    return df.select(days_between(F.col(start), F.col(end)).alias("lag")).filter("lag IS NOT NULL")


def as_datetime(day: date) -> datetime:
    return datetime(day.year, day.month, day.day)
