"""Bring source tables into parquet: whole, rolled up, or only what has landed since."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitelens.operators.quality import PROFILE, named, profile_metrics, profile_rows
from sitelens.sources.files import exists
from sitelens.sources.network import Network, ParquetNetwork

def local_name(source_name: str) -> str:
    """``payer.claims`` is kept as ``payer_claims``."""
    return source_name.replace(".", "_")


def source_name(name: str) -> str:
    schema, _, table = name.partition("_")
    return f"{schema}.{table}"


def jdbc_table(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    split_on: str,
    bounds: tuple[object, object],
    partitions: int,
) -> DataFrame:
    """A source table read by ``partitions`` parallel range queries on ``split_on``."""
    lower, upper = bounds
    return (
        spark.read.format("jdbc")
        .options(**connection)
        .option("dbtable", table)
        .option("partitionColumn", split_on)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(partitions))
        .option("fetchsize", "10000")
        .load()
    )


def jdbc_query(spark: SparkSession, connection: Mapping[str, str], query: str) -> DataFrame:
    """A rollup computed by the source, so that only its result travels."""
    return spark.read.format("jdbc").options(**connection).option("query", query).load()


def with_provenance(df: DataFrame, origin: str = "source") -> DataFrame:
    """Label rows read past the marts, whose rules were not applied to them."""
    return df.withColumn("provenance", F.lit(origin))


def in_event_order(df: DataFrame, event_column: str) -> DataFrame:
    """Files that each cover a short stretch of event dates, for pruning by file statistics.

    The second sort key is a row hash, so that a single day holding very many rows is
    still cut into several files.
    """
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.repartitionByRange(F.col(event_column), spread).sortWithinPartitions(event_column)


def split_points(low: date, high: date, splits: int) -> list[date]:
    """First days of the splits after the first, of about equal length, over [low, high]."""
    days = (high - low).days + 1
    steps = {low + timedelta(days=days * i // splits) for i in range(1, splits)}
    return sorted(steps - {low})


def _split_of(event_column: str, points: Sequence[date]) -> Column:
    """Number of the split of a row: how many points its day has reached; rows without a day are in the first."""
    day = F.to_date(event_column)
    return reduce(lambda a, p: a + F.when(day >= F.lit(p), 1).otherwise(0), points, F.lit(0))


def in_splits(df: DataFrame, event_column: str, points: Sequence[date], spread: int = 1) -> DataFrame:
    """Files in event order by known split points: the source is read once, without a sampling pass.

    Every split is dealt to ``spread`` tasks by row hash, so that a split with very many rows is
    several files.
    """
    task = _split_of(event_column, points) * spread + F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread))
    return df.repartitionById((len(points) + 1) * spread, task.cast("int")).sortWithinPartitions(event_column)


def extract_in_splits(df: DataFrame, path: str, event_column: str, points: Sequence[date]) -> list[int | None]:
    """Extract split by split; one that was finished before is skipped (None), so a killed run goes on.

    A split is a query of its own with a range on ``event_column``, for sources that answer ranges
    (a database, files in event order).  ``open_splits`` reads the table, once all are there.
    """
    day, edges = F.to_date(event_column), [None, *points, None]
    written = []
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        inside = (day.isNull() | (day < F.lit(high)) if high else F.lit(True)) if low is None else day >= F.lit(low)
        if low is not None and high is not None:
            inside = inside & (day < F.lit(high))
        written.append(extract(df.filter(inside).sortWithinPartitions(event_column), f"{path}/split-{i:05d}"))
    return written


def open_splits(spark: SparkSession, path: str, schema: StructType, splits: int) -> DataFrame:
    """The table of a finished ``extract_in_splits``; refuses one with splits that are still open."""
    folders = [f"{path}/split-{i:05d}" for i in range(splits)]
    open_ones = [f for f in folders if not exists(spark, f)]
    if open_ones:
        raise FileNotFoundError(f"not extracted yet: {', '.join(open_ones)}")
    return spark.read.schema(schema).parquet(*folders)


def extract(
    df: DataFrame,
    path: str,
    event_column: str | None = None,
    profile_to: str | None = None,
    points: Sequence[date] | None = None,
) -> int | None:
    """Write ``df`` once as zstd parquet; an existing extract is kept.

    Returns the rows written, counted during the write, or None when skipped.  The
    commit protocol shows readers all files or none; what a failed write left is replaced.
    Files are in order of ``event_column``; with ``points`` (``split_points`` of known bounds) the
    source is not sampled for that.  With ``profile_to`` the table's profile, observed during the same write, is kept there.
    """
    spark, name = df.sparkSession, path.rstrip("/").rsplit("/", 1)[-1].removesuffix(".parquet")
    if exists(spark, path) and (profile_to is None or exists(spark, profile_to)):
        return None
    schema = df.schema
    if event_column:
        df = in_event_order(df, event_column) if points is None else in_splits(df, event_column, points)
    # above the range exchange, whose sampling pass would count the rows a second time
    seen = Observation()
    metrics = profile_metrics(schema) if profile_to else {"_rows": F.count(F.lit(1))}
    counted = df.observe(seen, *named(metrics))
    counted.write.mode("overwrite").option("compression", "zstd").parquet(path)
    if profile_to:
        rows = spark.createDataFrame(profile_rows(name, schema, seen.get), PROFILE)
        rows.coalesce(1).write.mode("overwrite").parquet(profile_to)
    return seen.get["_rows"]


def extract_network(net: Network, names: Iterable[str], root: str) -> tuple[dict[str, int | None], ParquetNetwork]:
    """Extract tables under ``root`` and open them there, with the types they had.

    The profile of every table is a by-product of its write; ``extracted_profile`` reads them.
    """
    frames = {name: net.table(name) for name in names}
    rows = {n: extract(df, f"{root}/{n}.parquet", net.EVENT.get(n), f"{root}/profiles/table={n}") for n, df in frames.items()}
    return rows, ParquetNetwork(net.spark, root, {name: df.schema for name, df in frames.items()})


def extracted_profile(spark: SparkSession, root: str) -> DataFrame:
    """Profiles that ``extract_network`` kept; no table is read."""
    return spark.read.schema(PROFILE).parquet(f"{root}/profiles")


def save_snapshot(df: DataFrame, name: str) -> None:
    """Save ``schema_table`` as table ``schema.table`` of the catalog."""
    spark = df.sparkSession
    schema, _, table = name.partition("_")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    df.write.mode("overwrite").saveAsTable(f"`{schema}`.`{table}`")


def landed_since(df: DataFrame, landing_column: str, watermark: date | None) -> DataFrame:
    """Rows that may have arrived since the watermark, by landing date and never by event date.

    A claim arrives weeks after its service date; a delta on the event date would lose it
    for good.  The watermark day comes again as a whole, because rows may land later on the
    same day, and so do rows without a landing date: nothing says when they came.  Readers
    drop what they have by key (``not_yet_seen``) or keep the last version (``latest_versions``).
    """
    if watermark is None:
        return df
    landed = F.col(landing_column)
    return df.filter((landed >= F.lit(watermark)) | landed.isNull())


def not_yet_seen(delta: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows of ``delta`` that ``seen`` does not hold in the same version; NULL keys stay.

    A version is the key with a hash of the whole row.
    """
    version = F.xxhash64(*[F.col(c) for c in delta.columns]).alias("_version")
    have = seen.select(F.col(key), version).distinct()
    return delta.select("*", version).join(have, [key, "_version"], "left_anti").select(*delta.columns)
