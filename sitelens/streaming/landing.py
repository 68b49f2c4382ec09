"""Incremental claims as a stream of landed files, and a rolling restatement.

The reference point is the landing date.  The streaming form reads files that
arrived since the last run (its checkpoint is the watermark) and stops when caught
up; every service month touched by what landed is restated as a whole, however old it is, so
a late or corrected claim replaces what was published.

``restate`` overwrites month partitions in place.  ``stream_restatements`` keeps what readers see
in a manifest: a batch writes the months it touches aside, and one small file makes all of them
current at once, emptied months included.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, timedelta
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sitelens.functions.scale import broadcast_within, staged
from sitelens.sources.extract import landed_since

RESTATED_DAYS = 100  # fixed value: longest adjudication lag, rounded up


def service_month(col: str = "service_date") -> Column:
    return F.trunc(F.col(col), "MM")


def append_landed(
    spark: SparkSession, landing: str, target: str, checkpoint: str, schema: StructType | str
) -> StreamingQuery:
    """Append every newly landed file, of the declared schema, to ``target`` by service month."""
    stream = spark.readStream.schema(schema).parquet(landing)
    return (
        stream.withColumn("service_month", service_month())
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("service_month")
        .trigger(availableNow=True)
        .start(target)
    )


def latest_versions(claims: DataFrame, key: str, landed: str, then: Sequence[str] = ()) -> DataFrame:
    """One row per claim: the version that landed last.

    A version without a landing date counts as older than any dated one.  Versions of one
    landing date are ordered by the columns ``then``, and last by a hash of the row, so the
    same version is chosen on every run.
    """
    row = F.struct(*[F.col(c) for c in claims.columns])
    order = F.struct(F.col(landed), *[F.col(c) for c in then], F.xxhash64(*[F.col(c) for c in claims.columns]))
    return claims.groupBy(key).agg(F.max_by(row, order).alias("_row")).select("_row.*")


def touched_months(versions: DataFrame, key: str, landed: str, watermark: date | None) -> DataFrame:
    """Service months of the claims that landed since, in any of their versions.

    A correction that moves a claim to another month touches the month it leaves as well.
    """
    fresh = landed_since(versions, landed, watermark).select(key).distinct()
    return versions.join(fresh, key, "left_semi").select(service_month().alias("service_month")).distinct()


def restated_months(
    versions: DataFrame, key: str, landed: str, watermark: date | None, amount: str, then: Sequence[str] = ()
) -> DataFrame:
    """Every touched month with the claims and the amount it holds now; an emptied month has 0."""
    touched = touched_months(versions, key, landed, watermark).withColumnRenamed("service_month", "_month")
    now = (
        latest_versions(versions, key, landed, then)
        .groupBy(service_month().alias("service_month"))
        .agg(F.count("*").alias("claims"), F.sum(amount).alias("amount"))
    )
    return touched.join(now, F.col("_month").eqNullSafe(F.col("service_month")), "left").select(
        F.col("_month").alias("service_month"),
        F.coalesce("claims", F.lit(0)).alias("claims"),
        F.round(F.coalesce(F.col("amount").cast("double"), F.lit(0.0)), 2).alias(amount),
    )


def restated_span(as_of: date, days: int = RESTATED_DAYS) -> date:
    """First day of the month in which the restated period begins."""
    return (as_of - timedelta(days=days)).replace(day=1)


def restate(
    claims: DataFrame, target: str, as_of: date, days: int = RESTATED_DAYS, touched: Sequence[date | None] = ()
) -> None:
    """Replace the service months of the trailing period and the ``touched`` ones.

    The trailing period is a minimum: months that ``touched_months`` finds (a list as long as
    the calendar) are restated however old they are, the one of claims without a service
    date, None, included.  The scan is limited to those months, and only their partitions
    are overwritten; a month whose claims have all gone becomes an empty partition.
    Rebalancing gives every month files of the advisory size: a month with very many
    rows is written by several tasks, small ones share a task.
    """
    spark = claims.sparkSession
    since = restated_span(as_of, days)
    old = [m for m in touched if m is not None and m < since]

    def wanted(month: Column, day: Column) -> Column:
        chosen = day >= F.lit(since)
        if old:
            chosen = chosen | ((day >= F.lit(min(old))) & month.isin(old))
        return chosen | day.isNull() if None in touched else chosen

    def months(df: DataFrame) -> set[date | None]:
        return {r.service_month for r in df.select("service_month").distinct().collect()}

    chosen = claims.filter(wanted(service_month(), F.col("service_date"))).withColumn("service_month", service_month())
    schema = StructType(list(claims.schema.fields)).add("service_month", "date")
    try:
        published = spark.read.schema(schema).parquet(target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        emptied = set()  # nothing is published yet
    else:
        month = F.col("service_month")
        emptied = months(published.filter(wanted(month, month))) - months(chosen)
    (
        chosen.hint("rebalance", F.col("service_month"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("service_month")
        .parquet(target)
    )
    for month in emptied:
        name = month or "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder of a NULL partition
        claims.limit(0).write.mode("overwrite").parquet(f"{target}/service_month={name}")


class Manifest(NamedTuple):
    """What is published: the folder of every month, and the batches that made it so."""

    version: int
    months: dict[date | None, str]
    batches: dict[str, int]


class Superseded(RuntimeError):
    """Another writer has published since this batch began."""


MANIFEST = "version long, month date, folder string, source string, batch long"


def read_manifest(spark: SparkSession, root: str) -> Manifest:
    """The newest complete manifest; version 0 is that of a table nobody has written yet."""
    try:
        rows = spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").parquet(f"{root}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return Manifest(0, {}, {})
    newest = rows.agg(F.max("version")).scalar()
    held = rows.filter(F.col("version") == newest).collect()  # one row per month and per source
    return Manifest(
        held[0].version if held else 0,
        {r.month: r.folder for r in held if r.folder is not None},
        {r.source: r.batch for r in held if r.source is not None},
    )


def commit_manifest(spark: SparkSession, root: str, new: Manifest) -> None:
    """Publish ``new`` as one file; refuses if its version has been taken meanwhile."""
    rows = [(new.version, month, folder, None, None) for month, folder in new.months.items()]
    rows += [(new.version, None, None, source, batch) for source, batch in new.batches.items()]
    try:
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("error").parquet(f"{root}/manifest/v{new.version:010d}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise Superseded(f"version {new.version} of {root} exists") from e


def open_restated(spark: SparkSession, root: str, schema: StructType, months: Sequence[date | None] | None = None) -> DataFrame:
    """The published claims with their ``service_month``; only the folders of ``months`` if given."""
    current = read_manifest(spark, root).months
    wanted = [m for m in current if months is None or m in months]
    return _months(spark, root, schema, {m: current[m] for m in wanted})


def _months(spark: SparkSession, root: str, schema: StructType, folders: dict[date | None, str]) -> DataFrame:
    whole = StructType(list(schema.fields)).add("service_month", "date")
    if not folders:
        return spark.createDataFrame([], whole)
    null = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder of a NULL partition
    paths = [f"{root}/data/batch={folder}/service_month={month or null}" for month, folder in folders.items()]
    placed = StructType(list(whole.fields)).add("batch", "string")
    return spark.read.schema(placed).option("basePath", f"{root}/data").parquet(*paths).drop("batch")


def restate_batch(
    batch: DataFrame, batch_id: int, root: str, source: str, key: str, landed: str, then: Sequence[str] = ()
) -> list[date | None]:
    """Merge one batch of landed claims and publish every month it touches, all or none.

    A month is touched if a landed claim lies in it or the published version of such a claim does;
    so the touched months' published rows and the batch hold every version that matters, and
    nothing else is read but the published keys.  The months are written to a folder of this
    attempt; the manifest entry that names them is the only commit.  A job that dies before it
    leaves readers the old state, and a batch that is delivered again after it changes nothing:
    ``source`` and ``batch_id`` are part of the entry.
    """
    spark = batch.sparkSession
    before = read_manifest(spark, root)
    if before.batches.get(source, -1) >= batch_id:
        return []
    fresh = staged(batch.withColumn("service_month", service_month()))
    current = _months(spark, root, batch.schema, before.months)
    homes = current.select(key, "service_month").join(broadcast_within(fresh.select(key).distinct()), key, "left_semi")
    touched = [r[0] for r in homes.select("service_month").union(fresh.select("service_month")).distinct().collect()]
    held = _months(spark, root, batch.schema, {m: f for m, f in before.months.items() if m in touched})
    merged = latest_versions(held.unionByName(fresh), key, landed, then)
    folder = f"{batch_id:010d}-{uuid.uuid4().hex}"
    merged.hint("rebalance", F.col("service_month")).write.partitionBy("service_month").parquet(f"{root}/data/batch={folder}")
    written = spark.read.schema(StructType(list(batch.schema.fields)).add("service_month", "date")).parquet(f"{root}/data/batch={folder}")
    filled = {r[0] for r in written.select("service_month").distinct().collect()}
    months = {m: f for m, f in before.months.items() if m not in touched} | {m: folder for m in filled}
    commit_manifest(spark, root, Manifest(before.version + 1, months, before.batches | {source: batch_id}))
    return touched


def stream_restatements(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    schema: StructType | str,
    key: str,
    landed: str,
    then: Sequence[str] = (),
) -> StreamingQuery:
    """Restate the months touched by every newly landed batch of files, and stop when caught up."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        restate_batch(batch, batch_id, root, checkpoint, key, landed, then)

    return (
        spark.readStream.schema(schema)
        .parquet(landing)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
