"""Dataset-level helpers that keep jobs safe on skewed and very large inputs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def has_at_most(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` is small enough to broadcast; the count stops at the bound."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_within(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` has at most ``max_rows`` rows.

    A larger table goes unhinted, and the join is a sort-merge join with adaptive skew
    splitting.
    """
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="sitelens-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    For an intermediate result with several consumers: its lineage is cut, it
    outlives lost executors, and the file sizes give later joins real statistics.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet; key columns come from the left side."""
    renamed = right
    for name in on:
        renamed = renamed.withColumnRenamed(name, f"__{name}")
    cond = reduce(lambda a, b: a & b, [left[n].eqNullSafe(renamed[f"__{n}"]) for n in on])
    return left.join(renamed, cond, how).drop(*[f"__{n}" for n in on])


#: distinct values of one bin that one task may order
FEW_VALUES = 100_000
BINS = 1024


def _split(values: DataFrame, wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bins, of ``BINS`` per wide range, that hold the wanted ranks; bounds are values that occur.

    ``wide(keys, _lo, _hi, _below, _d, _ranks)`` has a row per range; only histogram rows are
    ordered, at most ``BINS`` per range.
    """
    inside = null_safe_join(values, broadcast_within(wide), keys).filter("_v BETWEEN _lo AND _hi")
    place = f"least({BINS - 1}, cast(floor((_v / 2 - _lo / 2) / (_hi / 2 - _lo / 2) * {BINS}) AS int))"
    bins = inside.groupBy(*keys, F.col("_lo").alias("_from"), F.expr(place).alias("_bin")).agg(
        F.sum("_n").alias("_in_bin"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
        F.count("*").alias("_d"),
        F.first("_below").alias("_start"),
        F.first("_ranks").alias("_ranks"),
    )
    over = f"PARTITION BY {', '.join([*keys, '_from'])} ORDER BY _bin ROWS UNBOUNDED PRECEDING"
    return (
        bins.withColumn("_below", F.expr(f"_start + sum(_in_bin) OVER ({over}) - _in_bin"))
        .withColumn("_ranks", F.expr("filter(_ranks, r -> r >= _below AND r < _below + _in_bin)"))
        .filter("size(_ranks) > 0")
        .select(*keys, "_lo", "_hi", "_below", "_d", "_ranks")
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    weight: str | None = None,
    rows: str | None = None,
    few: int = FEW_VALUES,
) -> DataFrame:
    """Exact interpolated quantiles per group without holding a group in one task.

    Rows collapse to distinct values with their multiplicity (combined map-side and spread over
    key *and* value, so a group with a third of all rows is split), staged once.  A group with
    more than ``few`` distinct values gets a histogram over its own range; each bin that holds a
    wanted rank is split again over the values it has, until it holds ``few`` or a single value.
    Only then are the values of those bins ordered.  The rounds are few: each cuts a range to a
    thousandth, whatever its distribution.

    ``rows`` names a column for the number of rows per group, NULL values included.  NaN counts
    as NULL.
    """
    keys = list(keys)
    multiplicity = "count(*)" if weight is None else f"sum({weight})"
    number = F.col(value).cast("double")
    values = staged(
        df.groupBy(*keys, F.when(~F.isnan(number), number).alias("_v")).agg(F.expr(f"cast({multiplicity} AS bigint) AS _n"))
    )
    edges = [(name, p, edge) for name, p in probs.items() for edge in ("floor", "ceil")]
    rank = {(name, edge): f"cast({edge}({p}D * (_total - 1)) AS bigint)" for name, p, edge in edges}
    groups = staged(
        values.groupBy(*keys)
        .agg(
            F.expr("coalesce(sum(if(_v IS NULL, 0, _n)), 0) AS _total"),
            F.sum("_n").alias("_rows"),
            F.min("_v").alias("_lo"),
            F.max("_v").alias("_hi"),
            F.count("_v").alias("_d"),
        )
        .withColumn("_ranks", F.expr(f"array_distinct(array({', '.join(rank.values())}))"))
    )
    targets = groups.filter("_total > 0").select(*keys, "_lo", "_hi", F.lit(0).cast("long").alias("_below"), "_d", "_ranks")
    narrow, wide = [], f"_d > {few} AND _hi > _lo"
    while not targets.filter(wide).isEmpty():
        narrow.append(targets.filter(f"NOT ({wide})"))
        targets = staged(_split(values, targets.filter(wide), keys))
    targets = reduce(DataFrame.unionByName, [*narrow, targets])

    over = f"PARTITION BY {', '.join([*keys, '_lo'])} ORDER BY _v ROWS UNBOUNDED PRECEDING"
    ordered = null_safe_join(values, targets, keys).filter("_v BETWEEN _lo AND _hi").selectExpr(
        *keys, "_v", "_n", "_ranks", f"_below + sum(_n) OVER ({over}) AS _end"
    )
    held = ordered.selectExpr(*keys, "_v", "explode(filter(_ranks, r -> r >= _end - _n AND r < _end)) AS _rank")
    found = held.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))
    at = {k: f"element_at(_at, {r})" for k, r in rank.items()}
    return null_safe_join(groups, found, keys, "left").selectExpr(
        *keys,
        *([f"_rows AS {rows}"] if rows else []),
        *[
            f"{at[name, 'floor']} + ({at[name, 'ceil']} - {at[name, 'floor']}) * "
            f"({p}D * (_total - 1) - floor({p}D * (_total - 1))) AS {name}"
            for name, p in probs.items()
        ],
    )
