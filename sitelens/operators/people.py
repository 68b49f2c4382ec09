"""Member-level views: one row per member, coverage months, prevalence, age mix."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta
from functools import reduce
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions import cover
from sitelens.functions.measures import share_pct
from sitelens.functions.scale import staged
from sitelens.functions.temporal import Span, active_on, age_years


def member_360(
    members: DataFrame,
    xwalk: DataFrame,
    providers: DataFrame,
    enrollments: DataFrame,
    as_of: date,
) -> DataFrame:
    """Demographics, plan, employer, linked patient, primary-care site and programs.

    Programs are counted per member before the join, so a member with very many
    enrollments joins as one row.
    """
    programs = enrollments.groupBy("member_id").agg(
        F.count("*").alias("enrollments"),
        F.count_if(F.col("status") == "completed").alias("enrollments_completed"),
    )
    site = providers.select(
        F.col("provider_id").alias("primary_pcp_provider_id"),
        F.col("primary_facility_id").alias("pcp_facility_id"),
    )
    return (
        members.join(xwalk.select("member_id", "patient_id", "match_method"), "member_id", "left")
        .join(site, "primary_pcp_provider_id", "left")
        .join(programs, "member_id", "left")
        .select(
            "member_id",
            "patient_id",
            "match_method",
            "gender",
            age_years(F.col("dob"), as_of).alias("age"),
            "city",
            "state",
            "plan_id",
            "employer_id",
            active_on(F.col("enrollment_date"), F.col("termination_date"), as_of).alias("is_active"),
            "pcp_facility_id",
            F.coalesce("enrollments", F.lit(0)).alias("enrollments"),
            F.coalesce("enrollments_completed", F.lit(0)).alias("enrollments_completed"),
        )
    )


#: months that are bits of one long
WORD_MONTHS = 60


def member_months(eligibility: DataFrame, span: Span) -> DataFrame:
    """Distinct members covered in each month of the window; no end date means covered.

    The months of a row are bits of a few numbers, and a member's rows are joined by OR, so an
    aggregate holds one small row per member instead of one per member and month.  A row that ends
    before it starts covers nothing; ``reversed_eligibility`` reports it.
    """
    first = F.trunc(F.greatest(F.col("effective_date"), F.lit(span.lo)), "MM")
    last = F.trunc(
        F.least(F.coalesce(F.col("end_date"), F.date_sub(F.lit(span.hi), 1)), F.date_sub(F.lit(span.hi), 1)), "MM"
    )
    covered = eligibility.filter(
        (F.col("effective_date") < F.lit(span.hi))
        & (F.col("end_date").isNull() | (F.col("end_date") >= F.lit(span.lo)))
        & (F.col("end_date").isNull() | (F.col("end_date") >= F.col("effective_date")))
    )
    months = [d.date() for d in pd.date_range(span.lo.replace(day=1), span.hi - timedelta(days=1), freq="MS")]
    words = [months[i : i + WORD_MONTHS] for i in range(0, len(months), WORD_MONTHS)]

    def mask(word: list[date]) -> Column:
        bits = [F.when(F.lit(m).between(F.col("_first"), F.col("_last")), F.lit(1 << i)).otherwise(F.lit(0)) for i, m in enumerate(word)]
        return reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long")

    ranges = covered.select("member_id", first.alias("_first"), last.alias("_last"))
    held = ranges.groupBy("member_id").agg(*[F.bit_or(mask(word)).alias(f"_w{w}") for w, word in enumerate(words)])
    known, per_month = F.col("member_id").isNotNull(), []
    for i, m in enumerate(months):
        on = F.getbit(f"_w{i // WORD_MONTHS}", F.lit(i % WORD_MONTHS)) == 1
        per_month.append(
            F.struct(F.lit(m).alias("month"), F.count_if(on & known).alias("members_covered"), F.count_if(on).alias("_keys"))
        )
    return held.agg(F.array(*per_month).alias("_m")).select(F.inline("_m")).filter("_keys > 0").drop("_keys")


def reversed_eligibility(eligibility: DataFrame) -> DataFrame:
    """The eligibility rows that end before they start."""
    return eligibility.filter(F.col("end_date") < F.col("effective_date"))


def condition_prevalence(
    conditions: DataFrame, xwalk: DataFrame, members: DataFrame, city: str
) -> DataFrame:
    """Distinct linked members per condition; the denominator is linked members only."""
    local = members.filter(F.col("city") == city).select("member_id")
    # read for the denominator and for the join
    linked = staged(xwalk.join(local, "member_id").select("patient_id", "member_id"))
    total = linked.agg(F.count("*")).scalar()
    return (
        conditions.select("patient_id", "condition_name")
        .join(linked, "patient_id")
        .groupBy("condition_name")
        .agg(F.countDistinct("member_id").alias("members"))
        .select(
            "condition_name",
            "members",
            total.alias("linked_members"),
            F.round(share_pct(F.col("members"), total), 2).alias("pct_of_linked"),
        )
    )


def age_mix(members: DataFrame, as_of: date, older_than: int = 65) -> DataFrame:
    age = age_years(F.col("dob"), as_of)
    return members.groupBy("city").agg(
        F.count("*").alias("members"),
        F.round(F.avg(age), 4).alias("mean_age"),
        F.round(share_pct(F.count_if(age >= older_than), F.count("*")), 4).alias("pct_older"),
    )


CELLS = "level int, cx long, cy long, edges array<struct<ax: double, ay: double, bx: double, by: double>>, base int, turns array<double>"


def covering_cells(shapes: DataFrame) -> DataFrame:
    """Quadtree cells of every polygon (shape, polygon_wkt); see ``functions/cover.py``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shape, wkt in frame.itertuples(index=False):
                cells = cover.cells_of(cover.rings_of(wkt))
                while some := list(islice(cells, 1000)):
                    level, cx, cy, edges, base, turns = zip(*some)
                    listed = [[dict(zip(("ax", "ay", "bx", "by"), e)) for e in own.tolist()] for own in edges]
                    yield pd.DataFrame(
                        {
                            "shape": [shape] * len(some),
                            "level": level,
                            "cx": cx,
                            "cy": cy,
                            "edges": listed,
                            "base": base,
                            "turns": [t.tolist() for t in turns],
                        }
                    )

    return shapes.select("shape", "polygon_wkt").mapInPandas(run, f"shape string, {CELLS}")


def drive_time_access(members: DataFrame, isochrones: DataFrame) -> DataFrame:
    """Members within each drive-time polygon, by point-in-polygon; 0 where there are none.

    All parts of a multipolygon count and holes do not.  Rows that repeat a facility and
    time are added up.

    Equal polygons are covered and counted once.  A polygon is cut into quadtree cells: large ones
    wholly inside, and border cells that carry only the edges in them, a few dozen at most; no cell
    is much larger than the polygon.  Members first collapse to distinct home points with a count;
    a point meets the cells that hold it, one equi-join over the levels in use, and is tested
    against the edges of its cell alone.
    """
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shapes = isochrones.select("polygon_wkt").distinct().withColumn("shape", F.sha2("polygon_wkt", 256))
    # dealt out by number: a few short texts would be one task, and so would a few home points
    cells = staged(covering_cells(shapes.repartition(tasks, "shape")))
    levels = sorted(r.level for r in cells.select("level").distinct().collect())  # at most cover.LEVELS
    homes = (
        members.select(F.col("longitude").cast("double").alias("x"), F.col("latitude").cast("double").alias("y"))
        .groupBy("x", "y")
        .agg(F.count("*").alias("people"))
        .repartition(tasks, "x", "y")
        .withColumn("level", F.explode(F.array(*[F.lit(level) for level in levels]).cast("array<int>")))
        .withColumn("_size", cover.TOP_DEGREES / F.pow(F.lit(2.0), "level"))
        .withColumn("cx", F.floor(F.col("x") / F.col("_size")))
        .withColumn("cy", F.floor(F.col("y") / F.col("_size")))
    )
    x, y = F.col("x"), F.col("y")

    def crossed(e: Column) -> Column:
        spans = (e["ay"] > y) != (e["by"] > y)
        return spans & (x < F.try_divide((e["bx"] - e["ax"]) * (y - e["ay"]), e["by"] - e["ay"]) + e["ax"])

    passed = F.size(F.filter("edges", crossed)) + F.size(F.filter("turns", lambda t: t <= y)) + F.col("base")
    counts = (
        cells.join(homes, ["level", "cx", "cy"])
        .filter(passed % 2 == 1)
        .groupBy("shape")
        .agg(F.sum("people").alias("_within"))
    )
    rings = isochrones.select("facility_id", "isochrone_minutes", F.sha2("polygon_wkt", 256).alias("shape"))
    return (
        rings.join(counts, "shape", "left")
        .groupBy("facility_id", "isochrone_minutes")
        .agg(F.coalesce(F.sum("_within"), F.lit(0).cast("long")).alias("members_within"))
    )
