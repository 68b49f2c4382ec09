"""Integrity, reconciliation and monitoring jobs; each returns one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from sitelens.functions.measures import ratio, share_pct, sum_if
from sitelens.functions.scale import exact_quantiles
from sitelens.operators import freshness


class JoinPath(NamedTuple):
    """A declared foreign key; ``nullable_pct`` is the share of NULLs that is normal."""

    left: str
    left_col: str
    right: str
    right_col: str
    nullable_pct: float = 0.0


# fixed values: the declared join paths
JOIN_PATHS = [
    JoinPath("payer_claims", "member_id", "payer_members", "member_id"),
    JoinPath("payer_claims", "facility_id", "ops_facilities", "facility_id"),
    JoinPath("payer_claims", "provider_id", "ops_providers", "provider_id"),
    JoinPath("ehr_encounters", "patient_id", "ehr_patients", "patient_id"),
    JoinPath("ehr_encounters", "facility_id", "ops_facilities", "facility_id"),
    JoinPath("ehr_procedures", "patient_id", "ehr_patients", "patient_id"),
    JoinPath("ehr_conditions", "patient_id", "ehr_patients", "patient_id"),
    JoinPath("ops_appointments", "member_id", "payer_members", "member_id"),
    JoinPath("ops_appointments", "facility_id", "ops_facilities", "facility_id"),
    JoinPath("ops_appointments", "provider_id", "ops_providers", "provider_id"),
    JoinPath("ops_referrals", "member_id", "payer_members", "member_id"),
    JoinPath("ops_referrals", "referred_to_facility_id", "ops_facilities", "facility_id", 22.0),
    JoinPath("ops_or_schedule", "facility_id", "ops_facilities", "facility_id"),
    JoinPath("ops_bed_census_daily", "facility_id", "ops_facilities", "facility_id"),
    JoinPath("ops_providers", "primary_facility_id", "ops_facilities", "facility_id"),
    JoinPath("pharmacy_rx_claims", "member_id", "payer_members", "member_id"),
    JoinPath("payer_member_eligibility_history", "member_id", "payer_members", "member_id"),
    JoinPath("payer_members", "plan_id", "payer_plans", "plan_id"),
    JoinPath("payer_members", "employer_id", "payer_employers", "employer_id", 35.0),
    JoinPath("outreach_program_enrollments", "member_id", "payer_members", "member_id"),
    JoinPath("outreach_program_enrollments", "program_id", "outreach_wellness_programs", "program_id"),
    JoinPath("external_drive_time_isochrones", "facility_id", "ops_facilities", "facility_id"),
    JoinPath("identity_xwalk", "patient_id", "ehr_patients", "patient_id"),
    JoinPath("identity_xwalk", "member_id", "payer_members", "member_id"),
]


def stacked(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def path_keys(paths: Sequence[JoinPath], tables: Mapping[str, DataFrame]) -> DataFrame:
    """(path, key, n, known): keys of both sides of every path, each table scanned once.

    A table emits an entry per path it takes part in; keys are compared as text.
    """
    entries: dict[str, list[Column]] = {}
    for i, p in enumerate(paths):
        for table, column, known in ((p.left, p.left_col, False), (p.right, p.right_col, True)):
            entry = F.struct(
                F.lit(i).alias("path"),
                F.col(column).cast("string").alias("key"),
                F.lit(0 if known else 1).cast("long").alias("n"),
                F.lit(known).alias("known"),
            )
            entries.setdefault(table, []).append(entry)
    return stacked([tables[t].select(F.inline(F.array(*e))) for t, e in entries.items()])


def join_path_report(
    paths: Sequence[JoinPath], tables: Mapping[str, DataFrame], tolerance_pp: float = 2.0
) -> DataFrame:
    """Rows, NULL keys and orphan keys of every declared path.

    Both sides of all paths meet in one aggregate by (path, key), which combines map-side: one
    scan per table, one exchange for all paths, no join, and a key that holds a third of the rows
    sends one row per task.
    """
    met = path_keys(paths, tables).groupBy("path", "key").agg(F.sum("n").alias("n"), F.bool_or("known").alias("known"))
    missing = F.col("key").isNull()
    found = met.groupBy("path").agg(
        F.sum("n").alias("n_rows"),
        sum_if(missing, F.col("n")).alias("n_null"),
        sum_if(~missing & ~F.col("known"), F.col("n")).alias("orphans"),
    )
    return _reported(paths, tables, found, ["orphans"], tolerance_pp)


def _reported(
    paths: Sequence[JoinPath], tables: Mapping[str, DataFrame], found: DataFrame, more: Sequence[str], tolerance_pp: float
) -> DataFrame:
    """Every path with its counts in ``found`` (path, n_rows, n_null and ``more``) and its NULL rate."""
    declared = tables[paths[0].left].sparkSession.createDataFrame(
        [(i, f"{p.left}.{p.left_col}", f"{p.right}.{p.right_col}", p.nullable_pct) for i, p in enumerate(paths)],
        "path int, referencing string, referenced string, declared_null_pct double",
    )
    null_pct = F.coalesce(share_pct(F.col("n_null"), F.col("n_rows")), F.lit(0.0))
    return (
        declared.join(found, "path", "left")
        .select(
            "referencing",
            "referenced",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "n_null", *more)],
            "declared_null_pct",
        )
        .select(
            "*",
            F.round(null_pct, 4).alias("null_pct"),
            (F.abs(null_pct - F.col("declared_null_pct")) <= tolerance_pp).alias("null_rate_ok"),
        )
    )


def orphans(paths: Sequence[JoinPath], tables: Mapping[str, DataFrame]) -> DataFrame:
    return join_path_report(paths, tables).select("referencing", "referenced", "n_rows", "orphans")


def null_rates(paths: Sequence[JoinPath], tables: Mapping[str, DataFrame], tolerance_pp: float = 2.0) -> DataFrame:
    """Rows and NULL keys of every path: counts of the referencing tables alone, no key is grouped."""
    sides: dict[str, list[tuple[int, str]]] = {}
    for i, p in enumerate(paths):
        sides.setdefault(p.left, []).append((i, p.left_col))

    def one(table: str, ends: list[tuple[int, str]]) -> DataFrame:
        counts = [F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_p{i}") for i, c in ends]]
        entries = [
            F.struct(F.lit(i).alias("path"), F.col("_rows").alias("n_rows"), (F.col("_rows") - F.col(f"_p{i}")).alias("n_null"))
            for i, _ in ends
        ]
        return tables[table].agg(*counts).select(F.inline(F.array(*entries)))

    return _reported(paths, tables, stacked([one(t, e) for t, e in sides.items()]), (), tolerance_pp)


def _is_temporal(kind: object) -> bool:
    return isinstance(kind, (DateType, TimestampType, TimestampNTZType))


PROFILE = (
    "table_name string, position long, column_name string, data_type string, row_count long, null_count long, "
    "first_day date, last_day date"
)


def profile_metrics(schema: StructType) -> dict[str, Column]:
    """Aggregates behind the profile of a table, by name; also fit to be observed while it is written."""
    out = {"_rows": F.count(F.lit(1))}
    for i, f in enumerate(schema.fields):
        column = F.col(f"`{f.name}`")
        out[f"_n{i}"] = F.count(column)
        if _is_temporal(f.dataType):
            out |= {f"_lo{i}": F.to_date(F.min(column)), f"_hi{i}": F.to_date(F.max(column))}
    return out


def named(metrics: Mapping[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in metrics.items()]


def profile_rows(name: str, schema: StructType, seen: Mapping[str, object]) -> list[tuple]:
    """Rows of ``PROFILE`` from collected ``profile_metrics``."""
    return [
        (
            name,
            i + 1,
            f.name,
            f.dataType.simpleString(),
            seen["_rows"],
            seen["_rows"] - seen[f"_n{i}"],
            seen.get(f"_lo{i}"),
            seen.get(f"_hi{i}"),
        )
        for i, f in enumerate(schema.fields)
    ]


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column: row count, NULLs, and the day range of temporal columns.

    One aggregate per table computes all its columns; the single result row is then
    unfolded.
    """

    def one(name: str, df: DataFrame) -> DataFrame:
        nothing = F.lit(None).cast("date")
        entries = [
            F.struct(
                F.lit(i + 1).cast("long").alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col("_rows").alias("row_count"),
                (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"),
                (F.col(f"_lo{i}") if _is_temporal(f.dataType) else nothing).alias("first_day"),
                (F.col(f"_hi{i}") if _is_temporal(f.dataType) else nothing).alias("last_day"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
        summed = df.agg(*named(profile_metrics(df.schema)))
        return summed.select(F.lit(name).alias("table_name"), F.explode(F.array(*entries)).alias("c")).select(
            "table_name", "c.*"
        )

    return stacked([one(n, d) for n, d in tables.items()])


def first_date_ranges(profiled: DataFrame) -> DataFrame:
    """Day range of the first temporal column of each table."""
    dated = profiled.filter("first_day IS NOT NULL")
    first = F.min(F.struct("position", "column_name", "first_day", "last_day"))
    return dated.groupBy("table_name").agg(first.alias("f")).select(
        "table_name", "f.column_name", "f.first_day", "f.last_day"
    )


def profile_drift(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Profile rows that were added, removed or changed since ``stored`` was written."""
    key = ["table_name", "column_name"]
    body = ["data_type", "row_count", "null_count", "first_day", "last_day"]
    old = stored.select(*key, F.struct(*body).alias("old"))
    new = fresh.select(*key, F.struct(*body).alias("new"))
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    )
    return (
        old.join(new, key, "full")
        .select(
            *key,
            change.alias("drift"),
            F.col("old.row_count").alias("rows_before"),
            F.col("new.row_count").alias("rows_now"),
        )
        .filter("drift IS NOT NULL")
    )


def table_emptiness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Whether each table has a row; stops at the first row found."""
    return stacked(
        [
            d.limit(1).agg((F.count("*") > 0).alias("has_rows")).select(F.lit(n).alias("table_name"), "has_rows")
            for n, d in tables.items()
        ]
    )


def observed_windows(events: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    return stacked(
        [
            d.agg(F.to_date(F.min(c)).alias("first_day"), F.to_date(F.max(c)).alias("last_day")).select(
                F.lit(n).alias("table_name"), F.lit(c).alias("event_column"), "first_day", "last_day"
            )
            for n, d, c in events
        ]
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def crosswalk_invariants(xwalk: DataFrame, patients: DataFrame, threshold: float) -> DataFrame:
    """One-to-one on both sides, coverage, and confidence bounds per method."""

    def check(name: str, value: DataFrame) -> DataFrame:
        return value.select(F.lit(name).alias("check"), F.col("v").cast("double").alias("value"))

    total = patients.agg(F.count("*")).scalar()
    method = F.col("match_method")
    score = F.col("match_confidence")
    certain = method.isin("exact", "exact_tiebreak")
    return stacked(
        [
            check("patients_linked_twice", duplicate_keys(xwalk, ["patient_id"]).agg(F.count("*").alias("v"))),
            check("members_linked_twice", duplicate_keys(xwalk, ["member_id"]).agg(F.count("*").alias("v"))),
            check("coverage_pct", xwalk.agg(F.round(share_pct(F.count("*"), total), 4).alias("v"))),
            check("certain_links_below_one", xwalk.agg(F.count_if(certain & (score != 1.0)).alias("v"))),
            check("fuzzy_links_below_threshold", xwalk.agg(F.count_if(~certain & (score < threshold)).alias("v"))),
            check("links_of_unknown_method", xwalk.agg(F.count_if(~method.isin("exact", "exact_tiebreak", "fuzzy")).alias("v"))),
        ]
    )


def links_by_method(xwalk: DataFrame) -> DataFrame:
    score = F.col("match_confidence")
    return xwalk.groupBy("match_method").agg(
        F.count("*").alias("links"),
        F.round(F.min(score), 6).alias("lowest"),
        F.round(F.max(score), 6).alias("highest"),
    )


def assignment_signal(appointments: DataFrame, providers: DataFrame) -> DataFrame:
    """Does the booked provider say anything about the site or the specialty?

    Bookings collapse to (provider, site, specialty) counts before the join.
    """
    pairs = appointments.groupBy("provider_id", "facility_id", "specialty").agg(F.count("*").alias("n"))
    home = providers.select(
        "provider_id", F.col("specialty").alias("own_specialty"), "primary_facility_id"
    )
    n = F.col("n")
    return (
        pairs.join(home, "provider_id")
        .agg(
            F.sum(n).alias("appointments"),
            F.round(share_pct(sum_if(F.col("facility_id") == F.col("primary_facility_id"), n), F.sum(n)), 4).alias(
                "pct_at_home_site"
            ),
            F.round(share_pct(sum_if(F.col("specialty") == F.col("own_specialty"), n), F.sum(n)), 4).alias(
                "pct_own_specialty"
            ),
        )
    )


def providers_per_site(appointments: DataFrame) -> DataFrame:
    """Distinct booked providers per site, from distinct pairs."""
    return (
        appointments.select("facility_id", "provider_id")
        .distinct()
        .groupBy("facility_id")
        .agg(F.count("provider_id").alias("distinct_providers"))
    )


def sites_per_provider(appointments: DataFrame, facilities: DataFrame) -> DataFrame:
    """Sites, cities and states a provider is booked at."""
    pairs = appointments.select("provider_id", "facility_id").distinct()
    placed = pairs.join(facilities.select("facility_id", "city", "state"), "facility_id")
    return placed.groupBy("provider_id").agg(
        F.count("*").alias("sites"),
        F.countDistinct("city").alias("cities"),
        F.countDistinct("state").alias("states"),
    )


def grain(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys (NULLs count as values) and rows with a NULL key part."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(sum_if(any_null, F.col("n")), F.lit(0)).alias("null_keys"),
    ).select(F.lit(name).alias("mart"), "*", (F.col("n_rows") == F.col("distinct_keys")).alias("unique"))


def reconcile(checks: Sequence[tuple[str, DataFrame, Column, DataFrame, Column]], tolerance: float = 0.0) -> DataFrame:
    """The same quantity from a mart and from its source: (name, mart, agg, source, agg)."""

    def one(name: str, mart: DataFrame, m: Column, source: DataFrame, s: Column) -> DataFrame:
        from_source = source.agg(s.cast("double").alias("v")).scalar()
        return mart.agg(m.cast("double").alias("mart_value")).select(
            F.lit(name).alias("check"), "mart_value", from_source.alias("source_value")
        )

    gap = F.abs(F.col("mart_value") - F.col("source_value"))
    same = F.col("mart_value").eqNullSafe(F.col("source_value"))
    return stacked([one(*c) for c in checks]).withColumn("ok", F.coalesce(gap <= tolerance, same))


def flows_against_summary(flows: DataFrame, summary: DataFrame, tolerance: float = 0.15) -> DataFrame:
    """Market dollars and recapture by two routes, one row per market of either route.

    A market missing on one side, or a value that is NULL on one side only, is not ok.
    """
    outside = F.col("is_acute") & (F.col("ownership") != "owned")
    by_city = flows.groupBy(F.col("member_city").alias("city")).agg(
        F.sum("allowed_musd").alias("flow_allowed"),
        sum_if(outside, F.col("plan_paid_musd") - F.col("if_owned_plan_paid_musd")).alias("flow_recapture"),
    )

    def agree(a: str, b: str) -> Column:
        return F.coalesce(F.abs(F.col(a) - F.col(b)) <= tolerance, F.col(a).isNull() & F.col(b).isNull())

    one_side = by_city.withColumn("_flow", F.lit(True))
    other = summary.select("city", "allowed_musd", "recapture_plan_paid_musd").withColumn("_mart", F.lit(True))
    both = F.col("_flow").isNotNull() & F.col("_mart").isNotNull()
    return one_side.join(other, "city", "full").select(
        "city",
        F.round("flow_allowed", 4).alias("flow_allowed_musd"),
        "allowed_musd",
        F.round("flow_recapture", 4).alias("flow_recapture_musd"),
        "recapture_plan_paid_musd",
        (both & agree("flow_allowed", "allowed_musd") & agree("flow_recapture", "recapture_plan_paid_musd")).alias("ok"),
    )


def metadata_counts(metadata: DataFrame, sources: Sequence[freshness.Source]) -> DataFrame:
    """Recorded row counts next to the sources as they are now."""
    actual = stacked(
        [s.df.agg(F.count("*").alias("actual")).select(F.lit(f"raw.{s.name}").alias("source_table"), "actual") for s in sources]
    )
    return metadata.join(actual, "source_table", "full").select(
        "source_table",
        F.col("row_count").alias("recorded"),
        "actual",
        F.coalesce(F.col("row_count") == F.col("actual"), F.lit(False)).alias("ok"),
        (~F.col("incremental_column").eqNullSafe(F.col("event_column"))).alias("lands_after_event"),
    )


def lag_distribution(df: DataFrame, start: str, end: str) -> DataFrame:
    """Median, p10, p90 and longest lag in days, exact."""
    lags = freshness.lag_days(df, start, end).withColumn("all", F.lit(1))
    marks = {"p10": 0.1, "median": 0.5, "p90": 0.9, "max": 1.0}
    return exact_quantiles(lags, ["all"], "lag", marks, rows="n").select(
        "n",
        *[F.round(c, 4).alias(f"{c}_days") for c in ("p10", "median", "p90")],
        F.col("max").cast("long").alias("max_days"),
    )


class Band(NamedTuple):
    """A published conclusion: the value must stay within [lo, hi]."""

    name: str
    df: DataFrame
    value: Column
    lo: float
    hi: float


def band_checks(bands: Sequence[Band]) -> DataFrame:
    return stacked(
        [
            b.df.agg(F.round(b.value.cast("double"), 6).alias("value")).select(
                F.lit(b.name).alias("check"),
                "value",
                F.lit(float(b.lo)).alias("lo"),
                F.lit(float(b.hi)).alias("hi"),
                F.coalesce(F.col("value").between(b.lo, b.hi), F.lit(False)).alias("ok"),
            )
            for b in bands
        ]
    )


def uniformity(metrics: DataFrame, summary: DataFrame, min_active: int) -> DataFrame:
    """Measures that should not tell markets or sites apart; a wide spread is news."""
    clinic = (F.col("ownership") == "owned") & (F.col("facility_type") == "clinic")
    done = F.when(clinic, F.col("appts_completed"))
    hospital = (F.col("ownership") == "owned") & (F.col("facility_type") == "hospital")

    def width(cond: Column, col: str) -> Column:
        v = F.when(cond, F.col(col))
        return F.max(v) - F.min(v)

    shares = summary.filter(F.col("members_active") > min_active)
    return stacked(
        [
            shares.agg(width(F.lit(True), "pct_allowed_owned").alias("v")).select(
                F.lit("owned_share_spread_pp").alias("monitor"), F.round("v", 4).alias("value")
            ),
            metrics.agg(share_pct(F.stddev_samp(done), F.avg(done)).alias("v")).select(
                F.lit("clinic_completed_cv_pct").alias("monitor"), F.round("v", 4).alias("value")
            ),
            metrics.agg(ratio(F.max(done), F.min(done)).alias("v")).select(
                F.lit("clinic_completed_max_min").alias("monitor"), F.round("v", 4).alias("value")
            ),
            metrics.agg(width(hospital, "or_utilization_pct").alias("v")).select(
                F.lit("or_utilization_spread_pp").alias("monitor"), F.round("v", 4).alias("value")
            ),
            metrics.agg(width(hospital, "bed_occupancy_pct").alias("v")).select(
                F.lit("bed_occupancy_spread_pp").alias("monitor"), F.round("v", 4).alias("value")
            ),
        ]
    )
