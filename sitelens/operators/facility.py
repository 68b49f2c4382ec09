"""One row per facility: staffing, panel, volume, capacity use and claims in one window.

Each source is summed per facility on its own; the sums are stacked and brought to one
row per facility by one shuffle on facility_id, instead of one join per source.  Sums
combine map-side, so a facility holding a third of a source costs no more than others.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.temporal import Span, active_on, in_span, minutes_between

STAFFED_MINUTES_PER_DAY = 600  # fixed value: a ten-hour operating day


def per_facility(df: DataFrame, *measures: str, key: str = "facility_id") -> DataFrame:
    """``df`` aggregated to one row per facility; measures are SQL aggregates."""
    return df.groupBy(F.expr(f"{key} AS facility_id")).agg(*map(F.expr, measures))


def staffing(providers: DataFrame) -> DataFrame:
    """Providers by the site they are based at (never by where they were booked)."""
    return per_facility(
        providers,
        "count(*) AS providers_based",
        "count_if(accepting_new_patients) AS providers_accepting",
        key="primary_facility_id",
    )


def panel(providers: DataFrame, members: DataFrame, as_of: date) -> DataFrame:
    """Members attributed to the site of their primary-care provider."""
    active = active_on(F.col("enrollment_date"), F.col("termination_date"), as_of)
    per_provider = (
        members.withColumn("active", active)
        .groupBy(F.expr("primary_pcp_provider_id AS provider_id"))
        .agg(F.expr("count(member_id) AS n"), F.expr("count_if(active AND member_id IS NOT NULL) AS n_active"))
    )
    return per_facility(
        providers.join(per_provider, "provider_id", "left"),
        "coalesce(sum(n), 0) AS panel_total",
        "coalesce(sum(n_active), 0) AS panel_active",
        key="primary_facility_id",
    )


def appointment_volume(appointments: DataFrame, span: Span | None) -> DataFrame:
    if span:
        appointments = appointments.filter(in_span(F.col("scheduled_dt_local"), span, "timestamp_ntz"))
    return per_facility(
        appointments,
        "count(*) AS appts_scheduled",
        "count_if(status = 'completed') AS appts_completed",
        "count_if(status = 'no_show') AS appts_no_show",
        "count_if(startswith(status, 'cancelled')) AS appts_cancelled",
    )


def encounter_volume(encounters: DataFrame, span: Span) -> DataFrame:
    return per_facility(
        encounters.filter(in_span(F.col("admission_dt"), span, "timestamp_ntz")),
        "count(*) AS encounters",
        "count_if(encounter_class = 'inpatient') AS encounters_inpatient",
        "count_if(encounter_class = 'ed') AS encounters_ed",
    )


def operating_rooms(or_schedule: DataFrame, span: Span) -> DataFrame:
    """Cases, rooms, operating days and booked minutes; cancelled cases never started.

    Cases first collapse to (facility, room, day), so the two distinct counts run on
    at most rooms x days rows per facility.
    """
    start, end = F.col("scheduled_start_dt_local"), F.col("scheduled_end_dt_local")
    room_days = (
        or_schedule.filter(in_span(start, span, "timestamp_ntz"))
        .select(
            "facility_id",
            "or_room",
            F.to_date(start).alias("day"),
            F.expr("actual_start_dt_local IS NOT NULL AS ran"),
            minutes_between(start, end).alias("minutes"),
        )
        .groupBy("facility_id", "or_room", "day")
        .agg(
            F.expr("count(*) AS cases"),
            F.expr("count_if(NOT ran) AS cancelled"),
            F.expr("sum(if(ran, minutes, NULL)) AS minutes"),
        )
    )
    return per_facility(
        room_days,
        "sum(cases) AS or_cases",
        "sum(cancelled) AS or_cancelled",
        "count(DISTINCT or_room) AS or_rooms_used",
        "count(DISTINCT day) AS or_operating_days",
        "sum(minutes) AS or_booked_minutes",
    )


def bed_use(bed_census: DataFrame, span: Span) -> DataFrame:
    """Occupancy is the unweighted mean of unit-day ratios."""
    return per_facility(
        bed_census.filter(in_span(F.col("census_date"), span)),
        "avg(try_divide(100D * occupied_beds_midnight, total_beds)) AS bed_occupancy_pct",
        "avg(cast(avg_los_days AS double)) AS avg_los_days",
    )


def delivered_claims(claims: DataFrame, span: Span) -> DataFrame:
    return per_facility(
        claims.filter(in_span(F.col("service_date"), span)),
        "count(*) AS claims",
        "sum(allowed_amount) AS allowed_amount",
        "sum(plan_paid) AS plan_paid",
    )


# counts that are zero where a facility has no rows of the source
COUNTS = [
    "providers_based", "providers_accepting", "panel_total", "panel_active",
    "appts_scheduled", "appts_completed", "appts_no_show", "appts_cancelled",
]


def site_volumes(streams: Sequence[DataFrame]) -> DataFrame:
    """Streams of one row per facility side by side, in one exchange; only these are read."""
    # max only lifts the value over the NULLs
    measures = [c for s in streams for c in s.columns if c != "facility_id"]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streams)
    return per_facility(stacked, *[f"max({c}) AS {c}" for c in measures])


def facility_metrics(
    facilities: DataFrame,
    providers: DataFrame,
    members: DataFrame,
    appointments: DataFrame,
    encounters: DataFrame,
    or_schedule: DataFrame,
    bed_census: DataFrame,
    claims: DataFrame,
    span: Span,
    as_of: date,
) -> DataFrame:
    """One row per facility, 39 columns; a reader of a few of them wants ``site_volumes``."""
    streams = [
        staffing(providers),
        panel(providers, members, as_of),
        appointment_volume(appointments, span),
        encounter_volume(encounters, span),
        operating_rooms(or_schedule, span),
        bed_use(bed_census, span),
        delivered_claims(claims, span),
    ]
    summed = site_volumes(streams)

    def count_of(name: str) -> str:
        return f"coalesce({name}, 0) AS {name}"

    def pct_of_scheduled(name: str) -> str:
        return f"round(try_divide(100D * {name}, appts_scheduled), 1)"

    return facilities.join(summed, "facility_id", "left").selectExpr(
        "facility_id",
        "facility_name",
        "facility_type",
        "ownership",
        "city",
        "state",
        "zip",
        "latitude",
        "longitude",
        "service_lines",
        "total_beds",
        "total_ors",
        "cost_index",
        *map(count_of, COUNTS),
        f"{pct_of_scheduled('appts_no_show')} AS pct_no_show",
        f"{pct_of_scheduled('appts_completed')} AS pct_completed",
        *map(count_of, ["encounters", "encounters_inpatient", "encounters_ed"]),
        "or_cases",
        "or_cancelled",
        "or_rooms_used",
        "or_operating_days",
        "or_booked_minutes",
        "round(try_divide(100D * or_booked_minutes, "
        f"or_rooms_used * or_operating_days * {STAFFED_MINUTES_PER_DAY}), 1) AS or_utilization_pct",
        "round(bed_occupancy_pct, 1) AS bed_occupancy_pct",
        "round(avg_los_days, 2) AS avg_los_days",
        count_of("claims"),
        "cast(coalesce(allowed_amount, 0) AS double) AS allowed_amount",
        "cast(coalesce(plan_paid, 0) AS double) AS plan_paid",
        "round(try_divide(1D * appts_completed, providers_based), 1) AS appts_per_provider_based",
        "round(try_divide(1D * appts_completed, panel_active), 3) AS appts_per_panel_member",
    )
