"""Is one clinic really busier than another? Volumes, denominators, destinations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.functions.measures import millions, ratio, share_pct, sum_or_zero
from sitelens.functions.temporal import Span, days_between, in_span
from sitelens.operators import facility, market


def clinic_facts(
    facilities: DataFrame,
    providers: DataFrame,
    members: DataFrame,
    appointments: DataFrame,
    encounters: DataFrame,
    span: Span,
    as_of: date,
) -> DataFrame:
    """Panel, staff and two independent volumes per owned clinic that has all of them."""
    volume = facility.appointment_volume(appointments, None)
    staff = facility.staffing(providers)
    panel = facility.panel(providers, members, as_of)
    visits = facility.encounter_volume(encounters, span)
    completed = F.col("appts_completed")
    return (
        facilities.filter((F.col("ownership") == "owned") & (F.col("facility_type") == "clinic"))
        .join(volume, "facility_id")
        .join(visits, "facility_id")
        .join(panel, "facility_id")
        .join(staff, "facility_id")
        .select(
            "city",
            "facility_id",
            F.col("panel_total").alias("panel"),
            F.col("providers_based").alias("providers"),
            completed.alias("completed"),
            F.col("appts_scheduled").alias("scheduled"),
            "encounters",
            F.round(share_pct(F.col("appts_no_show"), F.col("appts_scheduled")), 1).alias("pct_no_show"),
            F.round(ratio(completed, F.col("providers_based")), 1).alias("per_provider"),
            F.round(ratio(completed, F.col("panel_total")), 3).alias("per_panel_member"),
        )
    )


def _cv_pct(col: str) -> Column:
    return F.round(share_pct(F.stddev_samp(col), F.avg(col)), 2).alias("cv_pct")


def _spread(col: str) -> Column:
    return F.round(ratio(F.max(col), F.min(col)), 3).alias("max_min_ratio")


def throughput_dispersion(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count("*").alias("n_clinics"),
        F.min("completed").alias("min_completed"),
        F.max("completed").alias("max_completed"),
        F.round(F.stddev_samp("completed"), 0).alias("sd"),
        _cv_pct("completed"),
        _spread("completed"),
    )


def encounter_dispersion(facts: DataFrame) -> DataFrame:
    return facts.agg(_cv_pct("encounters"), _spread("encounters"))


def facility_pair(facts: DataFrame, pair: Sequence[int | str]) -> DataFrame:
    return facts.filter(F.col("facility_id").isin(*pair)).orderBy("city", "facility_id")


def compare_facilities(metrics: DataFrame, a: int | str, b: int | str) -> DataFrame:
    return metrics.filter(F.col("facility_id").isin(a, b)).orderBy("facility_id")


def market_profile(summary: DataFrame, city: str) -> DataFrame:
    return summary.filter(F.col("city") == city)


def denominator_sensitivity(facts: DataFrame, cities: Sequence[str]) -> DataFrame:
    done = F.sum("completed")
    return (
        facts.filter(F.col("city").isin(*cities))
        .groupBy("city")
        .agg(
            F.count("*").alias("clinics"),
            F.round(F.avg("completed"), 0).alias("per_clinic"),
            F.round(ratio(done, F.sum("providers")), 1).alias("per_provider"),
            F.round(ratio(done, F.sum("panel")), 3).alias("per_panel_member"),
        )
    )


def owned_composition(facilities: DataFrame, cities: Sequence[str]) -> DataFrame:
    kind = F.col("facility_type")
    return (
        facilities.filter((F.col("ownership") == "owned") & F.col("city").isin(*cities))
        .groupBy("city")
        .agg(
            F.count_if(kind == "clinic").alias("clinics"),
            F.count_if(kind == "hospital").alias("hospitals"),
            F.count_if(kind == "urgent_care").alias("urgent_care"),
        )
    )


def top_destinations(
    claims: DataFrame, members: DataFrame, facilities: DataFrame, cities: Sequence[str], k: int = 6
) -> DataFrame:
    """The k most used (city, ownership) destinations per market, ties by name."""
    home = members.filter(F.col("city").isin(*cities))
    order = Window.partitionBy("member_city").orderBy(F.desc("claims"), "care_city", "ownership")
    return (
        market.placed_claims(claims, home, facilities)
        .groupBy("member_city", "care_city", "ownership")
        .agg(F.sum("claims").alias("claims"))
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= k)
        .drop("place")
        .orderBy("member_city", F.desc("claims"))
    )


def market_leakage(
    claims: DataFrame, members: DataFrame, facilities: DataFrame, cities: Sequence[str]
) -> DataFrame:
    home = members.filter(F.col("city").isin(*cities))
    outside = sum_or_zero(F.col("care_city") != F.col("member_city"), F.col("allowed"))
    return (
        market.placed_claims(claims, home, facilities)
        .groupBy("member_city")
        .agg(
            F.round(millions(F.sum("allowed")), 1).alias("total_musd"),
            F.round(millions(outside), 1).alias("out_of_market_musd"),
            F.round(share_pct(outside, F.sum("allowed")), 1).alias("pct_out_of_market"),
        )
    )


def claims_by_site_type(
    claims: DataFrame, members: DataFrame, facilities: DataFrame, cities: Sequence[str]
) -> DataFrame:
    home = members.filter(F.col("city").isin(*cities))
    return (
        market.placed_claims(claims, home, facilities)
        .groupBy("member_city", "facility_type", (F.col("care_city") == F.col("member_city")).alias("in_market"))
        .agg(
            F.sum("claims").alias("claims"),
            F.round(millions(F.sum("allowed")), 1).alias("musd"),
            F.round(ratio(F.sum("allowed"), F.sum("claims")), 0).alias("avg_allowed"),
        )
        .orderBy("member_city", F.desc_nulls_last("musd"))
    )


def unfiltered_denominator(
    facilities: DataFrame, appointments: DataFrame, cities: Sequence[str]
) -> DataFrame:
    """Completed volume per clinic, over all clinics and over owned clinics only."""
    done = appointments.groupBy("facility_id").agg(
        F.count_if(F.col("status") == "completed").alias("completed")
    )
    owned = F.col("ownership") == "owned"
    clinics = facilities.filter((F.col("facility_type") == "clinic") & F.col("city").isin(*cities))
    return (
        clinics.join(done, "facility_id", "left")
        .groupBy("city")
        .agg(
            F.round(ratio(F.sum("completed"), F.count("*")), 4).alias("per_clinic_all"),
            F.round(ratio(F.sum(F.when(owned, F.col("completed"))), F.count_if(owned)), 4).alias(
                "per_clinic_owned"
            ),
        )
    )


def clinic_comparison(metrics: DataFrame, cities: Sequence[str]) -> DataFrame:
    return (
        metrics.filter(
            (F.col("ownership") == "owned")
            & (F.col("facility_type") == "clinic")
            & F.col("city").isin(*cities)
        )
        .groupBy("city")
        .agg(F.round(F.avg("appts_completed"), 6).alias("avg_completed"))
    )


def clinic_comparison_raw(
    facilities: DataFrame, appointments: DataFrame, cities: Sequence[str], span: Span
) -> DataFrame:
    """The same from appointments; a clinic without any is not in the denominator."""
    volume = facility.appointment_volume(appointments, span)
    sites = facilities.filter(
        (F.col("ownership") == "owned") & (F.col("facility_type") == "clinic") & F.col("city").isin(*cities)
    )
    return (
        volume.join(sites, "facility_id")
        .groupBy("city")
        .agg(F.round(F.avg("appts_completed"), 6).alias("avg_completed"))
    )


def member_counts(members: DataFrame, cities: Sequence[str]) -> DataFrame:
    return members.filter(F.col("city").isin(*cities)).groupBy("city").agg(F.count("*").alias("members"))


def link_coverage(xwalk: DataFrame, patients: DataFrame) -> DataFrame:
    total = patients.agg(F.count("*")).scalar()
    return xwalk.agg(F.count("*").alias("links")).select(
        "links", F.round(share_pct(F.col("links"), total), 4).alias("pct_linked")
    )


def staffing_extremes(metrics: DataFrame) -> DataFrame:
    """The owned clinic with most providers, next to the typical owned clinic."""
    clinics = metrics.filter((F.col("ownership") == "owned") & (F.col("facility_type") == "clinic"))
    top = F.min_by("facility_id", F.struct(-F.col("providers_based"), F.col("facility_id")))
    return clinics.agg(
        top.alias("most_staffed"),
        F.max("providers_based").alias("most_providers"),
        F.round(F.avg("providers_based"), 4).alias("typical_providers"),
    )


def period_coverage(sources: Sequence[tuple[str, DataFrame, str, str]], period: Span) -> DataFrame:
    """Rows per source in a requested period, or NULL where the source does not cover it.

    A source is (name, rows, event column, type of that column); its observed range
    and the count come from one pass.
    """

    def row(name: str, df: DataFrame, column: str, kind: str) -> DataFrame:
        seen = df.agg(
            F.to_date(F.min(column)).alias("observed_from"),
            F.to_date(F.max(column)).alias("observed_to"),
            F.count_if(in_span(F.col(column), period, kind)).alias("n"),
        )
        overlaps = (F.col("observed_from") < F.lit(period.hi)) & (F.col("observed_to") >= F.lit(period.lo))
        whole = (F.col("observed_from") <= F.lit(period.lo)) & (
            F.col("observed_to") >= F.date_sub(F.lit(period.hi), 1)
        )
        return seen.select(
            F.lit(name).alias("source"),
            "observed_from",
            "observed_to",
            F.when(whole, "covered").when(overlaps, "partly covered").otherwise("outside window").alias("coverage"),
            F.when(overlaps, F.col("n")).alias("rows_in_period"),
        )

    return reduce(DataFrame.unionByName, [row(*s) for s in sources])


def realized_completion(appointments: DataFrame, as_of: date) -> DataFrame:
    """Completion among appointments whose time has passed."""
    past = appointments.filter(F.col("scheduled_dt_local") < F.lit(as_of).cast("timestamp_ntz"))
    return past.groupBy("facility_id").agg(
        F.count("*").alias("due"),
        F.round(share_pct(F.count_if(F.col("status") == "completed"), F.count("*")), 2).alias("pct_realized"),
    )


def referral_funnel(referrals: DataFrame) -> DataFrame:
    return referrals.agg(
        F.count("*").alias("issued"),
        F.count("scheduled_dt").alias("scheduled"),
        F.count("completed_dt").alias("completed"),
        F.round(share_pct(F.count("completed_dt"), F.count("*")), 2).alias("pct_completed"),
        F.count_if(F.col("referred_to_facility_id").isNull()).alias("undirected"),
    )


def booking_lead_time(appointments: DataFrame) -> DataFrame:
    lead = days_between(F.col("booked_at"), F.col("scheduled_dt_local"))
    return appointments.groupBy("facility_id").agg(
        F.round(F.avg(lead), 4).alias("avg_lead_days"), F.max(lead).alias("max_lead_days")
    )
