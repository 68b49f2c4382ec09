"""Where to build next, and what: access, leakage, catchment, sizing, recapture."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.geo import distance_miles
from sitelens.functions.measures import millions, or_zero, ratio, share_pct, sum_if, sum_or_zero
from sitelens.functions.scale import exact_quantiles
from sitelens.functions.temporal import active_on
from sitelens.operators import market

ALLOWED, PAID = "allowed", "paid"


def market_access(summary: DataFrame, cities: Sequence[str]) -> DataFrame:
    return (
        summary.filter(F.col("city").isin(*cities))
        .select(
            "city",
            "members_total",
            "members_active",
            "owned_hospitals",
            "owned_urgent_care",
            "owned_clinics",
            "pct_acute_in_market",
            "median_miles_to_acute",
            "pct_acute_over_30mi",
            F.round(100 - F.col("pct_allowed_in_market"), 1).alias("pct_dollars_out_of_market"),
            "allowed_musd",
            "recapture_plan_paid_musd",
        )
        .orderBy(F.desc_nulls_last("members_active"), "city")
    )


def away() -> Column:
    return F.col("care_city") != F.col("member_city")


def out_of_market_dollars(
    claims: DataFrame, members: DataFrame, facilities: DataFrame, city: str, since: date
) -> DataFrame:
    """The same share on two bases: claims since a date, and the yearly mean of three years.

    Both bases come from one pass; the two rows are unfolded from one row of sums.
    """
    recent = claims.withColumn("recent", F.col("service_date") >= F.lit(since))
    placed = market.placed_claims(
        recent, members.filter(F.col("city") == city), facilities, keys=("recent",)
    )
    sums = placed.agg(
        sum_if(F.col("recent"), F.col(ALLOWED)).alias("recent_all"),
        sum_if(F.col("recent"), F.when(away(), F.col(ALLOWED)).otherwise(0)).alias("recent_away"),
        F.sum(ALLOWED).alias("full_all"),
        sum_or_zero(away(), F.col(ALLOWED)).alias("full_away"),
    )

    def basis(label: str, prefix: str, years: int) -> Column:
        total, outside = F.col(f"{prefix}_all"), F.col(f"{prefix}_away")
        return F.struct(
            F.lit(label).alias("basis"),
            F.round(millions(total) / years, 1).alias("allowed_musd"),
            F.round(millions(outside) / years, 1).alias("out_of_market_musd"),
            F.round(share_pct(outside, total), 1).alias("pct_out_of_market"),
        )

    rows = F.array(basis("trailing 12 months", "recent", 1), basis("3-year total / 3", "full", 3))
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def owned_share_by_market(
    claims: DataFrame, members: DataFrame, facilities: DataFrame, min_claims: int
) -> DataFrame:
    return (
        market.placed_claims(claims, members, facilities)
        .groupBy(F.col("member_city").alias("city"))
        .agg(
            F.sum("claims").alias("n"),
            F.round(
                share_pct(sum_or_zero(F.col("ownership") == "owned", F.col(ALLOWED)), F.sum(ALLOWED)), 1
            ).alias("pct_allowed_owned"),
        )
        .filter(F.col("n") > min_claims)
        .drop("n")
        .orderBy(F.asc_nulls_last("pct_allowed_owned"), "city")
    )


def corridor_totals(summary: DataFrame, cities: Sequence[str]) -> DataFrame:
    return summary.filter(F.col("city").isin(*cities)).agg(
        F.sum("members_active").alias("corridor_active_members"),
        F.round(F.sum("recapture_plan_paid_musd"), 1).alias("corridor_recapture_plan_paid_musd"),
    )


def distance_to_anchor(
    facilities: DataFrame, members: DataFrame, anchor_city: str, cities: Sequence[str], as_of: date
) -> DataFrame:
    """Active members of ``cities`` with miles to the centroid of the owned sites."""
    anchors = facilities.filter((F.col("ownership") == "owned") & (F.col("city") == anchor_city))
    lat = anchors.agg(F.avg(F.col("latitude").cast("double"))).scalar()
    lon = anchors.agg(F.avg(F.col("longitude").cast("double"))).scalar()
    return members.filter(
        F.col("city").isin(*cities)
        & active_on(F.col("enrollment_date"), F.col("termination_date"), as_of)
    ).select("city", distance_miles(F.col("latitude"), F.col("longitude"), lat, lon).alias("miles"))


def catchment(
    facilities: DataFrame, members: DataFrame, anchor_city: str, cities: Sequence[str], as_of: date
) -> DataFrame:
    away_from = distance_to_anchor(facilities, members, anchor_city, cities, as_of)
    miles = F.col("miles")
    counts = away_from.groupBy("city").agg(
        F.count("*").alias("active_members"),
        F.round(share_pct(F.count_if(miles <= 30), F.count("*")), 1).alias("pct_within_30mi"),
        F.round(share_pct(F.count_if(miles <= 45), F.count("*")), 1).alias("pct_within_45mi"),
    )
    median = exact_quantiles(away_from, ["city"], "miles", {"median_miles": 0.5})
    return (
        counts.join(median, "city", "left")
        .withColumn("median_miles_to_site", F.round("median_miles", 1))
        .drop("median_miles")
        .orderBy(F.desc("active_members"), "city")
    )


def reachable_catchment(
    facilities: DataFrame, members: DataFrame, anchor_city: str, neighbour: str, as_of: date
) -> DataFrame:
    """Anchor members plus the share of the neighbour within 45 miles."""
    away_from = distance_to_anchor(facilities, members, anchor_city, [anchor_city, neighbour], as_of)
    home, near = F.col("city") == anchor_city, F.col("miles") <= 45
    return away_from.agg(
        F.count_if(home).alias("anchor_members"),
        F.count_if(~home).alias("neighbour_members"),
        F.count_if(~home & near).alias("neighbour_reachable"),
        (F.count_if(home) + F.count_if(~home & near)).alias("reachable_members"),
    )


def capacity_sizing(
    spark: SparkSession,
    metrics: DataFrame,
    summary: DataFrame,
    anchor_facility: int | str,
    catchments: Sequence[tuple[str, str]],
) -> DataFrame:
    """Beds and rooms at the network's and the anchor's capacity per active member.

    ``catchments`` is an inline table of (label, city); totals are scalar subqueries.
    """
    owned = metrics.filter(F.col("ownership") == "owned")
    anchor = metrics.filter(F.col("facility_id") == anchor_facility).select("city", "total_beds")
    net_beds = owned.agg(F.sum("total_beds")).scalar()
    net_ors = owned.agg(F.sum("total_ors")).scalar()
    book = summary.agg(F.sum("members_active")).scalar()
    anchor_beds = anchor.agg(F.max("total_beds")).scalar()
    anchor_book = summary.join(anchor, "city", "left_semi").agg(F.sum("members_active")).scalar()
    inline = spark.createDataFrame(list(catchments), "label string, city string")
    members = F.col("members")
    return (
        summary.join(F.broadcast(inline), "city")  # the inline table is an argument list
        .groupBy("label")
        .agg(F.sum("members_active").alias("members"))
        .select(
            "label",
            "members",
            F.round(ratio(net_beds * members, book), 0).alias("beds_network_ratio"),
            F.round(ratio(anchor_beds * members, anchor_book), 0).alias("beds_anchor_ratio"),
            F.round(ratio(net_ors * members, book), 1).alias("ors_network_ratio"),
        )
    )


def sizing_anchors(metrics: DataFrame, summary: DataFrame, anchor_facility: int | str, members: int) -> DataFrame:
    """The two per-member anchors for a catchment of ``members`` people."""
    owned = F.col("ownership") == "owned"
    anchor = F.col("facility_id") == anchor_facility
    capacity = metrics.agg(
        F.sum(F.when(owned, F.col("total_beds"))).alias("beds"),
        F.sum(F.when(owned, F.col("total_ors"))).alias("ors"),
        F.max(F.when(anchor, F.col("total_beds"))).alias("anchor_beds"),
    )
    site = metrics.filter(anchor).select("city")
    book = summary.agg(F.sum("members_active")).scalar()
    anchor_book = summary.join(site, "city", "left_semi").agg(F.sum("members_active")).scalar()
    return capacity.select(
        F.round(ratio(F.col("beds") * members, book), 4).alias("network_beds"),
        F.round(ratio(F.col("ors") * members, book), 4).alias("network_ors"),
        F.round(ratio(F.col("anchor_beds") * members, anchor_book), 4).alias("anchor_site_beds"),
    )


def share_served_in_corridor(flows: DataFrame, cities: Sequence[str]) -> DataFrame:
    amount = F.col("allowed_musd")
    return (
        flows.filter(F.col("member_city").isin(*cities))
        .groupBy("service_line")
        .agg(
            F.round(F.sum(amount), 1).alias("allowed_musd"),
            F.round(share_pct(sum_if(F.col("care_city").isin(*cities), amount), F.sum(amount)), 1).alias(
                "pct_served_in_corridor"
            ),
        )
        .orderBy(F.desc_nulls_last("allowed_musd"), "service_line")
    )


def recapture_by_line(flows: DataFrame, cities: Sequence[str]) -> DataFrame:
    gain = F.sum(F.col("plan_paid_musd") - F.col("if_owned_plan_paid_musd"))
    return (
        flows.filter(F.col("member_city").isin(*cities) & (F.col("ownership") != "owned"))
        .groupBy("service_line")
        .agg(F.round(gain, 1).alias("recapture_plan_paid_musd"))
        .orderBy(F.desc_nulls_last("recapture_plan_paid_musd"), "service_line")
    )


def facility_benchmark(metrics: DataFrame, summary: DataFrame, facility: int | str) -> DataFrame:
    return (
        metrics.filter(F.col("facility_id") == facility)
        .select("facility_id", "city", "total_beds", "total_ors", "or_utilization_pct", "bed_occupancy_pct")
        .join(summary.select("city", F.col("members_active").alias("market_active_members")), "city")
    )


def utilization_range(metrics: DataFrame) -> DataFrame:
    return metrics.filter(
        (F.col("ownership") == "owned") & (F.col("facility_type") == "hospital")
    ).agg(
        F.min("or_utilization_pct").alias("or_util_min"),
        F.max("or_utilization_pct").alias("or_util_max"),
        F.min("bed_occupancy_pct").alias("bed_occ_min"),
        F.max("bed_occupancy_pct").alias("bed_occ_max"),
    )


def paid_share_by_status(claims: DataFrame, since: date) -> DataFrame:
    return (
        claims.filter(F.col("service_date") >= F.lit(since))
        .groupBy("network_status")
        .agg(
            F.round(F.avg(F.col("allowed_amount").cast("double")), 0).alias("avg_allowed"),
            F.round(F.avg(ratio(F.col("plan_paid"), F.col("allowed_amount"))), 3).alias("plan_paid_ratio"),
        )
        .orderBy(F.asc_nulls_last("plan_paid_ratio"))
    )


def top_recapture(summary: DataFrame, k: int = 5) -> DataFrame:
    return (
        summary.select("city", "recapture_plan_paid_musd")
        .orderBy(F.desc_nulls_last("recapture_plan_paid_musd"), "city")
        .limit(k)
    )


def market_ranking(summary: DataFrame, min_active: int, k: int = 10) -> DataFrame:
    return (
        summary.filter(F.col("members_active") > min_active)
        .select("city", "members_active", "owned_hospitals", "median_miles_to_acute", "recapture_plan_paid_musd")
        .orderBy(F.desc_nulls_last("median_miles_to_acute"), "city")
        .limit(k)
    )


def acute_miles_by_market(
    claims: DataFrame, members: DataFrame, facilities: DataFrame, min_claims: int
) -> DataFrame:
    """Claims and exact median miles to acute care, for the members and claims passed in."""
    placed = market.placed_claims(
        claims.filter(market.is_acute(F.col("service_line"))), members, facilities
    ).withColumnRenamed("member_city", "city")
    return exact_quantiles(
        placed, ["city"], "miles", {"median_miles": 0.5}, weight="claims", rows="n"
    ).filter(F.col("n") > min_claims)


def market_ranking_raw(
    claims: DataFrame, members: DataFrame, facilities: DataFrame, as_of: date, min_claims: int, k: int = 10
) -> DataFrame:
    """The ranking without the mart; counts every member, measures the not-ended ones."""
    not_ended = F.col("termination_date").isNull() | (F.col("termination_date") > F.lit(as_of))
    ranked = acute_miles_by_market(claims, members.filter(not_ended), facilities, min_claims)
    people = members.groupBy("city").agg(F.count("*").alias("members"))
    return (
        ranked.join(people, "city")
        .select("city", "members", F.round("median_miles", 6).alias("median_miles"))
        .orderBy(F.desc_nulls_last("median_miles"), "city")
        .limit(k)
    )


def leakage(summary: DataFrame, min_active: int) -> DataFrame:
    return (
        summary.filter(F.col("members_active") > min_active)
        .select("city", "pct_acute_in_market", "nonowned_acute_plan_paid_musd")
        .orderBy(F.asc_nulls_last("pct_acute_in_market"), "city")
    )


def leakage_raw(claims: DataFrame, members: DataFrame, facilities: DataFrame, min_claims: int) -> DataFrame:
    n = F.col("claims")
    return (
        market.placed_claims(claims.filter(market.is_acute(F.col("service_line"))), members, facilities)
        .groupBy(F.col("member_city").alias("city"))
        .agg(
            F.sum(n).alias("n"),
            F.round(share_pct(sum_or_zero(~away(), n), F.sum(n)), 6).alias("pct_in_market"),
            F.round(millions(sum_if(F.col("ownership") != "owned", F.col(PAID))), 6).alias("nonowned_paid_musd"),
        )
        .filter(F.col("n") > min_claims)
        .drop("n")
        .orderBy("pct_in_market", "city")
    )


def out_of_network_split(flows: DataFrame) -> DataFrame:
    """Of the dollars leaving a market, how much still lands at owned sites."""
    left = ~F.col("in_market")
    amount = F.col("allowed_musd")
    return flows.groupBy("member_city").agg(
        F.round(share_pct(sum_or_zero(left, amount), F.sum(amount)), 1).alias("pct_out_of_market"),
        F.round(
            share_pct(sum_or_zero(left & (F.col("ownership") == "owned"), amount), sum_if(left, amount)), 1
        ).alias("pct_of_leaving_at_owned"),
        F.round(
            share_pct(sum_or_zero(F.col("network_status") == "out_of_network", amount), F.sum(amount)), 1
        ).alias("pct_out_of_network"),
    )


def covered_leakage(
    claims: DataFrame, members: DataFrame, facilities: DataFrame
) -> DataFrame:
    """Dollars at non-owned sites, only for lines the owned network offers in that market."""
    offered = (
        facilities.filter(F.col("ownership") == "owned")
        .select(
            F.col("city").alias("member_city"),
            F.explode(F.split("service_lines", r"\s*,\s*")).alias("service_line"),
        )
        .distinct()
    )
    outside = F.col("ownership") != "owned"
    return (
        market.placed_claims(claims, members, facilities, keys=("service_line",))
        .groupBy("member_city", "service_line")
        .agg(
            F.sum("claims").alias("claims"),
            F.sum(ALLOWED).alias(ALLOWED),
            or_zero(sum_if(outside, F.col(ALLOWED))).alias("leaked"),
        )
        .join(offered, ["member_city", "service_line"], "left_semi")
        .select(
            "member_city",
            "service_line",
            "claims",
            F.round(millions(F.col(ALLOWED)), 4).alias("allowed_musd"),
            F.round(millions(F.col("leaked")), 4).alias("leaked_musd"),
            F.round(share_pct(F.col("leaked"), F.col(ALLOWED)), 2).alias("pct_leaked"),
        )
    )
