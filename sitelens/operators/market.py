"""Market marts: claims follow the member's city, wherever the care was delivered.

Claims first collapse to one row per (member, site, service line, network status)
with counts and sums.  That partial sum bounds what one member can bring to the join
on member_id, however many claims the member holds, and feeds both marts.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions.geo import distance_miles
from sitelens.functions.measures import ratio
from sitelens.functions.scale import broadcast_within, exact_quantiles, staged
from sitelens.functions.temporal import Span, active_on, in_span

# fixed values: the hospital service lines and the distance that counts as far
ACUTE_LINES = ["surgery", "cardiology", "er", "oncology"]
FAR_MILES = 30

LINE_KEYS = ("service_line", "network_status")
ADDITIVE = ["claims", "allowed", "paid", "ratio_sum", "ratio_rows"]


def is_acute(line: Column) -> Column:
    return line.isin(ACUTE_LINES)


def claim_amounts(claims: DataFrame, span: Span | None, keys: Sequence[str] = LINE_KEYS) -> DataFrame:
    """Claims reduced to their keys and the amounts that add up."""
    if span:
        claims = claims.filter(in_span(F.col("service_date"), span))
    paid_share = "try_divide(cast(plan_paid AS double), cast(allowed_amount AS double))"
    amounts = {
        "claims": "1L",
        "allowed": "allowed_amount",
        "paid": "plan_paid",
        "ratio_sum": paid_share,
        "ratio_rows": f"if({paid_share} IS NULL, 0L, 1L)",
    }
    return claims.select("member_id", "facility_id", *keys, *[F.expr(f"{amounts[name]} AS {name}") for name in ADDITIVE])


def located_claims(
    claims: DataFrame,
    members: DataFrame,
    facilities: DataFrame,
    span: Span | None,
    keys: Sequence[str] = LINE_KEYS,
) -> DataFrame:
    """Claims with both ends placed; unmatched keys stay, flagged by NULL.

    They stay because the paid share of owned care is defined on all claims, while
    market figures use only claims whose member and facility are known.  The join with the
    members is the one exchange of claim size; it lies directly over the scans, so that a hot
    member is split by the adaptive skew join, and every aggregate above it combines map-side.
    """
    home = members.selectExpr(
        "member_id",
        "city AS member_city",
        "state AS member_state",
        "latitude AS home_lat",
        "longitude AS home_lon",
        "true AS known_member",
    )
    site = facilities.selectExpr(
        "facility_id",
        "city AS care_city",
        "ownership",
        "facility_type",
        "latitude AS site_lat",
        "longitude AS site_lon",
        "true AS known_site",
    )
    miles = distance_miles(F.col("home_lat"), F.col("home_lon"), F.col("site_lat"), F.col("site_lon"))
    return (
        claim_amounts(claims, span, keys)
        .join(home, "member_id", "left")
        .join(site, "facility_id", "left")
        .select(
            "member_city",
            "member_state",
            "care_city",
            *keys,
            "ownership",
            "facility_type",
            F.expr("known_member AND known_site AS placed"),
            miles.alias("miles"),
            *ADDITIVE,
        )
    )


def placed_claims(
    claims: DataFrame,
    members: DataFrame,
    facilities: DataFrame,
    span: Span | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Located claims whose member and facility are both on file."""
    return located_claims(claims, members, facilities, span, keys).filter("placed")


def care_ledger(located: DataFrame) -> DataFrame:
    """Additive amounts per market, destination, line, network status and ownership."""
    return located.groupBy(
        "member_city", "care_city", "service_line", "network_status", "ownership", "placed"
    ).agg(F.min("member_state").alias("member_state"), *[F.sum(c).alias(c) for c in ADDITIVE])


def owned_ratios(ledger: DataFrame) -> DataFrame:
    """Paid share of owned care per service line: the mean of its row ratios."""
    return (
        ledger.filter(F.col("network_status") == "owned")
        .groupBy("service_line")
        .agg(ratio(F.sum("ratio_sum"), F.sum("ratio_rows")).alias("owned_ratio"))
    )


def member_counts(members: DataFrame, as_of: date) -> DataFrame:
    active = active_on(F.col("enrollment_date"), F.col("termination_date"), as_of)
    return members.groupBy("city").agg(
        F.min("state").alias("state"),
        F.count("*").alias("members_total"),
        F.count_if(active).alias("members_active"),
    )


def footprint(facility_metrics: DataFrame) -> DataFrame:
    sites = facility_metrics.selectExpr("*", "ownership = 'owned' AS own", "facility_type AS kind")
    measures = {
        "owned_clinics": "count_if(own AND kind = 'clinic')",
        "owned_hospitals": "count_if(own AND kind = 'hospital')",
        "owned_urgent_care": "count_if(own AND kind = 'urgent_care')",
        "owned_facilities": "count_if(own)",
        "partner_facilities": "count_if(ownership = 'partner')",
        "providers_based_owned": "sum(if(own, providers_based, NULL))",
        "appts_completed": "sum(appts_completed)",
        "owned_beds": "sum(if(own, total_beds, NULL))",
        "owned_ors": "sum(if(own, total_ors, NULL))",
    }
    return sites.groupBy("city").agg(*[F.expr(f"{m} AS {n}") for n, m in measures.items()])


def market_spend(located: DataFrame) -> DataFrame:
    """Every additive claim measure per market.

    The owned paid share is a window over market x line sums, so its partitions hold
    one row per market and never claim-grain rows.
    """
    flagged = located.selectExpr(
        "member_city AS city",
        "service_line",
        "coalesce(placed, false) AS placed",
        "placed AND ownership = 'owned' AS at_owned",
        "placed AND ownership <> 'owned' AS elsewhere",
        "placed AND member_city = care_city AS at_home",
        f"placed AND miles > {FAR_MILES} AS far",
        "network_status = 'owned' AS owned_claim",
        *ADDITIVE,
    )
    by_line = {
        "n": "sum(if(placed, claims, NULL))",
        "allowed": "sum(if(placed, allowed, NULL))",
        "paid": "sum(if(placed, paid, NULL))",
        "allowed_owned": "sum(if(at_owned, allowed, 0))",
        "allowed_local": "sum(if(at_home, allowed, 0))",
        "n_local": "sum(if(at_home, claims, 0))",
        "n_far": "sum(if(far, claims, 0))",
        "paid_elsewhere": "sum(if(elsewhere, paid, NULL))",
        "allowed_elsewhere": "sum(if(elsewhere, allowed, NULL))",
        "owned_sum": "sum(if(owned_claim, ratio_sum, NULL))",
        "owned_rows": "sum(if(owned_claim, ratio_rows, NULL))",
    }
    per_line = "OVER (PARTITION BY service_line)"
    lines = (
        flagged.groupBy("city", "service_line")
        .agg(*[F.expr(f"{m} AS {n}") for n, m in by_line.items()])
        .selectExpr("*", f"try_divide(sum(owned_sum) {per_line}, sum(owned_rows) {per_line}) AS owned_ratio")
        .filter("city IS NOT NULL AND n > 0")
        .withColumn("acute", is_acute(F.col("service_line")))
    )
    by_market = {
        "claims": "sum(n)",
        "allowed": "cast(sum(allowed) AS double)",
        "paid": "cast(sum(paid) AS double)",
        "allowed_owned": "cast(sum(allowed_owned) AS double)",
        "allowed_local": "cast(sum(allowed_local) AS double)",
        "acute_claims": "sum(if(acute, n, NULL))",
        "acute_allowed": "cast(sum(if(acute, allowed, NULL)) AS double)",
        "acute_local": "sum(if(acute, n_local, 0))",
        "acute_far": "sum(if(acute, n_far, 0))",
        "nonowned_musd": "cast(sum(if(acute, paid_elsewhere, NULL)) AS double) / 1e6D",
        "if_owned_musd": "sum(if(acute, cast(allowed_elsewhere AS double) * owned_ratio, NULL)) / 1e6D",
    }
    return lines.groupBy("city").agg(*[F.expr(f"{m} AS {n}") for n, m in by_market.items()])


def acute_distance(located: DataFrame) -> DataFrame:
    """Exact median miles to acute care per market, over the underlying claims."""
    acute = located.filter(F.col("placed") & is_acute(F.col("service_line")))
    return exact_quantiles(
        acute.withColumnRenamed("member_city", "city"),
        ["city"],
        "miles",
        {"median_miles": 0.5},
        weight="claims",
    )


def market_summary(
    facility_metrics: DataFrame,
    facilities: DataFrame,
    members: DataFrame,
    claims: DataFrame,
    span: Span,
    as_of: date,
    located: DataFrame | None = None,
) -> DataFrame:
    """Per market; ``located``: the located claims of ``span``, if they are written already."""
    if located is None:
        # consumed by the sums and by the median: written once, read twice
        located = staged(located_claims(claims, members, facilities, span))

    def whole(name: str, label: str | None = None) -> str:
        return f"coalesce({name}, 0) AS {label or name}"

    def pct(part: str, of: str) -> str:
        return f"round(try_divide(100D * {part}, {of}), 1)"

    return (
        member_counts(members, as_of)
        .join(footprint(facility_metrics), "city", "left")
        .join(market_spend(located), "city", "left")
        .join(acute_distance(located), "city", "left")
        .selectExpr(
            "city",
            "state",
            "members_total",
            "members_active",
            whole("owned_clinics"),
            whole("owned_hospitals"),
            whole("owned_urgent_care"),
            whole("owned_facilities"),
            whole("partner_facilities"),
            "owned_beds",
            "owned_ors",
            whole("providers_based_owned"),
            whole("appts_completed", "appts_completed_at_facilities_here"),
            "claims",
            "round(allowed / 1e6D, 1) AS allowed_musd",
            "round(paid / 1e6D, 1) AS plan_paid_musd",
            f"{pct('allowed_owned', 'allowed')} AS pct_allowed_owned",
            f"{pct('allowed_local', 'allowed')} AS pct_allowed_in_market",
            "acute_claims",
            "round(acute_allowed / 1e6D, 1) AS acute_allowed_musd",
            f"{pct('acute_local', 'acute_claims')} AS pct_acute_in_market",
            "round(median_miles, 1) AS median_miles_to_acute",
            f"{pct('acute_far', 'acute_claims')} AS pct_acute_over_30mi",
            "round(nonowned_musd, 1) AS nonowned_acute_plan_paid_musd",
            "round(if_owned_musd, 1) AS acute_if_owned_plan_paid_musd",
            "round(nonowned_musd - if_owned_musd, 1) AS recapture_plan_paid_musd",
        )
    )


def market_flows(
    facilities: DataFrame, members: DataFrame, claims: DataFrame, span: Span, located: DataFrame | None = None
) -> DataFrame:
    """member_city x care_city x service_line x network_status, additive columns only.

    A line with no owned claim has no owned paid share and is left out.  ``located``: the located
    claims of ``span``, if they are written already.
    """
    if located is None:
        located = located_claims(claims, members, facilities, span)
    # the ledger is mart-sized; it is read for the shares and again for the flows
    ledger = staged(care_ledger(located))
    allowed = F.sum("allowed").cast("double")
    return (
        ledger.filter("placed")
        .join(broadcast_within(owned_ratios(ledger), 10_000), "service_line")
        .groupBy("member_city", "care_city", "service_line", "network_status")
        .agg(
            F.min("member_state").alias("member_state"),
            F.min("ownership").alias("ownership"),
            F.sum("claims").alias("claims"),
            F.round(allowed / 1e6, 4).alias("allowed_musd"),
            F.round(F.sum("paid").cast("double") / 1e6, 4).alias("plan_paid_musd"),
            F.round(allowed * F.min("owned_ratio") / 1e6, 4).alias("if_owned_plan_paid_musd"),
        )
        .select(
            "member_city",
            "member_state",
            "care_city",
            "service_line",
            is_acute(F.col("service_line")).alias("is_acute"),
            "network_status",
            "ownership",
            (F.col("member_city") == F.col("care_city")).alias("in_market"),
            "claims",
            "allowed_musd",
            "plan_paid_musd",
            "if_owned_plan_paid_musd",
        )
    )
