"""Every query by name; each takes a workspace and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions import similarity, temporal, text
from sitelens.functions.scale import exact_quantiles
from sitelens.functions.temporal import Span
from sitelens.operators import facility, freshness, identity, market, measure, people, quality, screening
from sitelens.plans import siting, utilization
from sitelens.plans.workspace import Workspace
from sitelens.sources import extract
from sitelens.sources.stand_in import AS_OF, SPAN, StandIn
from sitelens.streaming import landing

Query = Callable[[Workspace], DataFrame]

# parameters of the stand-in runs
FOCUS = "NATION_3"
CORRIDOR = ["NATION_3", "NATION_8", "NATION_14"]
NAMED = ["NATION_3", "NATION_8", "NATION_14", "NATION_16", "NATION_20"]
TWO = ["NATION_3", "NATION_8"]
ANCHOR_SITE, PAIR = 0, (3, 6)
MIN_ACTIVE, MIN_CLAIMS, CATCHMENT = 20, 100, 100
CATCHMENTS = [
    ("focus only", "NATION_3"),
    ("focus and neighbour", "NATION_3"),
    ("focus and neighbour", "NATION_8"),
    ("corridor", "NATION_3"),
    ("corridor", "NATION_8"),
    ("corridor", "NATION_14"),
]
BUILT_AT = datetime(2001, 6, 1, 3, 30)
PHRASES = ["worthless", "in the", "of the", "und die", "de la"]
ENTITIES = ["The", "Die", "La", "And", "Of"]
MARKERS = {"says_heit": ["heit", "keit"], "says_cion": ["ción"], "says_thth": ["thth", "ther"]}
DOCUMENT_ENTITIES = ["thatin", "ononst", "Eriner", "thanedble"]

TABLES = {
    "facilities": "ops_facilities",
    "members": "payer_members",
    "patients": "ehr_patients",
    "providers": "ops_providers",
    "claims": "payer_claims",
    "appointments": "ops_appointments",
    "encounters": "ehr_encounters",
    "or_schedule": "ops_or_schedule",
    "bed_census": "ops_bed_census_daily",
    "referrals": "ops_referrals",
    "conditions": "ehr_conditions",
    "rx_claims": "pharmacy_rx_claims",
    "eligibility": "payer_member_eligibility_history",
    "enrollments": "outreach_program_enrollments",
    "procedures": "ehr_procedures",
}
PROFILED = TABLES | {
    "plans": "payer_plans",
    "employers": "payer_employers",
    "programs": "outreach_wellness_programs",
    "isochrones": "external_drive_time_isochrones",
    "observations": "ehr_observations",
}
MARTS = ["identity_xwalk", "facility_metrics", "market_summary", "market_flows", "observations_monthly"]

QUERIES: dict[str, Query] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    return Workspace(StandIn(spark, folder), SPAN, AS_OF)


def bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(workspace(spark, folder))


def register(name: str) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        return query

    return keep


def _table(name: str) -> Query:
    return lambda w: w.table(name)


for _view, _name in TABLES.items():
    QUERIES[f"table_{_view}"] = _table(_name)


def claims(w: Workspace) -> DataFrame:
    return w.table("payer_claims")


def members(w: Workspace) -> DataFrame:
    return w.table("payer_members")


def sites(w: Workspace) -> DataFrame:
    return w.small("ops_facilities")


def all_tables(w: Workspace) -> dict[str, DataFrame]:
    """Every source table and mart; the market marts read the located claims from one table."""
    if not {"market_summary", "market_flows"} <= w.published.keys():
        w.settle("located_year")
    tables = {name: w.table(source) for name, source in PROFILED.items()}
    monthly = {"observations_monthly": freshness.observations_monthly(w.table("ehr_observations"))}
    return tables | {name: getattr(w, name) for name in MARTS if name not in monthly} | monthly


def settled(*names: str) -> Callable[[Query], Query]:
    """Settle marts before a query that reads them more than once."""

    def wrap(query: Query) -> Query:
        def run(w: Workspace) -> DataFrame:
            w.settle(*names)
            return query(w)

        return run

    return wrap


def clinic_facts(w: Workspace) -> DataFrame:
    return utilization.clinic_facts(
        sites(w),
        w.table("ops_providers"),
        members(w),
        w.table("ops_appointments"),
        w.windowed("ehr_encounters"),
        w.span,
        w.as_of,
    )


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- functions on whole tables ---------------------------------------------------


@register("normalized_names")
def normalized_names(w: Workspace) -> DataFrame:
    return w.table("ehr_patients").select(
        "patient_id",
        text.normalized_name(F.col("first_name")).alias("fn"),
        text.normalized_name(F.col("last_name")).alias("ln"),
    )


@register("accents_stripped")
def accents_stripped(w: Workspace) -> DataFrame:
    return w.table("documents").select(
        "doc_id", F.md5(text.strip_accents(F.col("text")).cast("binary")).alias("stripped_md5")
    )


@register("name_similarity")
def name_similarity(w: Workspace) -> DataFrame:
    """Similarity of every patient's name to the name of the member it was made from."""
    p = w.table("ehr_patients").filter("true_member_id IS NOT NULL")
    m = members(w).select(
        F.col("member_id").alias("true_member_id"), F.concat_ws(" ", "first_name", "last_name").alias("theirs")
    )
    return p.join(m, "true_member_id").select(
        "patient_id",
        F.round(
            similarity.jaro_winkler(F.concat_ws(" ", "first_name", "last_name"), F.col("theirs")), 6
        ).alias("similarity"),
    )


@register("phrase_similarity")
def phrase_similarity(w: Workspace) -> DataFrame:
    """Similarity of neighbouring answers' openings: long, accented, multi-byte text."""
    turns = w.table("answers").select("conv_id", "turn", F.lower("text").alias("text"))
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    return turns.join(following, ["conv_id", "turn"]).select(
        "conv_id", "turn", F.round(similarity.jaro_winkler(F.col("text"), F.col("reply")), 6).alias("similarity")
    )


@register("home_to_care_miles")
def home_to_care_miles(w: Workspace) -> DataFrame:
    pairs = market.placed_claims(claims(w), members(w), sites(w))
    return pairs.groupBy("member_city", "care_city").agg(
        F.sum("claims").alias("claims"),
        F.round(F.min("miles"), 6).alias("nearest"),
        F.round(F.max("miles"), 6).alias("farthest"),
    )


@register("or_case_minutes")
def or_case_minutes(w: Workspace) -> DataFrame:
    minutes = temporal.minutes_between(F.col("scheduled_start_dt_local"), F.col("scheduled_end_dt_local"))
    return w.table("ops_or_schedule").select("facility_id", "or_room", minutes.alias("minutes"))


@register("birth_date_swaps")
def birth_date_swaps(w: Workspace) -> DataFrame:
    return members(w).select("member_id", temporal.swapped_day_month(F.col("dob")).alias("swapped"))


# --- marts -------------------------------------------------------------------------

QUERIES |= {
    "facility_metrics": lambda w: w.facility_metrics,
    "market_summary": lambda w: w.market_summary,
    "market_flows": lambda w: w.market_flows,
    "identity_crosswalk": lambda w: rounded(w.identity_xwalk, 6, "match_confidence"),
    "build_metadata": lambda w: w.build_metadata(BUILT_AT),
    "observations_monthly": lambda w: rounded(
        freshness.observations_monthly(w.table("ehr_observations")), 6, "avg_value_numeric"
    ),
    "site_staffing": lambda w: facility.staffing(w.table("ops_providers")),
    "site_panel": lambda w: facility.panel(w.table("ops_providers"), members(w), w.as_of),
    "site_appointments": lambda w: facility.appointment_volume(w.windowed("ops_appointments"), w.span),
    "site_encounters": lambda w: facility.encounter_volume(w.windowed("ehr_encounters"), w.span),
    "site_operating_rooms": lambda w: facility.operating_rooms(w.windowed("ops_or_schedule"), w.span),
    "site_bed_use": lambda w: rounded(
        facility.bed_use(w.windowed("ops_bed_census_daily"), w.span), 6, "bed_occupancy_pct", "avg_los_days"
    ),
    "site_claims": lambda w: facility.delivered_claims(w.windowed("payer_claims"), w.span).withColumns(
        {c: F.col(c).cast("double") for c in ("allowed_amount", "plan_paid")}
    ),
    "market_members": lambda w: market.member_counts(members(w), w.as_of),
    "market_footprint": lambda w: market.footprint(w.site_capacity),
    "owned_paid_ratio": lambda w: rounded(
        market.owned_ratios(market.care_ledger(w.located_year)), 6, "owned_ratio"
    ),
    "acute_distance": lambda w: rounded(market.acute_distance(w.located_year), 6, "median_miles"),
}

# --- siting ------------------------------------------------------------------------

QUERIES |= {
    "market_access": lambda w: siting.market_access(w.market_summary, NAMED),
    "out_of_market_dollars": lambda w: siting.out_of_market_dollars(
        claims(w), members(w), sites(w), FOCUS, w.span.lo
    ),
    "owned_share_by_market": lambda w: siting.owned_share_by_market(claims(w), members(w), sites(w), MIN_CLAIMS),
    "corridor_totals": lambda w: siting.corridor_totals(w.market_summary, CORRIDOR),
    "corridor_catchment": lambda w: siting.catchment(
        w.table("ops_facilities"), members(w), FOCUS, CORRIDOR, w.as_of
    ),
    "capacity_sizing": settled("facility_metrics", "market_summary")(
        lambda w: siting.capacity_sizing(
            w.net.spark, w.facility_metrics, w.market_summary, ANCHOR_SITE, CATCHMENTS
        )
    ),
    "share_served_in_corridor": lambda w: siting.share_served_in_corridor(w.market_flows, CORRIDOR),
    "recapture_by_line": lambda w: siting.recapture_by_line(w.market_flows, CORRIDOR),
    "facility_benchmark": settled("facility_metrics")(
        lambda w: siting.facility_benchmark(w.facility_metrics, w.market_summary, ANCHOR_SITE)
    ),
    "utilization_range": lambda w: siting.utilization_range(w.facility_metrics),
    "paid_share_by_status": lambda w: siting.paid_share_by_status(claims(w), w.span.lo),
    "top_recapture": lambda w: siting.top_recapture(w.market_summary),
    "reachable_catchment": lambda w: siting.reachable_catchment(
        w.table("ops_facilities"), members(w), FOCUS, "NATION_8", w.as_of
    ),
    "sizing_anchors": settled("facility_metrics", "market_summary")(
        lambda w: siting.sizing_anchors(
            w.facility_metrics, w.market_summary, ANCHOR_SITE, CATCHMENT
        )
    ),
    "active_member_acute_miles": lambda w: rounded(
        siting.acute_miles_by_market(
            claims(w).filter(F.col("service_date") >= F.lit(w.span.lo)),
            members(w).filter(
                temporal.active_on(F.col("enrollment_date"), F.col("termination_date"), w.as_of)
            ),
            sites(w),
            MIN_CLAIMS,
        ),
        6,
        "median_miles",
    ),
    "market_ranking_mart": lambda w: siting.market_ranking(w.market_summary, MIN_ACTIVE),
    "market_ranking_raw": lambda w: siting.market_ranking_raw(
        w.windowed("payer_claims"), members(w), sites(w), w.as_of, MIN_ACTIVE
    ),
    "leakage_mart": lambda w: siting.leakage(w.market_summary, MIN_ACTIVE),
    "leakage_raw": lambda w: siting.leakage_raw(w.windowed("payer_claims"), members(w), sites(w), MIN_ACTIVE),
    "out_of_network_split": lambda w: siting.out_of_network_split(w.market_flows),
    "covered_leakage": lambda w: siting.covered_leakage(w.windowed("payer_claims"), members(w), sites(w)),
}

# --- utilization -------------------------------------------------------------------

QUERIES |= {
    "clinic_facts": clinic_facts,
    "throughput_dispersion": lambda w: utilization.throughput_dispersion(clinic_facts(w)),
    "encounter_dispersion": lambda w: utilization.encounter_dispersion(clinic_facts(w)),
    "size_matched_pair": lambda w: utilization.facility_pair(clinic_facts(w), PAIR),
    "denominator_sensitivity": lambda w: utilization.denominator_sensitivity(clinic_facts(w), NAMED),
    "owned_composition": lambda w: utilization.owned_composition(sites(w), NAMED),
    "top_destinations": lambda w: utilization.top_destinations(claims(w), members(w), sites(w), TWO),
    "market_leakage": lambda w: utilization.market_leakage(claims(w), members(w), sites(w), TWO),
    "claims_by_site_type": lambda w: utilization.claims_by_site_type(claims(w), members(w), sites(w), TWO),
    "unfiltered_denominator": lambda w: utilization.unfiltered_denominator(
        sites(w), w.table("ops_appointments"), NAMED
    ),
    "member_counts": lambda w: utilization.member_counts(members(w), TWO),
    "link_coverage": lambda w: utilization.link_coverage(w.identity_xwalk, w.table("ehr_patients")),
    "staffing_extremes": lambda w: utilization.staffing_extremes(w.facility_metrics),
    "period_coverage": lambda w: utilization.period_coverage(
        [
            ("claims", claims(w), "service_date", "date"),
            ("appointments", w.table("ops_appointments"), "scheduled_dt_local", "timestamp_ntz"),
            ("referrals", w.table("ops_referrals"), "issued_dt", "date"),
        ],
        Span(date(2000, 1, 1), date(2001, 1, 15)),
    ),
    "clinic_comparison_mart": lambda w: utilization.clinic_comparison(w.facility_metrics, NAMED),
    "clinic_comparison_raw": lambda w: utilization.clinic_comparison_raw(
        sites(w), w.windowed("ops_appointments"), NAMED, w.span
    ),
    "compare_facilities": lambda w: utilization.compare_facilities(w.facility_metrics, *PAIR),
    "market_profile": lambda w: utilization.market_profile(w.market_summary, FOCUS),
    "realized_completion": lambda w: utilization.realized_completion(
        w.table("ops_appointments"), date(2001, 1, 15)
    ),
    "referral_funnel": lambda w: utilization.referral_funnel(w.table("ops_referrals")),
    "booking_lead_time": lambda w: utilization.booking_lead_time(w.table("ops_appointments")),
}

# --- people ------------------------------------------------------------------------

QUERIES |= {
    "member_360": lambda w: people.member_360(
        members(w), w.identity_xwalk, w.small("ops_providers"), w.table("outreach_program_enrollments"), w.as_of
    ),
    "member_months": lambda w: people.member_months(w.table("payer_member_eligibility_history"), w.span),
    "condition_prevalence": lambda w: people.condition_prevalence(
        w.table("ehr_conditions"), w.identity_xwalk, members(w), FOCUS
    ),
    "age_mix": lambda w: people.age_mix(members(w), w.as_of, older_than=41),
    "drive_time_access": lambda w: people.drive_time_access(
        members(w), w.table("external_drive_time_isochrones")
    ),
    "crosswalk_with_address": lambda w: rounded(
        identity.identity_xwalk(w.table("ehr_patients"), members(w), extra=["address_line1"]), 6, "match_confidence"
    ),
    "crosswalk_with_date_variants": lambda w: rounded(
        identity.identity_xwalk_with_variants(w.table("ehr_patients"), members(w)), 6, "match_confidence"
    ),
}

# --- quality -----------------------------------------------------------------------


def path_tables(w: Workspace) -> dict[str, DataFrame]:
    w.settle("identity_xwalk")
    names = {n for p in quality.JOIN_PATHS for n in (p.left, p.right)} - {"identity_xwalk"}
    return {n: w.table(n) for n in names} | {"identity_xwalk": w.identity_xwalk}


def bands_of(metrics: DataFrame, summary: DataFrame) -> list[quality.Band]:
    """Published conclusions about the stand-in, each within a band that a wrong mart leaves."""
    own_clinic = (F.col("ownership") == "owned") & (F.col("facility_type") == "clinic")
    owned, recapture = F.col("pct_allowed_owned"), F.sum("recapture_plan_paid_musd")
    here = F.sum(F.when(F.col("city").isin(*CORRIDOR), F.col("recapture_plan_paid_musd")))
    return [
        quality.Band("bed_occupancy_mean", metrics, F.avg("bed_occupancy_pct"), 53.0, 54.0),
        quality.Band("owned_clinic_share_pct", metrics, 100.0 * F.count_if(own_clinic) / F.count("*"), 16.0, 20.5),
        quality.Band("no_show_mean", metrics, F.avg("pct_no_show"), 19.5, 20.5),
        quality.Band("owned_share_mean", summary, F.avg(owned), 33.0, 38.0),
        quality.Band("owned_share_spread_pp", summary, F.max(owned) - F.min(owned), 0.0, 12.0),
        quality.Band("farthest_market_miles", summary, F.max("median_miles_to_acute"), 650.0, 870.0),
        quality.Band("recaptured_share", summary, recapture / F.sum("nonowned_acute_plan_paid_musd"), 0.345, 0.37),
        quality.Band("corridor_recapture_pct", summary, 100.0 * here / recapture, 5.0, 15.0),
    ]


def conclusion_bands(w: Workspace) -> list[quality.Band]:
    w.settle("facility_metrics", "market_summary")
    return bands_of(w.facility_metrics, w.market_summary)


def reconciliation(w: Workspace) -> DataFrame:
    w.settle("facility_metrics", "market_summary")
    done = F.count_if(F.col("status") == "completed")
    raw_claims = w.windowed("payer_claims")
    return quality.reconcile(
        [
            ("appointments_completed", w.facility_metrics, F.sum("appts_completed"), w.windowed("ops_appointments"), done),
            ("claims", w.facility_metrics, F.sum("claims"), raw_claims, F.count("*")),
            ("allowed_amount", w.facility_metrics, F.round(F.sum("allowed_amount"), 2), raw_claims, F.sum("allowed_amount")),
            ("members", w.market_summary, F.sum("members_total"), members(w), F.count("*")),
            (
                "owned_facilities",
                w.market_summary,
                F.sum("owned_facilities"),
                w.facility_metrics,
                F.count_if(F.col("ownership") == "owned"),
            ),
            ("providers", w.facility_metrics, F.sum("providers_based"), w.table("ops_providers"), F.count("*")),
            (
                "flows_allowed_musd",
                w.market_flows,
                F.round(F.sum("allowed_musd"), 1),
                raw_claims.join(members(w).select("member_id"), "member_id").join(w.small("ops_facilities").select("facility_id"), "facility_id"),
                F.round(F.sum("allowed_amount").cast("double") / 1e6, 1),
            ),
        ],
        tolerance=0.01,
    )


def late_profile(w: Workspace) -> DataFrame:
    """Profile of the claims processed by a past day against the profile of all."""
    landed = claims(w).filter(F.col("processed_date") <= F.lit(date(2001, 1, 1)))
    return quality.profile_drift(
        quality.profile({"claims": landed}), quality.profile({"claims": claims(w), "referrals": w.table("ops_referrals")})
    )


RX_WATERMARK = date(1998, 7, 1)


def rx_versions(w: Workspace) -> DataFrame:
    """Fills as they landed: many corrected later, some without a landing date.

    Corrections land together, half of them on the watermark day.  Some move a fill far back,
    and those of one month empty it.
    """
    k, filled = F.col("rx_claim_id"), F.col("fill_date")
    amount = (F.col("member_id") % 100 + 1).cast("double")
    first = w.table("pharmacy_rx_claims").select(
        k,
        filled.alias("service_date"),
        F.when(k % 17 != 0, F.date_add(filled, (k % 75).cast("int"))).alias("landed"),
        amount.alias("amount"),
        F.lit(1).alias("version"),
    )
    emptied = F.trunc(filled, "MM") == F.lit(date(1995, 4, 1))
    again = w.table("pharmacy_rx_claims").filter((k % 5 == 0) | emptied).select(
        k,
        F.when(emptied, F.date_sub(filled, 40)).when(k % 3 == 0, F.date_sub(filled, 150)).otherwise(filled).alias("service_date"),
        F.when(emptied | (k % 7 != 0), F.when(k % 2 == 0, F.lit(RX_WATERMARK)).otherwise(F.lit(date(1998, 7, 9)))).alias("landed"),
        (amount / 2).alias("amount"),
        F.lit(2).alias("version"),
    )
    return first.unionByName(again)


QUERIES |= {
    "join_path_orphans": lambda w: quality.orphans(quality.JOIN_PATHS, path_tables(w)),
    "join_path_null_rates": lambda w: quality.null_rates(quality.JOIN_PATHS, path_tables(w)),
    "table_profile": lambda w: quality.profile(all_tables(w)).drop("data_type"),
    "first_date_ranges": lambda w: quality.first_date_ranges(quality.profile(all_tables(w))),
    "profile_drift": late_profile,
    "table_emptiness": lambda w: quality.table_emptiness(all_tables(w)),
    "crosswalk_invariants": settled("identity_xwalk")(
        lambda w: quality.crosswalk_invariants(
            w.identity_xwalk, w.table("ehr_patients"), identity.THRESHOLD
        )
    ),
    "links_by_method": lambda w: quality.links_by_method(w.identity_xwalk),
    "observed_windows": lambda w: quality.observed_windows(
        [(n, w.table(n), e) for n, e, _ in w.EVENTS if e is not None]
    ),
    "assignment_signal": lambda w: quality.assignment_signal(w.table("ops_appointments"), w.table("ops_providers")),
    "providers_per_site": lambda w: quality.providers_per_site(w.table("ops_appointments")),
    "sites_per_provider": lambda w: quality.sites_per_provider(w.table("ops_appointments"), sites(w)),
    "mart_reconciliation": reconciliation,
    "mart_grain": settled("facility_metrics", "identity_xwalk")(
        lambda w: quality.stacked(
            [
                quality.grain("facility_metrics", w.facility_metrics, ["facility_id"]),
                quality.grain("market_summary", w.market_summary, ["city"]),
                quality.grain(
                    "market_flows", w.market_flows, ["member_city", "care_city", "service_line", "network_status"]
                ),
                quality.grain("identity_xwalk", w.identity_xwalk, ["patient_id", "member_id"]),
            ]
        )
    ),
    "claim_key_grain": lambda w: quality.grain("claims", claims(w), ["member_id", "facility_id", "service_date"]),
    "duplicate_claim_days": lambda w: quality.duplicate_keys(claims(w), ["member_id", "service_date"]),
    "flows_against_summary": lambda w: quality.flows_against_summary(w.market_flows, w.market_summary),
    "metadata_counts": lambda w: quality.metadata_counts(w.build_metadata(BUILT_AT), w.sources()),
    "claims_lag": lambda w: quality.lag_distribution(claims(w), "service_date", "processed_date"),
    "uniformity": settled("facility_metrics", "market_summary")(
        lambda w: quality.uniformity(w.facility_metrics, w.market_summary, MIN_ACTIVE)
    ),
    "conclusion_bands": lambda w: quality.band_checks(conclusion_bands(w)),
    "stale_builds": lambda w: freshness.stale_builds(w.build_metadata(BUILT_AT), BUILT_AT + timedelta(hours=27)),
    "landed_since": lambda w: extract.landed_since(claims(w), "processed_date", date(2001, 5, 1))
    .groupBy("service_line")
    .agg(F.count("*").alias("claims"), F.min("service_date").alias("oldest_service")),
    "restated_months": lambda w: landing.restated_months(
        rx_versions(w), "rx_claim_id", "landed", RX_WATERMARK, "amount", then=["version"]
    ),
    "allowed_quantiles": lambda w: rounded(
        exact_quantiles(
            claims(w), ["service_line"], "allowed_amount", {"p10": 0.1, "p50": 0.5, "p90": 0.9}
        ),
        4,
        "p10",
        "p50",
        "p90",
    ),
}

# --- measurement and screening -------------------------------------------------------


def truth(w: Workspace) -> DataFrame:
    return measure.known_truth(w.identity_xwalk, w.table("ehr_patients"))


def screened(w: Workspace) -> DataFrame:
    return screening.banned_phrases(w.table("answers"), PHRASES)


def classified(w: Workspace) -> DataFrame:
    return screening.classify(w.table("answers"), ENTITIES, MARKERS)


def destained(w: Workspace) -> DataFrame:
    return screening.without_named_blocks(
        w.table("documents"), DOCUMENT_ENTITIES, r"\n(?=[AEIOU])", "[AEIOU]"
    )


def agreement(w: Workspace) -> DataFrame:
    return measure.agreement(w.identity_xwalk, w.table("ehr_patients"), members(w))


QUERIES |= {
    "heldout_agreement": lambda w: rounded(agreement(w), 6, *measure.SIGNALS),
    "link_precision": lambda w: measure.precision(agreement(w)),
    "corrupted_records": lambda w: measure.corrupt(w.table("ehr_patients")),
    "link_recall": lambda w: measure.recall(truth(w), members(w)),
    "variant_link_recall": lambda w: measure.recall(truth(w), members(w), identity.identity_xwalk_with_variants),
    "banned_phrases": lambda w: screened(w).select("conv_id", "turn", "banned", "passed"),
    "phrase_counts": lambda w: screening.phrase_counts(w.table("answers"), PHRASES),
    "pass_rates": lambda w: screening.pass_rates(screened(w), "role"),
    "answer_classes": lambda w: classified(w).select("conv_id", "turn", "recommendation", *MARKERS),
    "answer_consensus": lambda w: screening.consensus(classified(w)),
    "destained_documents": lambda w: destained(w).select(
        "doc_id", "n_blocks", "removed_blocks", F.md5("cleaned").alias("cleaned_md5"), "residual_lines"
    ),
    "residual_mentions": lambda w: screening.residual_mentions(
        w.table("documents"), DOCUMENT_ENTITIES, r"\n(?=[AEIOU])", "[AEIOU]"
    ),
}
