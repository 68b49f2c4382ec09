"""Plan shapes that decide whether a job survives a large, skewed input."""

import re

from paths import SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sums_combine_before_the_shuffle(spark, small):
    plan = plan_of(small.facility_metrics)
    assert "partial_sum" in plan and "partial_count" in plan


def test_no_window_over_claim_grain(spark, small):
    """Windows of the market marts run over market x line sums and histogram bins only."""
    plan = plan_of(small.market_summary)
    for keys in re.findall(r"Window \[.*?\], \[(.*?)\]", plan):
        assert "service_line" in keys or "city" in keys


def test_window_filter_reaches_the_scan(small):
    plan = plan_of(small.windowed("ehr_encounters"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate", plan)


def test_unused_sources_are_not_read_for_the_footprint(spark, small):
    from sitelens.operators import market

    plan = plan_of(market.footprint(small.site_capacity))
    assert "events.parquet" in plan and "part.parquet" in plan
    assert "lineitem.parquet" not in plan and "orders.parquet" not in plan


def test_claims_are_shuffled_once(spark, tmp_path):
    """Between the scan of claims and the market sums lies one exchange of claim grain, the member join's."""
    from sitelens.operators import market
    from sitelens.plans.workspace import Workspace
    from sitelens.sources.extract import extract_network
    from sitelens.sources.stand_in import AS_OF, SPAN, StandIn

    _, snap = extract_network(StandIn(spark, SMALL), ["payer_claims", "payer_members", "ops_facilities"], str(tmp_path / "raw"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # members of any size
    try:
        plan = plan_of(market.care_ledger(Workspace(snap, SPAN, AS_OF).located_year))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    by_member = [e for e in exchanges if re.fullmatch(r"member_id#\d+L?", e)]
    assert len(by_member) == 2 and len(exchanges) == 3  # claims and members, then sums by market
    assert "partial_sum" in plan.split("Exchange hashpartitioning(member_id")[0]


def test_profile_locates_the_claims_once_for_both_market_marts(spark, monkeypatch):
    from sitelens.operators import market
    from sitelens.plans.catalog import all_tables, workspace

    calls, located = [], market.located_claims
    monkeypatch.setattr(market, "located_claims", lambda *a, **k: calls.append(1) or located(*a, **k))
    all_tables(workspace(spark, SMALL))
    assert len(calls) == 1
