"""Negative controls: every guard must be seen to fire."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sitelens.operators import freshness, market, quality, screening


def test_an_orphan_and_a_null_are_counted(spark):
    tables = {
        "a": spark.createDataFrame([(1,), (1,), (9,), (None,)], "k int"),
        "b": spark.createDataFrame([(1,), (2,)], "k int"),
    }
    row = quality.join_path_report([quality.JoinPath("a", "k", "b", "k", 25.0)], tables).first()
    assert (row.n_rows, row.n_null, row.orphans, row.null_rate_ok) == (4, 1, 1, True)
    strict = quality.join_path_report([quality.JoinPath("a", "k", "b", "k")], tables).first()
    assert strict.null_rate_ok is False


def test_join_path_on_empty_table(spark):
    tables = {"a": spark.createDataFrame([], "k int"), "b": spark.createDataFrame([], "k int")}
    row = quality.join_path_report([quality.JoinPath("a", "k", "b", "k")], tables).first()
    assert (row.n_rows, row.n_null, row.orphans, row.null_rate_ok) == (0, 0, 0, True)


def test_a_duplicated_member_fails_the_invariants(spark):
    xwalk = spark.createDataFrame(
        [("p1", "m1", "exact", 1.0), ("p2", "m1", "fuzzy", 0.90), ("p3", "m3", "guess", 1.0)],
        "patient_id string, member_id string, match_method string, match_confidence double",
    )
    patients = spark.createDataFrame([(f"p{i}",) for i in range(1, 5)], "patient_id string")
    found = {r["check"]: r["value"] for r in quality.crosswalk_invariants(xwalk, patients, 0.92).collect()}
    assert found["members_linked_twice"] == 1
    assert found["patients_linked_twice"] == 0
    assert found["coverage_pct"] == 75.0
    assert found["fuzzy_links_below_threshold"] == 1
    assert found["links_of_unknown_method"] == 1


def test_grain_counts_null_keys_as_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "k string, l string")
    row = quality.grain("t", df, ["k", "l"]).first()
    assert (row.n_rows, row.distinct_keys, row.null_keys, row.unique) == (3, 2, 2, False)


def test_reconciliation_reports_a_gap(spark):
    mart = spark.createDataFrame([(10,), (5,)], "v int")
    raw = spark.range(14)
    row = quality.reconcile([("n", mart, F.sum("v"), raw, F.count("*"))]).first()
    assert (row.mart_value, row.source_value, row.ok) == (15.0, 14.0, False)


def test_band_without_value_fails(spark):
    empty = spark.createDataFrame([], "v double")
    row = quality.band_checks([quality.Band("b", empty, F.avg("v"), 0, 1)]).first()
    assert row.value is None and row.ok is False


def test_drift_names_added_removed_and_changed(spark):
    old = quality.profile({"t": spark.createDataFrame([(1, 2)], "a int, b int")})
    new = quality.profile({"t": spark.createDataFrame([(1, 2), (None, 2)], "a int, c int")})
    assert {(r.column_name, r.drift) for r in quality.profile_drift(old, new).collect()} == {
        ("a", "changed"), ("b", "removed"), ("c", "added"),
    }
    assert quality.profile_drift(old, old).count() == 0


def test_staleness_alert_fires_after_the_limit(spark):
    src = freshness.Source("t", spark.createDataFrame([(date(2024, 1, 1),)], "d date"), "d", "d")
    at = datetime(2024, 1, 3, 2)
    meta = freshness.build_metadata([src], at)
    assert meta.first().days_behind_today == 2
    assert freshness.stale_builds(meta, at + timedelta(hours=26)).count() == 0
    assert freshness.stale_builds(meta, at + timedelta(hours=27)).count() == 1


def test_claims_of_unknown_members_stay_in_the_paid_share_only(spark):
    """An orphan claim is no market's, yet it is owned care that was paid."""
    members = spark.createDataFrame([(1, "A", "S", 1.0, 1.0)], "member_id int, city string, state string, latitude double, longitude double")
    sites = spark.createDataFrame(
        [(1, "A", "owned", "clinic", 1.0, 1.0), (2, "B", "partner", "clinic", 1.5, 1.0)],
        "facility_id int, city string, ownership string, facility_type string, latitude double, longitude double",
    )
    rows = [
        (1, 1, "er", "owned", 100.0, 40.0),
        (7, 1, "er", "owned", 100.0, 60.0),
        (1, 2, "er", "out_of_network", 100.0, 80.0),
        (1, 2, "labs", "out_of_network", 100.0, 80.0),
    ]
    claims = spark.createDataFrame(
        rows, "member_id int, facility_id int, service_line string, network_status string, allowed_amount double, plan_paid double"
    ).withColumn("service_date", F.lit(date(2024, 1, 1)))
    from sitelens.functions.temporal import Span

    flows = market.market_flows(sites, members, claims, Span(date(2024, 1, 1), date(2025, 1, 1))).collect()
    assert {(r.care_city, r.service_line) for r in flows} == {("A", "er"), ("B", "er")}  # labs: no owned claim
    away = next(r for r in flows if r.care_city == "B")
    assert away.if_owned_plan_paid_musd == round(100 * 0.5 / 1e6, 4)
    spend = market.market_spend(
        market.located_claims(claims, members, sites, Span(date(2024, 1, 1), date(2025, 1, 1)))
    ).collect()
    assert [(r.city, r.claims, r.acute_claims) for r in spend] == [("A", 3, 2)]


def test_classifier_counts_whole_texts(spark):
    text = "Alder first. " + "filler " * 400 + "Birch Birch beats Alder by distance"
    df = spark.createDataFrame([(1, text), (2, "nothing here")], "id int, text string")
    rows = {r.id: r for r in screening.classify(df, ["Alder", "Birch"], {"access": ["distance"]}).collect()}
    assert rows[1].recommendation == "Alder"  # two each: the earlier wins
    assert rows[1].access and not rows[2].access
    assert rows[2].recommendation is None
    head = screening.classify(df, ["Alder", "Birch"], {}, head_chars=20).filter("id = 1").first()
    assert head.recommendation == "Alder"


def test_destaining_removes_headed_blocks_only(spark):
    text = "intro Alder\n**C1. about Alder\nmore\n**C2. clean\nline"
    df = spark.createDataFrame([(text,)], "text string")
    row = screening.without_named_blocks(df, ["Alder"], r"\n(?=\*\*C[0-9]+\. )", r"\*\*C").first()
    assert row.cleaned == "intro Alder\n**C2. clean\nline"
    assert (row.n_blocks, row.removed_blocks, row.residual_lines) == (3, 1, 1)


@pytest.mark.parametrize("phrase,passed", [("BAD thing", False), ("good", True)])
def test_screen_ignores_case(spark, phrase, passed):
    df = spark.createDataFrame([(f"a {phrase} b",)], "text string")
    assert screening.banned_phrases(df, ["bad THING"]).first().passed is passed


def test_bands_fail_when_a_mart_is_wrong(spark, small):
    from sitelens.plans.catalog import bands_of

    small.settle("facility_metrics", "market_summary")
    metrics, summary = small.facility_metrics, small.market_summary

    def outside(m, s):
        return {r.check for r in quality.band_checks(bands_of(m, s)).filter("NOT ok").collect()}

    known = outside(metrics, summary)  # the smallest stand-in has ten sites: markets differ more than they should
    assert known == {"owned_share_spread_pp"}
    shifted = metrics.withColumn("bed_occupancy_pct", F.col("bed_occupancy_pct") + 2).withColumn("pct_no_show", F.col("pct_no_show") * 1.1)
    assert outside(shifted, summary) - known == {"bed_occupancy_mean", "no_show_mean"}
    relabelled = metrics.withColumn("ownership", F.lit("owned"))
    assert outside(relabelled, summary) - known == {"owned_clinic_share_pct"}
    wrong = summary.withColumn("pct_allowed_owned", F.lit(50.0)).withColumn("median_miles_to_acute", F.col("median_miles_to_acute") * 1.6)
    wrong = wrong.withColumn("recapture_plan_paid_musd", F.when(F.col("city") == "NATION_3", 3.0).otherwise(F.col("recapture_plan_paid_musd")))
    assert outside(metrics, wrong) == {"owned_share_mean", "farthest_market_miles", "recaptured_share", "corridor_recapture_pct"}


def test_residual_mentions_in_full(spark):
    from sitelens.operators import screening

    text = "Intro names Rome\nA. Rome is first\nmore of it\nB. nothing\n  Paris stays \nA. fine"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string")
    rows = screening.residual_mentions(docs, ["Rome", "Paris"], r"\n(?=[A-Z]\. )", "[A-Z]\\. ").collect()
    assert sorted(map(tuple, rows)) == [
        (1, "removed_block", 2, "A. Rome is first"),
        (1, "removed_block", 3, "B. nothing"),
        (1, "residual_line", 1, "Intro names Rome"),
    ]


def test_null_rates_group_no_keys(spark):
    left = spark.createDataFrame([("1",), ("2",), (None,), (None,)], "k string")
    right = spark.createDataFrame([("1",)], "k string")
    paths = [quality.JoinPath("left", "k", "right", "k", 50.0), quality.JoinPath("none", "k", "right", "k")]
    rates = quality.null_rates(paths, {"left": left, "right": right, "none": left.limit(0)})
    assert [(r.n_rows, r.n_null, r.null_pct, r.null_rate_ok) for r in rates.orderBy("referencing").collect()] == [(4, 2, 50.0, True), (0, 0, 0.0, True)]
    assert rates.columns == [c for c in quality.join_path_report(paths, {"left": left, "right": right, "none": left}).columns if c != "orphans"]
    assert "key#" not in rates._jdf.queryExecution().optimizedPlan().toString()
