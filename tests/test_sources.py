from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sitelens.functions.temporal import Span
from sitelens.plans import publish
from sitelens.plans.catalog import workspace
from sitelens.plans.workspace import Workspace
from sitelens.operators import quality
from sitelens.sources import extract, footers
from sitelens.sources.network import SCHEMAS, ParquetNetwork
from sitelens.sources.stand_in import AS_OF, SPAN, StandIn
from sitelens.streaming import landing
from paths import SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_schemas_parse(spark):
    assert len(SCHEMAS) == 23
    for ddl in SCHEMAS.values():
        assert spark.createDataFrame([], ddl).schema


def test_another_type_fails_instead_of_being_cast(spark, tmp_path):
    spark.createDataFrame([("x",)], "employer_id string").withColumn("employer_name", F.lit(1.5)).write.parquet(
        str(tmp_path / "payer_employers.parquet")
    )
    net = ParquetNetwork(spark, str(tmp_path))
    with pytest.raises(Exception):
        net.table("payer_employers").collect()


def test_extract_snapshot_and_window_pushdown(spark, tmp_path):
    root = str(tmp_path / "raw")
    rows, snap = extract.extract_network(StandIn(spark, SMALL), ["payer_claims", "ops_facilities", "payer_members"], root)
    assert rows["payer_claims"] == 6000
    again, _ = extract.extract_network(StandIn(spark, SMALL), ["payer_claims"], root)
    assert again == {"payer_claims": None}
    year = snap.within("payer_claims", SPAN)
    plan = plan_of(year.select("member_id", "service_date"))
    assert "GreaterThanOrEqual(service_date,2000-06-01)" in plan
    assert "LessThan(service_date,2001-06-01)" in plan
    read = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert read == "member_id:bigint,service_date:date"
    assert year.count() == StandIn(spark, SMALL).within("payer_claims", SPAN).count()


def test_views_follow_source_names(spark, tmp_path):
    spark.createDataFrame([("e1",)], "employer_id string").write.parquet(str(tmp_path / "payer_employers.parquet"))
    ParquetNetwork(spark, str(tmp_path)).register_views(["payer_employers"])
    assert spark.sql("SELECT count(*) FROM raw_payer_employers").first()[0] == 1
    assert extract.local_name("payer.member_eligibility_history") == "payer_member_eligibility_history"
    assert extract.source_name("payer_member_eligibility_history") == "payer.member_eligibility_history"


def test_snapshot_tables(spark):
    extract.save_snapshot(spark.range(3), "ops_rooms")
    assert spark.table("ops.rooms").count() == 3


def test_publish_swaps_versions(spark, tmp_path):
    root, some = str(tmp_path / "marts"), ["facility_metrics", "build_metadata"]
    first = publish.publish(workspace(spark, SMALL), root, "0001", datetime(2024, 1, 1), some)
    assert first == {"facility_metrics": 10, "build_metadata": 7}
    held = publish.open_marts(spark, root)
    publish.build_marts(workspace(spark, SMALL), root, "0002", some)
    assert set(publish.current_versions(spark, root).values()) == {"0001"}  # built aside, not yet visible
    publish.publish(workspace(spark, SMALL), root, "0003", datetime(2024, 1, 2), some)
    assert set(publish.current_versions(spark, root).values()) == {"0003"}
    assert held["facility_metrics"].count() == 10  # an open reader is not disturbed
    assert set(publish.open_marts(spark, root, views=True)) == set(some)
    assert spark.sql("SELECT count(*) FROM marts_facility_metrics").first()[0] == 10

    exported = publish.export_portable(spark, held, str(tmp_path / "out"))
    assert 0 < exported < publish.PORTABLE_LIMIT_BYTES
    with pytest.raises(publish.OversizeError):
        publish.export_portable(spark, held, str(tmp_path / "out2"), limit_bytes=10)
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("out")] == ["out"]  # never visible, not even in part
    with pytest.raises(publish.OversizeError):
        publish.export_portable(spark, held, str(tmp_path / "out"), limit_bytes=10)
    assert spark.read.parquet(str(tmp_path / "out" / "facility_metrics")).count() == 10


def test_publishing_some_marts_leaves_the_others(spark, tmp_path):
    root = str(tmp_path / "marts")
    assert publish.current_versions(spark, root) == {} == publish.open_marts(spark, root)
    publish.publish(workspace(spark, SMALL), root, "0001", datetime(2024, 1, 1), ["facility_metrics", "market_flows"])
    seen = publish.current_versions(spark, root)
    publish.publish(workspace(spark, SMALL), root, "0002", datetime(2024, 1, 2), ["market_flows"], expected=seen)
    assert publish.current_versions(spark, root) == {"facility_metrics": "0001", "market_flows": "0002"}
    assert list(publish.open_marts(spark, root)) == ["facility_metrics", "market_flows"]
    with pytest.raises(publish.Superseded):
        publish.publish(workspace(spark, SMALL), root, "0003", datetime(2024, 1, 3), ["market_flows"], expected=seen)
    assert publish.current_versions(spark, root)["market_flows"] == "0002"
    assert publish.remove_unlisted(spark, root) == ["v=0001/market_flows", "v=0003/market_flows"]
    assert all(df.count() for df in publish.open_marts(spark, root).values())


def test_export_refuses_personal_columns(spark, tmp_path):
    leaky = spark.createDataFrame(
        [("x", "y", "z", "n")], "first_name string, Email string, address_line1 string, facility_name string"
    )
    assert {c for _, c in publish.personal_columns({"leaky": leaky})} == {"first_name", "Email", "address_line1"}
    with pytest.raises(publish.PersonalDataError):
        publish.export_portable(spark, {"leaky": leaky}, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_bounded_pages(spark):
    page = publish.bounded(spark.range(501), 500)
    assert len(page.rows) == 500 and page.truncated
    assert not publish.bounded(spark.range(500), 500).truncated
    shown = publish.as_text(publish.Page(spark.createDataFrame([("a" * 130, None)], "x string, y string").collect(), True), ["x", "y"])
    assert "…" in shown and "truncated at 1 rows" in shown


def numbers_on_disk(spark, tmp_path):
    spark.range(7).write.parquet(str(tmp_path / "numbers"))
    return str(tmp_path / "numbers")


def test_describe_list_and_statements(spark, tmp_path):
    spark.range(5).createOrReplaceTempView("raw_numbers")
    listed = publish.list_tables(spark, "raw_", {"raw_numbers": numbers_on_disk(spark, tmp_path)}).collect()
    assert ("raw_numbers", 7) in [(r.name, r.n_rows) for r in listed]
    columns, page = publish.describe(spark.table("raw_numbers"))
    assert columns == [("id", "bigint")] and len(page.rows) == 3
    for statement in ("DESCRIBE raw_numbers", "SHOW TABLES", "EXPLAIN SELECT * FROM raw_numbers"):
        assert publish.bounded(spark.sql(statement)).rows
    assert spark.table("raw_numbers").summary("min", "max").count() == 2
    assert extract.with_provenance(spark.range(1)).first().provenance == "source"


def test_landing_date_keeps_late_claims(spark):
    df = spark.createDataFrame(
        [("old service, late landing", date(2024, 1, 1), date(2024, 6, 1)), ("seen", date(2024, 4, 1), date(2024, 4, 20))],
        "label string, service_date date, processed_date date",
    )
    late = extract.landed_since(df, "processed_date", date(2024, 5, 1)).collect()
    assert [r.label for r in late] == ["old service, late landing"]
    assert extract.landed_since(df, "processed_date", None).count() == 2


CLAIM = "claim_id int, member_id int, service_date date, processed_date date, allowed_amount double"


def test_stream_picks_up_only_new_files(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("landing", "claims", "mark"))
    spark.createDataFrame([(1, 1, date(2024, 1, 5), date(2024, 2, 1), 10.0)], CLAIM).write.parquet(src)
    landing.append_landed(spark, src, out, mark, CLAIM).awaitTermination()
    late = [(2, 1, date(2024, 1, 9), date(2024, 5, 1), 20.0), (1, 1, date(2024, 1, 5), date(2024, 5, 2), 12.0)]
    spark.createDataFrame(late, CLAIM).write.mode("append").parquet(src)
    landing.append_landed(spark, src, out, mark, CLAIM).awaitTermination()
    landing.append_landed(spark, src, out, mark, CLAIM).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 3
    latest = landing.latest_versions(got, "claim_id", "processed_date")
    assert {(r.claim_id, r.allowed_amount) for r in latest.collect()} == {(1, 12.0), (2, 20.0)}


def test_restatement_leaves_old_months_alone(spark, tmp_path):
    target = str(tmp_path / "claims")
    rows = [(i, i, date(2024, 1, 1) + timedelta(days=10 * i), date(2024, 12, 1), 1.0) for i in range(20)]
    first = spark.createDataFrame(rows, CLAIM)
    landing.restate(first, target, date(2024, 7, 31), days=400)
    restated = first.withColumn("allowed_amount", F.lit(5.0))
    landing.restate(restated, target, date(2024, 7, 31), days=100)
    since = landing.restated_span(date(2024, 7, 31), 100)
    assert since == date(2024, 4, 1)
    got = spark.read.parquet(target)
    assert got.count() == 20
    wrong = got.filter((F.col("allowed_amount") == 5.0) != (F.col("service_date") >= F.lit(since)))
    assert wrong.count() == 0


def test_landing_loses_nothing_on_the_watermark_day(spark):
    rows = [(1, 1, None, date(2024, 5, 1), 1.0), (2, 1, None, None, 1.0), (3, 1, None, date(2024, 4, 30), 1.0)]
    df = spark.createDataFrame(rows, CLAIM)
    delta = extract.landed_since(df, "processed_date", date(2024, 5, 1))
    assert {r.claim_id for r in delta.collect()} == {1, 2}
    left = extract.not_yet_seen(delta, df.filter("claim_id = 2"), "claim_id")
    assert left.columns == df.columns and [r.claim_id for r in left.collect()] == [1]


def test_latest_version_without_landing_dates(spark):
    rows = [(1, 1, None, None, 1.0), (2, 1, None, None, 1.0), (2, 1, None, date(2024, 1, 1), 2.0)]
    rows += [(3, 1, None, date(2024, 1, 1), 3.0), (3, 2, None, date(2024, 1, 1), 4.0)]
    df = spark.createDataFrame(rows, CLAIM)
    got = [landing.latest_versions(x, "claim_id", "processed_date", ["member_id"]) for x in (df, df.repartition(5))]
    assert all({(r.claim_id, r.allowed_amount) for r in x.collect()} == {(1, 1.0), (2, 2.0), (3, 4.0)} for x in got)


def test_restatement_of_old_and_emptied_months(spark, tmp_path):
    target = str(tmp_path / "claims")
    jan, apr, jun = date(2023, 1, 9), date(2024, 4, 9), date(2024, 6, 9)
    day = date(2024, 7, 1)
    rows = [(1, 1, jan, day, 1.0), (2, 1, date(2023, 2, 9), day, 1.0), (3, 1, apr, day, 1.0), (4, 1, jun, day, 1.0), (5, 1, None, day, 1.0)]
    landing.restate(spark.createDataFrame(rows, CLAIM), target, date(2024, 7, 31), days=900, touched=[None])
    moved = [(1, 1, date(2023, 3, 9), date(2024, 7, 9), 9.0), (3, 1, jun, date(2024, 7, 9), 9.0), (5, 1, jun, date(2024, 7, 9), 9.0)]
    versions = spark.createDataFrame(rows + moved, CLAIM)
    months = landing.touched_months(versions, "claim_id", "processed_date", date(2024, 7, 2)).collect()
    latest = landing.latest_versions(versions, "claim_id", "processed_date")
    landing.restate(latest, target, date(2024, 7, 31), touched=[r.service_month for r in months])
    got = spark.read.parquet(target)
    want = [(1, date(2023, 3, 9), 9.0), (2, date(2023, 2, 9), 1.0), (3, jun, 9.0), (4, jun, 1.0), (5, jun, 9.0)]
    assert sorted((r.claim_id, r.service_date, r.allowed_amount) for r in got.collect()) == want


def test_extract_replaces_what_a_failed_write_left(spark, tmp_path):
    (tmp_path / "t.parquet").mkdir()
    assert extract.extract(spark.range(7), str(tmp_path / "t.parquet")) == 7
    assert extract.extract(spark.range(9), str(tmp_path / "t.parquet")) is None


def test_marts_run_from_an_extracted_snapshot(spark, tmp_path):
    _, snap = extract.extract_network(StandIn(spark, SMALL), StandIn.NAMES, str(tmp_path / "raw"))
    from_files = Workspace(snap, SPAN, AS_OF).market_summary.collect()
    derived = workspace(spark, SMALL).market_summary.collect()
    assert sorted(map(str, from_files)) == sorted(map(str, derived))


def test_period_outside_the_data_is_flagged(spark, small):
    from sitelens.plans.utilization import period_coverage

    rows = period_coverage(
        [("appointments", small.table("ops_appointments"), "scheduled_dt_local", "timestamp_ntz")],
        Span(date(2010, 1, 1), date(2011, 1, 1)),
    ).collect()
    assert (rows[0].coverage, rows[0].rows_in_period) == ("outside window", None)


def test_profiles_from_the_write_and_from_footers(spark, tmp_path):
    root = str(tmp_path / "raw")
    names = ["payer_members", "ops_appointments", "ehr_procedures"]
    _, snap = extract.extract_network(StandIn(spark, SMALL), names, root)
    want = sorted(map(tuple, quality.profile({n: snap.table(n) for n in names}).collect()))
    cols = [c.split()[0] for c in quality.PROFILE.split(", ")]
    assert sorted(map(tuple, extract.extracted_profile(spark, root).select(cols).collect())) == want
    paths = {n: f"{root}/{n}.parquet" for n in names}
    assert sorted(map(tuple, footers.footer_profile(spark, paths).collect())) == want
    assert footers.row_counts(spark, paths) == {n: snap.table(n).count() for n in names}
    with footers.footer_reader(spark):
        assert "PushedAggregation: [COUNT(*)]" in plan_of(footers.counted(spark, paths["ops_appointments"]))
    assert "BatchScan" not in plan_of(spark.read.parquet(paths["ops_appointments"]))  # settings are back


def claims_of(spark, rows):
    return spark.createDataFrame([(*r[:1], 1, *r[1:]) for r in rows], CLAIM)


def published(spark, root):
    df = landing.open_restated(spark, root, spark.createDataFrame([], CLAIM).schema)
    return sorted((r.claim_id, str(r.service_month), r.allowed_amount) for r in df.collect())


def test_restated_batches_are_published_all_or_none(spark, tmp_path, monkeypatch):
    root, day = str(tmp_path / "claims"), date(2024, 7, 1)
    first = [(1, date(2024, 1, 9), day, 1.0), (2, date(2024, 2, 9), day, 2.0), (3, date(2024, 2, 10), day, 3.0), (4, None, day, 4.0)]
    args = (root, "mark", "claim_id", "processed_date")
    landing.restate_batch(claims_of(spark, first), 0, *args)
    before = published(spark, root)
    assert before == [(1, "2024-01-01", 1.0), (2, "2024-02-01", 2.0), (3, "2024-02-01", 3.0), (4, "None", 4.0)]
    later = date(2024, 7, 9)
    # 1 moves and empties January, 2 is corrected, 4 gets a date and empties the undated month, 5 is new
    second = [(1, date(2024, 3, 9), later, 9.0), (2, date(2024, 2, 9), later, 8.0), (4, date(2024, 3, 1), later, 7.0), (5, date(2023, 5, 5), later, 6.0)]
    second += [(3, date(2024, 6, 6), date(2024, 6, 1), 0.0)]  # landed before what is published: changes nothing

    def dies(*_):
        raise OSError("lost")

    commit = landing.commit_manifest
    monkeypatch.setattr(landing, "commit_manifest", dies)
    with pytest.raises(OSError):
        landing.restate_batch(claims_of(spark, second), 1, *args)
    assert published(spark, root) == before  # months were written, none is visible
    monkeypatch.setattr(landing, "commit_manifest", commit)
    touched = landing.restate_batch(claims_of(spark, second), 1, *args)
    after = [(1, "2024-03-01", 9.0), (2, "2024-02-01", 8.0), (3, "2024-02-01", 3.0), (4, "2024-03-01", 7.0), (5, "2023-05-01", 6.0)]
    assert published(spark, root) == after
    assert set(touched) == {None, *(date(y, m, 1) for y, m in [(2023, 5), (2024, 1), (2024, 2), (2024, 3), (2024, 6)])}
    assert landing.restate_batch(claims_of(spark, second), 1, *args) == []  # delivered again
    assert published(spark, root) == after and landing.read_manifest(spark, root).version == 2
    stale = landing.read_manifest(spark, root)
    with pytest.raises(landing.Superseded):
        landing.commit_manifest(spark, root, stale)
    only = landing.open_restated(spark, root, spark.createDataFrame([], CLAIM).schema, [date(2024, 3, 1)])
    assert sorted(r.claim_id for r in only.collect()) == [1, 4]


def test_stream_of_restatements(spark, tmp_path):
    src, root, mark = (str(tmp_path / n) for n in ("landing", "claims", "mark"))
    args = (spark, src, root, mark, CLAIM, "claim_id", "processed_date")
    claims_of(spark, [(1, date(2024, 1, 9), date(2024, 2, 1), 1.0), (2, date(2024, 1, 9), date(2024, 2, 1), 1.0)]).write.parquet(src)
    landing.stream_restatements(*args).awaitTermination()
    claims_of(spark, [(2, date(2024, 4, 9), date(2024, 5, 1), 5.0)]).write.mode("append").parquet(src)
    landing.stream_restatements(*args).awaitTermination()
    landing.stream_restatements(*args).awaitTermination()
    assert published(spark, root) == [(1, "2024-01-01", 1.0), (2, "2024-04-01", 5.0)]
    assert landing.read_manifest(spark, root).batches == {mark: 1}


def test_known_split_points_read_the_source_once(spark, tmp_path):
    claims = StandIn(spark, SMALL).table("payer_claims")
    low, high = claims.agg(F.min("service_date"), F.max("service_date")).first()
    points = extract.split_points(low, high, 5)
    assert len(points) == 4 and low < points[0] and points[-1] < high
    ordered = extract.in_splits(claims, "service_date", points, spread=2)
    assert "rangepartitioning" not in plan_of(ordered)
    assert extract.extract(claims, str(tmp_path / "claims"), "service_date", points=points) == 6000
    got = spark.read.parquet(str(tmp_path / "claims")).withColumn("_file", F.input_file_name())
    spans = sorted((r.a, r.b) for r in got.groupBy("_file").agg(F.min("service_date").alias("a"), F.max("service_date").alias("b")).collect())
    assert len(spans) == 5 and all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))
    assert extract.split_points(low, low, 3) == []


def test_killed_extract_resumes_with_the_open_splits(spark, tmp_path):
    rows = [(i, i, date(2024, 1, 1) + timedelta(days=i) if i % 7 else None, None, 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, CLAIM)
    points = extract.split_points(date(2024, 1, 1), date(2024, 4, 9), 3)
    root = str(tmp_path / "claims")
    failing = df.withColumn("member_id", F.when(F.col("service_date") >= F.lit(points[1]), F.raise_error("lost").cast("int")).otherwise(F.col("member_id")))
    with pytest.raises(Exception, match="lost"):
        extract.extract_in_splits(failing, root, "service_date", points)
    with pytest.raises(FileNotFoundError):
        extract.open_splits(spark, root, df.schema, 3)
    again = extract.extract_in_splits(df, root, "service_date", points)
    assert again[:2] == [None, None] and again[2] > 0  # finished splits are not read again
    whole = extract.open_splits(spark, root, df.schema, 3)
    assert sorted(map(str, whole.collect())) == sorted(map(str, df.collect()))
