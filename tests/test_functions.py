import random
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sitelens.functions import cover, geo, scale, similarity, temporal, text
from sitelens.functions.temporal import Span
from sitelens.operators import people


def _pairs(rng, n, alphabet):
    def word():
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))

    out = []
    for _ in range(n):
        a = word()
        b = list(a)
        for _ in range(rng.randint(0, 4)):  # near copies reach the high end of the scale
            if b and rng.random() < 0.5:
                i = rng.randrange(len(b))
                b[i] = rng.choice(alphabet)
            elif len(b) > 1:
                i = rng.randrange(len(b) - 1)
                b[i], b[i + 1] = b[i + 1], b[i]
        out.append((a, "".join(b) if rng.random() < 0.7 else word()))
    return out


@pytest.mark.parametrize("alphabet", ["abcde", "abcdefghijklmnopqrstuvwxyz ", "aéñoü日"])
def test_similarity_agrees_with_the_oracle_engine(duck, alphabet):
    pairs = pd.DataFrame(_pairs(random.Random(7), 20_000, alphabet), columns=["a", "b"])
    duck.register("pairs", pairs)
    expected = duck.execute("SELECT jaro_winkler_similarity(a, b) FROM pairs").fetchnumpy()
    found = similarity.similarity_of(pairs["a"], pairs["b"]).to_numpy(dtype=float)
    assert np.abs(found - next(iter(expected.values()))).max() < 1e-12


def test_similarity_known_values_and_nulls():
    left = pd.Series(["martha", "abcxyz", "", None, "x"])
    right = pd.Series(["marhta", "abcqrstuvw", "", "a", None])
    found = similarity.similarity_of(left, right)
    assert found[0] == pytest.approx(0.9611111111)
    assert found[1] == pytest.approx(0.6)
    assert found[2] == 0.0
    assert found[3] is None or np.isnan(found[3])
    assert found[4] is None or np.isnan(found[4])


@pytest.mark.parametrize("threshold", [0.92, 0.8])
def test_prefilter_never_drops_a_passing_pair(spark, threshold):
    pairs = _pairs(random.Random(3), 15_000, "abcdefgh ") + _pairs(random.Random(4), 5_000, "aéñoü")
    df = spark.createDataFrame(pairs, "a string, b string").withColumn(
        "s", similarity.jaro_winkler(F.col("a"), F.col("b"))
    )
    kept = similarity.can_reach(F.col("a"), F.col("b"), threshold)
    row = df.agg(
        F.count_if((F.col("s") >= threshold) & ~kept).alias("lost"),
        F.count_if(~kept).alias("dropped"),
    ).first()
    assert row["lost"] == 0
    assert row["dropped"] > 3_000


def test_accents(spark, duck):
    words = ["José", "ÁÉÍÓÚ", "straße", "Łódź", "ø", "Ångström", "é", "日本", "Ǖ", "ệ", ""]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    found = [r[0] for r in df.select(text.strip_accents(F.col("w"))).collect()]
    expected = [duck.execute("SELECT strip_accents(?)", [w]).fetchone()[0] for w in words]
    assert found == expected


def test_minutes_count_boundaries(spark):
    t = datetime
    rows = [
        (t(2024, 1, 1, 10, 0, 59), t(2024, 1, 1, 10, 1, 0)),
        (t(2024, 1, 1, 23, 59, 30), t(2024, 1, 2, 0, 0, 10)),
        (t(2024, 1, 1, 10, 0, 0), t(2024, 1, 1, 10, 0, 59)),
        (t(2024, 1, 2, 0, 0, 0), t(2024, 1, 1, 0, 0, 1)),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    found = [r[0] for r in df.select(temporal.minutes_between(F.col("a"), F.col("b"))).collect()]
    assert found == [1, 1, 0, -1440]


def test_active_needs_both_ends(spark):
    d = date
    rows = [
        (d(2020, 1, 1), None, True),
        (d(2030, 1, 1), None, False),
        (d(2020, 1, 1), d(2021, 1, 1), False),
        (d(2020, 1, 1), d(2024, 6, 2), True),
        (d(2020, 1, 1), d(2024, 6, 1), False),
        (d(2024, 6, 1), None, True),
        (None, None, False),
    ]
    df = spark.createDataFrame(rows, "s date, e date, want boolean")
    bad = df.filter(temporal.active_on(F.col("s"), F.col("e"), d(2024, 6, 1)) != F.col("want"))
    assert bad.count() == 0


def test_polygon_test(spark):
    # an L-shaped ring
    wkt = "POLYGON ((0 0, 4 0, 4 1, 1 1, 1 4, 0 4, 0 0))"
    pts = [(0.5, 0.5, True), (3.0, 0.5, True), (0.5, 3.0, True), (3.0, 3.0, False), (-1.0, 0.5, False)]
    df = spark.createDataFrame(pts, "x double, y double, want boolean")
    inside = geo.inside_ring(F.col("x"), F.col("y"), geo.ring_points(F.lit(wkt)))
    assert df.filter(inside != F.col("want")).count() == 0


def test_distance(spark):
    row = spark.range(1).select(
        geo.distance_miles(F.lit(0.0), F.lit(-45.0), F.lit(0.0), F.lit(45.0)).alias("quarter"),
        geo.distance_miles(F.lit(-90.0), F.lit(0.0), F.lit(90.0), F.lit(0.0)).alias("half"),
        geo.distance_miles(F.lit(10.0), F.lit(20.0), F.lit(10.0), F.lit(20.0)).alias("zero"),
    ).first()
    assert row["quarter"] == pytest.approx(3959 * np.pi / 2)
    assert row["half"] == pytest.approx(3959 * np.pi)
    assert row["zero"] == 0.0


@pytest.mark.parametrize("ordered", [scale.FEW_VALUES, 50, 1])
def test_exact_quantiles_on_skewed_groups(spark, ordered):
    rng = np.random.default_rng(1)
    hot = [("hot", float(v), 1) for v in rng.exponential(20, 6000)]
    tied = [("tied", 5.0, 3)] * 500 + [("tied", 7.5, 1)] * 499
    rest = [(f"g{i % 40}", float(v), 2) for i, v in enumerate(rng.normal(0, 50, 2000))]
    few = [("one", 3.25, 1), ("two", 1.0, 1), ("two", 2.0, 1), ("void", None, 4), (None, 9.0, 1), ("some", None, 1), ("some", 4.0, 1)]
    df = spark.createDataFrame(hot + tied + rest + few, "g string, v double, w int")
    probs = {"p10": 0.1, "p50": 0.5, "p90": 0.9}
    found = {
        r["g"]: r for r in scale.exact_quantiles(df, ["g"], "v", probs, weight="w", rows="n", few=ordered).collect()
    }
    pdf = df.toPandas()
    groups = pdf["g"].where(pdf["g"].notna(), None)
    assert set(found) == set(groups.unique())
    for g in found:
        part = pdf[groups.isna() if g is None else groups == g]
        assert found[g]["n"] == part["w"].sum()
        values = np.repeat(part["v"].dropna(), part["w"][part["v"].notna()])
        for name, p in probs.items():
            if len(values):
                assert found[g][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)
            else:
                assert found[g][name] is None


def test_quantiles_of_one_hot_bin(spark):
    """Nearly all values crowd in a sliver of the range; bins are split until they are small."""
    crowd = spark.range(400_000).selectExpr("'g' AS g", "1D + id / 1e12D AS v")
    far = spark.createDataFrame([("g", -1e300), ("g", 1e300), ("g", float("nan")), ("g", 1e9)], "g string, v double")
    got = scale.exact_quantiles(crowd.union(far), ["g"], "v", {"p25": 0.25, "p50": 0.5, "top": 1.0}, rows="n", few=2_000).first()
    values = np.sort(np.concatenate([1 + np.arange(400_000) / 1e12, [-1e300, 1e300, 1e9]]))
    assert (got["n"], got["top"]) == (400_004, 1e300)
    assert got["p25"] == pytest.approx(np.quantile(values, 0.25), rel=1e-15) and got["p50"] == pytest.approx(np.quantile(values, 0.5), rel=1e-15)


def test_broadcast_only_within_the_bound(spark):
    df = spark.range(100)
    assert "ResolvedHint" in scale.broadcast_within(df, 100)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in scale.broadcast_within(df, 99)._jdf.queryExecution().analyzed().toString()


def test_staged_tables_live_in_the_shared_folder(spark):
    df = scale.staged(spark.range(10))
    shared = spark.conf.get("spark.checkpoint.dir")
    assert all(f.replace("file://", "").startswith(shared) for f in df.inputFiles())
    assert df.count() == 10


def test_similarity_costs_a_row_its_own_length():
    import time

    from sitelens.functions import similarity

    rng = np.random.default_rng(3)
    pairs = [[bytes(rng.integers(97, 101, rng.integers(1, 400)).astype(np.uint8)) for _ in range(2)] for _ in range(300)]
    whole = similarity._block_similarity(*map(list, zip(*pairs)))
    assert np.allclose([similarity._long_similarity(a, b) for a, b in pairs], whole, atol=1e-12)
    assert np.allclose(similarity._similarities(*map(list, zip(*pairs))), whole, atol=1e-12)
    left = pd.Series(["martha"] * 4095 + ["x" * 100_000])
    start = time.monotonic()
    got = similarity.similarity_of(left, pd.Series(["marhta"] * 4095 + ["x" * 99_000]))
    assert time.monotonic() - start < 10 and abs(got[0] - 0.961111) < 1e-5 and got[4095] > 0.99


def test_drive_time_access_takes_every_ring(spark):
    polygons = [
        ("multi", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 5, 9 5, 9 9, 5 9, 5 5), (6 6, 8 6, 8 8, 6 8, 6 6)))"),
        ("hole", "POLYGON ((5 5, 9 5, 9 9, 5 9, 5 5), (6 6, 8 6, 8 8, 6 8, 6 6))"),
        ("nobody", "POLYGON ((20 20, 21 20, 21 21, 20 21, 20 20))"),
        ("empty", "MULTIPOLYGON EMPTY"),
        ("null", None),
        (None, "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"),
    ]
    isochrones = spark.createDataFrame([(f, 15, w) for f, w in polygons], "facility_id string, isochrone_minutes long, polygon_wkt string")
    members = spark.createDataFrame([(0.5, 0.5), (0.5, 0.5), (5.5, 5.5), (7.0, 7.0), (3.0, 3.0)], "longitude double, latitude double")
    got = {r.facility_id: r.members_within for r in people.drive_time_access(members, isochrones).collect()}
    assert got == {"multi": 3, "hole": 1, "nobody": 0, "empty": 0, "null": 0, None: 2}


def star(rng, n, x, y, size):
    """A ragged ring around (x, y)."""
    turn = np.sort(rng.uniform(0, 2 * np.pi, n))
    far = size * rng.uniform(0.3, 1, n)
    ring = np.stack([x + far * np.cos(turn), y + far * np.sin(turn)], axis=1)
    return np.concatenate([ring, ring[:1]])


def inside_by_hand(points, rings):
    odd = np.zeros(len(points), bool)
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if ay != by:
                at = (bx - ax) * (points[:, 1] - ay) / (by - ay) + ax
                odd ^= ((ay > points[:, 1]) != (by > points[:, 1])) & (points[:, 0] < at)
    return odd


def text_of(rings):
    return "MULTIPOLYGON ((" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in r.tolist()) + ")" for r in rings) + "))"


def test_polygon_covers_equal_the_plain_test(spark):
    rng = np.random.default_rng(4)
    shapes = {
        "ragged": [star(rng, 3000, -120, 37, 3)],
        "holes": [star(rng, 200, 10, 10, 9), star(rng, 100, 10, 10, 2), star(rng, 50, 40, -5, 1)],
        "on the grid": [np.array([[0, 0], [16, 0], [16, 16], [8, 16], [8, 8], [0, 8], [0, 0]], float)],
        "sliver": [np.array([[-20, -20.001], [30, 20], [30, 20.001], [-20, -20.001]], float)],
    }
    points = [rng.uniform(-30, 45, (3000, 2)), np.stack([rng.uniform(-124, -116, 3000), rng.uniform(33, 41, 3000)], axis=1)]
    points += [rng.uniform(0, 20, (2000, 2)), np.array([[x, y] for x in range(-1, 18) for y in range(-1, 18)], float)]
    points = np.concatenate(points)
    members = spark.createDataFrame(points.tolist() + [[None, 1.0]], "longitude double, latitude double")
    isochrones = spark.createDataFrame([(k, 15, text_of(r)) for k, r in shapes.items()], "facility_id string, isochrone_minutes long, polygon_wkt string")
    got = {r.facility_id: r.members_within for r in people.drive_time_access(members, isochrones).collect()}
    want = {k: int(inside_by_hand(points, r).sum()) for k, r in shapes.items()}
    assert got == want and all(want.values())


def test_large_polygon_has_small_cells():
    rng = np.random.default_rng(5)
    turn = np.linspace(0, 2 * np.pi, 100_001)[:-1]
    far = 9 + 2 * np.sin(5 * turn) + 0.3 * np.sin(71 * turn) + rng.uniform(0, 0.002, len(turn))
    ring = np.stack([-100 + far * np.cos(turn), 40 + far * np.sin(turn)], axis=1)
    ring = np.concatenate([ring, ring[:1]])
    cells = list(cover.cells_of([ring]))
    assert len(cells) > 10_000
    held = np.array([len(own) + len(turns) for *_, own, _, turns in cells])
    assert held.max() <= cover.LEAF_EDGES and held.sum() < 4 * len(ring)
    assert any(level < 6 and not len(own) and not len(turns) for level, _, _, own, base, turns in cells)


@pytest.mark.parametrize("span", [Span(date(2000, 6, 10), date(2001, 6, 1)), Span(date(1994, 1, 1), date(2001, 3, 15))])
def test_member_months_by_bits(spark, span):
    """One row per member before months are counted, however many rows and months (over 64) there are."""
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        lo = date(1993, 1, 1) + timedelta(days=rng.randrange(3400))
        hi = None if rng.random() < 0.2 else lo + timedelta(days=rng.randrange(-40, 900))
        rows.append((rng.choice([None, *range(60)]), lo, hi))
    rows.append((None, date(1990, 1, 1), date(1996, 1, 31)))
    want = {}
    for member, lo, hi in rows:
        lo, hi = max(lo, span.lo) if hi is None or hi >= lo else None, min(hi or date(2030, 1, 1), span.hi - timedelta(days=1))
        for day in range((hi - lo).days + 1 if lo else 0):
            month = (lo + timedelta(days=day)).replace(day=1)
            want.setdefault(month, set()).add(member)
    covered = people.member_months(spark.createDataFrame(rows, "member_id long, effective_date date, end_date date"), span)
    assert {r.month: r.members_covered for r in covered.collect()} == {m: len(who - {None}) for m, who in want.items()}
    assert "Generate explode" not in covered._jdf.queryExecution().toString()


def test_equal_polygons_are_covered_once_and_cells_fit_the_polygon(spark):
    square = "POLYGON ((1 1, 2 1, 2 2, 1 2, 1 1))"
    isochrones = spark.createDataFrame([(k, 15, square) for k in range(40)], "facility_id long, isochrone_minutes long, polygon_wkt string")
    members = spark.createDataFrame([(1.5, 1.5), (1.5, 1.5), (9.0, 9.0)], "longitude double, latitude double")
    got = {r.facility_id: r.members_within for r in people.drive_time_access(members, isochrones).collect()}
    assert got == {k: 2 for k in range(40)}
    assert all(cover.TOP_DEGREES / 2**level <= 0.5 for level, *_ in cover.cells_of(cover.rings_of(square)))
