"""The crosswalk against a plain statement of its rules, on tables full of collisions."""

import hashlib
import random
from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from oracles.marts import crosswalk
from sitelens.functions.similarity import similarity_of
from sitelens.operators import identity, measure

FIRST = ["Ana", "Anna", "Maria", "Mária", "Jose", "José", "Juan", "Juana", None]
LAST = ["Lopez", "López", "Lopes", "Garcia", "Garcias", "Gracia", " Ruiz"]
SCHEMA = "first_name string, last_name string, dob date, gender string, zip string, address_line1 string"


def people(rng, prefix, n, hot):
    rows = []
    for i in range(n):
        if rng.random() < hot:  # one record that a third of the people share
            row = ("Ana", "Lopez", date(1980, 3, 4), "F", "94000", "1 Oak")
        else:
            row = (
                rng.choice(FIRST),
                rng.choice(LAST),
                date(1980, 3, 1) + timedelta(days=rng.randrange(6)),
                rng.choice(["F", "M", None]),
                rng.choice(["94000", "94001", None]),
                rng.choice(["1 Oak", "2 Elm", None]),
            )
        rows.append((f"{prefix}{i:04d}", *row))
    return rows


@pytest.fixture(scope="module", params=[1])
def both(request):
    rng = random.Random(request.param)
    return people(rng, "P", 220, 0.33), people(rng, "M", 180, 0.33)


def frames(spark, both):
    p, m = both
    return (
        spark.createDataFrame(p, "patient_id string, " + SCHEMA),
        spark.createDataFrame(m, "member_id string, " + SCHEMA),
    )


def similar(a, b):
    return similarity_of(pd.Series([f"{a['fn']} {a['ln']}"]), pd.Series([f"{b['fn']} {b['ln']}"]))[0]


def as_set(df):
    return {
        (r.patient_id, r.member_id, r.match_method, round(r.match_confidence, 9)) for r in df.collect()
    }


def test_matches_the_rules_written_as_sql(spark, duck, both):
    p, m = both
    names = ["first_name", "last_name", "dob", "gender", "zip", "address_line1"]
    duck.register("patients", pd.DataFrame(p, columns=["patient_id", *names]))
    duck.register("members_text", pd.DataFrame(m, columns=["member_id", *names]))
    # the SQL packs gender order and a numeric id into one number
    duck.execute(
        "CREATE VIEW members AS SELECT CAST(substr(member_id, 2) AS BIGINT) AS member_id, "
        "first_name, last_name, CAST(dob AS DATE) AS dob, gender, zip FROM members_text"
    )
    expected = {
        (a, f"M{b:04d}", c, round(d, 9)) for a, b, c, d in duck.execute(crosswalk("patients")).fetchall()
    }
    patients, members = frames(spark, both)
    assert as_set(identity.identity_xwalk(patients, members)) == expected


def best_by_hand(patients, members, allowed, threshold, method):
    """Brute force: best similar member of every patient among allowed pairs."""
    out = []
    for p in patients:
        options = [m for m in members if allowed(p, m)]
        if not options:
            continue
        scores = similarity_of(
            pd.Series([f"{p['fn']} {p['ln']}"] * len(options)), pd.Series([f"{m['fn']} {m['ln']}" for m in options])
        )
        ranked = sorted((-s, m["id"]) for s, m in zip(scores, options) if s >= threshold)
        if ranked:
            out.append((p["id"], ranked[0][1], method, -ranked[0][0]))
    return out


def contest(links):
    best = {}
    for p, m, method, conf in links:
        key = (-conf, method, p)
        if m not in best or key < best[m][0]:
            best[m] = (key, (p, m, method, round(conf, 9)))
    return {v[1] for v in best.values()}


def plain(rows):
    import unicodedata

    def norm(s):
        s = s.strip().lower()
        return "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c))

    return [
        {"id": r[0], "fn": norm(r[1]), "ln": norm(r[2]), "dob": r[3], "gender": r[4], "zip": r[5], "addr": r[6]}
        for r in rows
        if r[1] is not None
    ]


def agree(a, b):
    return a is not None and a == b


def test_address_corroborates_a_similar_name(spark, both):
    patients, members = frames(spark, both)
    links, _ = identity.tiered_links(patients, members, extra=["address_line1"])
    links = links.cache()
    settled = {r.patient_id for r in links.filter("match_method <> 'fuzzy'").collect()}
    p, m = plain(both[0]), plain(both[1])
    # records equal in every used attribute share their links; the smallest id stands for them
    kept, seen = [], set()
    for r in sorted(p, key=lambda r: r["id"]):
        profile = tuple(r[k] for k in ("fn", "ln", "dob", "gender", "zip", "addr"))
        if profile not in seen:
            seen.add(profile)
            kept.append(r)
    same = {(r["fn"], r["ln"], r["dob"], r["gender"], r["zip"]) for r in p if r["id"] in settled}
    open_cases = [r for r in kept if (r["fn"], r["ln"], r["dob"], r["gender"], r["zip"]) not in same]
    expected = best_by_hand(
        open_cases,
        m,
        lambda a, b: a["dob"] == b["dob"]
        and agree(a["gender"], b["gender"])
        and (a["ln"] == b["ln"] or agree(a["zip"], b["zip"]) or agree((a["addr"] or "").lower() or None, (b["addr"] or "").lower() or None)),
        0.92,
        "fuzzy",
    )
    found = as_set(links.filter("match_method = 'fuzzy'"))
    assert found == {(a, b, c, round(d, 9)) for a, b, c, d in expected}


def test_birth_date_variants_link_only_the_free(spark, both):
    patients, members = frames(spark, both)
    base = identity.identity_xwalk(patients, members)
    links, _ = identity.tiered_links(patients, members)
    full = identity.identity_xwalk_with_variants(patients, members, variant_threshold=0.96)
    assert as_set(full.filter("match_method <> 'fuzzy_dob'")) == as_set(base)

    held = {r.member_id for r in base.collect()}
    p, m = plain(both[0]), plain(both[1])
    claimed = {r.patient_id for r in links.collect()}
    profile = lambda r: (r["fn"], r["ln"], r["dob"], r["gender"], r["zip"])
    placed = {profile(r) for r in p if r["id"] in claimed}
    free = {}
    for r in sorted(p, key=lambda r: r["id"]):
        if profile(r) not in placed:
            free.setdefault(profile(r), r)

    def variants(d):
        out = {d + timedelta(days=1), d - timedelta(days=1)}
        if d.day <= 12:
            out.add(date(d.year, d.day, d.month))
        return out - {d}

    expected = best_by_hand(
        list(free.values()),
        [r for r in m if r["id"] not in held],
        lambda a, b: b["dob"] in variants(a["dob"])
        and agree(a["gender"], b["gender"])
        and (a["ln"] == b["ln"] or agree(a["zip"], b["zip"]) or (a["fn"] == b["fn"] and similar(a, b) >= 0.98)),
        0.96,
        "fuzzy_dob",
    )
    assert as_set(full.filter("match_method = 'fuzzy_dob'")) == contest(expected)


def test_one_to_one_drops_the_loser(spark):
    links = spark.createDataFrame(
        [("a", "m1", "fuzzy", 0.95), ("b", "m1", "exact", 1.0), ("c", "m1", "fuzzy", 1.0), ("d", "m2", "fuzzy", 0.93)],
        "patient_id string, member_id string, match_method string, match_confidence double",
    )
    assert {(r.patient_id, r.member_id) for r in identity.one_to_one(links).collect()} == {("b", "m1"), ("d", "m2")}


def test_similarity_is_computed_once_per_pair(spark, both):
    patients, members = frames(spark, both)
    plan = identity.identity_xwalk(patients, members)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_hot_profile_is_one_row_in_every_join(spark, both):
    patients, _ = frames(spark, both)
    collapsed = identity.profiles(patients, "patient_id", (), ())
    assert collapsed.agg(F.sum("copies")).first()[0] == patients.count()
    assert collapsed.agg(F.max("copies")).first()[0] > 50
    assert collapsed.count() == collapsed.select(*identity.PROFILE).distinct().count()


def test_recall_counts_wrong_links(spark, both):
    patients, members = frames(spark, both)
    truth = measure.known_truth(identity.identity_xwalk(patients, members), patients, 50)
    found = {r.corruption: r for r in measure.recall(truth, members).collect()}
    assert set(found) == set(measure.corruptions())
    for row in found.values():
        assert row.matched == row.correct + row.wrong
        assert row.n == truth.count()


def test_stable_sample_is_the_smallest_hashes(spark):
    import hashlib

    df = spark.createDataFrame([(f"k{i}",) for i in range(3000)], "key string")
    found = {r.key for r in measure.stable_sample(df, "key", 700).collect()}
    ordered = sorted((hashlib.md5(f"k{i}".encode()).hexdigest(), f"k{i}") for i in range(3000))
    assert found == {k for _, k in ordered[:700]}
    assert measure.stable_sample(df, "key", 5000).count() == 3000


def test_match_measurement_takes_every_link_by_default(spark):
    patients = spark.range(1200).selectExpr("concat('p', id) AS patient_id", *[f"'x' AS {f}" for f in measure.IDENTITY_FIELDS])
    members = spark.range(900).selectExpr("id AS member_id")
    links = spark.range(800).selectExpr("concat('p', id) AS patient_id", "id AS member_id", "'exact' AS match_method")
    assert measure.known_truth(links, patients).count() == 800 and measure.known_truth(links, patients, 500).count() == 500
    pairs = {(r.patient_id, r.member_id) for r in measure.random_control(patients, members).collect()}
    left, right = ([k for _, k in sorted((hashlib.md5(str(k).encode()).hexdigest(), k) for k in keys)] for keys in ([f"p{i}" for i in range(1200)], range(900)))
    assert pairs == set(zip(left, right))
    assert {(r.patient_id, r.member_id) for r in measure.random_control(patients, members, 500).collect()} == set(zip(left[:500], right[:500]))


def many_names(n, seed):
    rng = random.Random(seed)
    parts = "ma ri an jo se lu is car los el en a pe dro na ta lia fer nan do ga bri mi guel ro sa wil son smi th bro wn".split()
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(1, 5)))
    names = {(word(), word()) for _ in range(n)}
    while len(names) < n:
        first, last = rng.choice(sorted(names)[:500])
        at = rng.randrange(len(first))
        names.add((first[:at] + rng.choice("abcé") + first[at + rng.randrange(2) :], last))
    return sorted(names)


@pytest.mark.parametrize("threshold", [0.85, 0.92, 0.96])
def test_signatures_lose_no_pair_of_a_hot_block(spark, monkeypatch, threshold):
    left, right = many_names(400, 1), many_names(400, 2)
    left += [(f, s + "ez") for f, s in right[:150]] + [("x" * 300, "y" * 40), ("", "")]
    right += [(f[::-1], s) for f, s in left[:100]] + [("x" * 290, "y" * 44), ("", "")]
    born = date(1980, 3, 4)
    schema = "{} string, first_name string, last_name string, dob date, gender string, zip string"
    patients = spark.createDataFrame([(f"P{i:05d}", f, s, born, "F", "94000") for i, (f, s) in enumerate(left)], schema.format("patient_id"))
    members = spark.createDataFrame([(f"M{i:05d}", f, s, born, "F", "94000") for i, (f, s) in enumerate(right)], schema.format("member_id"))
    plain_way = as_set(identity.identity_xwalk(patients, members, threshold))
    monkeypatch.setattr(identity, "HOT_PAIRS", 0)
    assert as_set(identity.identity_xwalk(patients, members, threshold)) == plain_way
    assert {m for _, _, m, _ in plain_way} >= {"fuzzy"}


def test_hot_block_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(identity, "HOT_PAIRS", 0)
    names = many_names(3000, 5)
    born = date(1980, 3, 4)
    sides = []
    for prefix, some in (("P", names[::2]), ("M", names[1::2])):
        rows = [(f"{prefix}{i:05d}", f, s, born, "F", "94000") for i, (f, s) in enumerate(some)]
        sides.append(rows)
    schema = "{} string, fn string, ln string, dob date, gender string, zip string"
    patients, members = (spark.createDataFrame(r, schema.format(k)) for r, k in zip(sides, ("patient_id", "member_id")))
    got = {
        (r.patient_id, r.member_id, round(r.match_confidence, 9))
        for r in identity.similar_pairs(patients, members, 0.92, (), ()).collect()
    }
    dicts = [[{"id": r[0], "fn": r[1], "ln": r[2]} for r in rows] for rows in sides]
    want = {(p, m, round(c, 9)) for p, m, _, c in best_by_hand(*dicts, lambda a, b: True, 0.92, "fuzzy")}
    assert got == want and len(want) > 100


def test_lone_variants_need_more_and_scopes_stay_apart(spark):
    born, other = date(1980, 3, 4), date(1980, 4, 3)
    schema = "{} string, first_name string, last_name string, dob date, gender string, zip string"
    members = spark.createDataFrame(
        [("M1", "Bartholomew", "Featherstonehaugh", other, "M", "1"), ("M2", "Ann", "Lee", other, "F", "1")], schema.format("member_id")
    )
    patients = [
        ("P1", "Bartholomew", "Featherstonehaugh-y", born, "M", "9"),  # surname and zip differ, very similar
        ("P2", "Ann", "Leigh", born, "F", "9"),  # surname and zip differ, similar
        ("P3", "Ann", "Lee", born, "F", "9"),  # the surname corroborates
    ]
    frame = spark.createDataFrame(patients, schema.format("patient_id"))
    got = {(r.patient_id, r.member_id) for r in identity.identity_xwalk_with_variants(frame, members).collect()}
    assert got == {("P1", "M1"), ("P3", "M2")}
    runs = frame.withColumn("run", F.explode(F.array(F.lit("a"), F.lit("b")))).filter("run = 'a' OR patient_id <> 'P3'")
    scoped = identity.identity_xwalk_with_variants(runs, members, scope=["run"]).collect()
    assert {(r["run"], r.patient_id, r.member_id) for r in scoped} == {("a", "P1", "M1"), ("a", "P3", "M2"), ("b", "P1", "M1")}


def test_variant_recall_without_a_certain_link(spark):
    """Where every key is shared there is no known truth: no rows, and no error."""
    day = date(1980, 1, 5)
    record = "first_name string, last_name string, dob date, gender string, zip string"
    members = spark.createDataFrame([(1, "Ana", "Cruz", day, "F", "1"), (2, "Ana", "Cruz", day, "F", "2")], f"member_id long, {record}")
    patients = spark.createDataFrame([("P1", "Ana", "Cruz", day, "F", "1")], f"patient_id string, {record}")
    truth = measure.known_truth(identity.identity_xwalk(patients, members), patients)
    found = measure.recall(truth, members, identity.identity_xwalk_with_variants)
    assert found.columns == ["corruption", "n", "matched", "correct", "recall", "wrong"]
    assert found.collect() == []


@pytest.mark.parametrize("missing", ["exact", "random_control", None])
def test_precision_needs_ceiling_and_floor(spark, missing):
    """Without exact links or random pairs no fuzzy link is measured, as in the SQL; all links are counted."""
    rows = [("exact", 10, 90.0, 90.0, 90.0), ("fuzzy", 4, 80.0, 80.0, 80.0), ("random_control", 20, 10.0, 10.0, 10.0)]
    agreed = spark.createDataFrame([r for r in rows if r[0] != missing], "match_method string, n long, address double, city double, pcp double")
    (row,) = measure.precision(agreed).collect()
    assert row.links == (4 if missing == "exact" else 14)
    assert row.fuzzy_links == (0 if missing else 4)
    assert row.fuzzy_precision_pct == (None if missing else 87.5)
