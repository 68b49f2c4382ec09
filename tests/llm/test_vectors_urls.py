"""Vector tiles and URL templates against brute force."""

import math

import numpy as np

from sitelens.llm import urls, vectors


def test_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 8))
    rows = [(i, (base[i % 12] * rng.uniform(0.5, 2) + rng.normal(size=8) * rng.choice([0, 0.05, 0.2])).tolist()) for i in range(150)]
    rows += [(150, None), (151, [0.0] * 8), (152, [1.0, None] + [0.0] * 6), (153, [float("nan")] * 8), (154, []), (155, rows[0][1])]
    rows += [(156, [1.0, 0.0]), (157, [2.0, 0.0]), (None, rows[1][1]), (158, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "2 AS label")
    for tile in (2048, 16):
        got = {r.vec_id: r for r in vectors.near_vectors(df, tile=tile).collect()}
        good = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
        links = {k: [] for k in range(len(good))}
        for a, (_, u) in enumerate(good):
            for b, (_, v) in enumerate(good):
                if a != b and len(u) == len(v) and np.dot(u, v) / (math.sqrt(np.dot(u, u)) * math.sqrt(np.dot(v, v))) >= 0.95:
                    links[a].append(b)
        for a, (i, _) in enumerate(good):
            reach, todo = {a}, [a]
            while todo:
                todo = [y for x in todo for y in links[x] if y not in reach]
                reach |= set(todo)
            assert got[i].n_links == len(links[a])
            assert got[i].component_id == min(good[x][0] for x in reach if good[x][0] is not None)
        assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (150, 151, 152, 153, 154, 158))
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_rules_and_parts(spark):
    pages = [
        (0, "http://www.Example.com/en/5?x", "www.example.com", "/en/5", "www.example.com/en/", "allow"),
        (1, "https://a.example.com/en/5#y", "a.example.com", "/en/5", "example.com/en/", "block"),
        (2, "https://a.example.com", "a.example.com", "", None, "allow"),
        (3, "https://b.net/es/", "b.net", "/es/", "net/es/", "block"),
        (4, "https://bnet/es/", "bnet", "/es/", None, "allow"),
        (5, None, "", "", None, "allow"),
        (6, "no scheme/en/", "", "", None, "allow"),
        (None, "x://COM/", "com", "/", "com/", "allow"),
    ]
    df = spark.createDataFrame([(p[0], p[1], "h") for p in pages], "page_id long, url string, host string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in urls.url_filter(df, none).collect()}
    for page_id, _, host, path, rule, verdict in pages:
        r = got[page_id]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)
    assert urls.url_filter(df.limit(0), none).count() == 0


def test_bad_templates_are_blocked(spark):
    rows = [(i, f"http://h.org/{'bad' if i % 2 else 'fine'}/{i}", None) for i in range(400)] + [(400, "http://h.org/bad/999999", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(0, 400)], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.verdict, r.template) for r in urls.url_filter(pages, labels).collect()}
    assert got[400] == ("block", "/bad/*") and got[0] == ("allow", "/fine/*")


def test_templates_reach_the_whole_path(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, f"http://d.org/a/b/c/{'spam' if i % 2 else 'news'}/{i}") for i in range(200)]
    rows += [(1000 + i, f"http://d.org/w/x/y/z/{letters[i % 26]}{letters[i // 26]}/end") for i in range(60)]
    rows += [(2000, "http://d.org/" + "/".join(["deep"] * 300 + ["7x", "end"]))]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.verdict, r.template) for r in urls.url_filter(pages, labels).collect()}
    assert got[0] == ("allow", "/a/b/c/news/*") and got[1] == ("block", "/a/b/c/spam/*")
    assert {got[1000 + i][1] for i in range(60)} == {"/w/x/y/z/*/end"}
    assert got[2000][1] == "/" + "deep/" * 300 + "*/end"


def test_similar_sections_are_merged_over_all_levels(spark):
    names = ["sa", "sb", "sc", "sd", "se", "sf", "sg", "sh"]
    rows = [(3 * k + i, f"http://few.org/{name}/{3 * k + i}") for k, name in enumerate(names) for i in range(3)]
    deep = [(100 + 3 * k + i, f"http://deep.org/x/{name}/y/{100 + 3 * k + i}") for k, name in enumerate(names) for i in range(3)]
    good = [(1000 + i, f"http://fine.org/ok/{1000 + i}") for i in range(144)]
    mixed = [(2000 + i, f"http://mixed.org/{'bad' if i < 40 else 'good'}/a/{2000 + i}") for i in range(80)] + [(3000, "http://mixed.org/good/b/3000")]
    pages = spark.createDataFrame([*rows, *deep, *good, *mixed], "page_id long, url string")
    marks = [(i, 1, int(i < 200)) for i, _ in [*rows, *deep, *good]] + [(2000 + i, 1, int(i < 40)) for i in range(80)] + [(3000, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in urls.url_filter(pages, labels).collect()}
    assert {got[i] for i, _ in rows} == {got[i] for i, _ in deep} == {"block"}
    assert {got[i] for i, _ in good} == {"allow"} and got[2000] == "block" and got[2079] == got[3000] == "allow"


def test_merged_counts_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = {}
    for _ in range(120):
        host, depth = f"h{rng.integers(3)}", int(rng.integers(0, 6))
        path = tuple(str(rng.choice(list("abc"))) for _ in range(depth))
        n = int(rng.integers(0, 12))
        rows[host, path] = (n, int(rng.binomial(n, rng.choice([0.0, 0.3, 1.0]))))
    want = {}
    for host in {h for h, _ in rows}:
        tree = {p: c for (h, p), c in rows.items() if h == host}
        nodes = {p[:k] for p in tree for k in range(len(p) + 1)}
        groups = {}
        for node in sorted(nodes, key=len, reverse=True):
            units = [groups[kid] for kid in sorted(nodes) if len(kid) == len(node) + 1 and kid[: len(node)] == node and kid in groups]
            units += [(*tree[node], [node])] if node in tree else []
            all_l, all_b = sum(u[0] for u in units), sum(u[1] for u in units)
            fits = []
            for unit in units:
                p = all_b / all_l if all_l else 0
                if not unit[0] or abs(unit[1] / unit[0] - p) <= 1.96 * math.sqrt(p * (1 - p) / unit[0]):
                    fits.append(unit)
                else:
                    want |= {(host, x): unit[:2] for x in unit[2]}
            if fits:
                groups[node] = (sum(u[0] for u in fits), sum(u[1] for u in fits), [x for u in fits for x in u[2]])
        if () in groups:
            want |= {(host, x): groups[()][:2] for x in groups[()][2]}
    df = spark.createDataFrame([(h, "/" + "/".join(p), *c) for (h, p), c in rows.items()], "host string, template string, labelled long, bad long")
    got = {(r.host, tuple(x for x in r.template.split("/") if x)): (r.l, r.b) for r in urls.merged_counts(df).collect()}
    assert got == want
