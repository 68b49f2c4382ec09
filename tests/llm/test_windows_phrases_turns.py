"""Winnowing, collocations and conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from sitelens.llm import collocations, conversations, winnow

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def benchmark_of(spark, items):
    rows = [(i, t, "x", 1) for i, t in items]
    return spark.createDataFrame(rows, "item_id long, text string, _key string, win long")


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_hits(texts, items):
    out = []
    for text in texts:
        words, hit, met = plain(text), set(), set()
        for item, it in items:
            w = plain(it)
            m = min(10, len(w))
            wins = {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if m else set()
            for i in range(len(words) - m + 1 if m else 0):
                if tuple(words[i : i + m]) in wins:
                    hit |= set(range(i, i + m))
                    met.add("" if item is None else str(item))
        out.append((len(words), len(hit), sorted(met)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_winnowing_finds_every_window(spark, make_docs, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "Ñu", "a1", "x", "über", "w%d" % rng.randrange(40)])
    items = [(k, " ".join(word() for _ in range(rng.choice([10, 11, 25, 40])))) for k in range(12)]
    items += [(12, items[0][1]), (None, "one, two THREE"), (13, ""), (14, None), (100, "ß"), (5, " ".join(word() for _ in range(9)))]
    texts = [None, "", " \n", "x", "the of " * 3000]
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(w) + 1)
            parts += w[a : a + rng.randrange(5, 30)] if rng.random() < 0.7 else [word() for _ in range(rng.randrange(20))]
        texts.append(rng.choice([" ", "--", ". "]).join(parts).upper() if rng.random() < 0.3 else " ".join(parts))
    texts.append(texts[-1])
    rows = winnow.contaminated(make_docs(texts), benchmark_of(spark, items)).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in rows}
    want = dict(enumerate(brute_hits(texts, items)))
    assert got == want and len(rows) == len(texts)
    assert 0 < sum(1 for n, h, _ in want.values() if 0 < h < n)


def test_winnowing_of_odd_tables(spark, make_docs, odd):
    items = benchmark_of(spark, [(1, "x " * 50), (2, "one two three four")])
    assert winnow.contaminated(make_docs([]), items).count() == 0
    assert all(r.n_hit == 0 and r["items"] == [] for r in winnow.contaminated(odd, benchmark_of(spark, [])).collect())
    rows = winnow.contaminated(odd, items).collect()
    assert len(rows) == odd.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append((r.n_words, r.n_hit, r["items"]))
    assert by_id[11] == [(100, 100, ["1"])] and by_id[12] == [(4, 4, ["2"])] and by_id[3] == [(0, 0, [])]
    assert by_id[7] == [(30_000, 0, [])] * 3


def brute_phrases(docs, min_count, percent=100):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang or "und"] += len(w)
            for k in range(1, 6):
                f[lang or "und"].update(w[i : i + k] for i in range(len(w) - k + 1))
    out = {}
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out[lang] = [(i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows))]
    return {x: r for x, r in out.items() if r}


@pytest.mark.parametrize("known_rows", [collocations.KNOWN_ROWS, 6, 0])
def test_collocations(spark, monkeypatch, known_rows):
    monkeypatch.setattr(collocations, "KNOWN_ROWS", known_rows)
    rng = random.Random(7)
    vocabulary = ["the", "Of", "ünd", "a", "new", "york", "x y", "zz"]
    docs = [("en", None), ("en", ""), ("de", "\x0b\t,;"), (None, "the of the of the of a")]
    for _ in range(200):
        text = ""
        for _ in range(rng.randrange(40)):
            text += rng.choice(["New York city", rng.choice(vocabulary), "r%d" % rng.randrange(500)]) + rng.choice([" ", " ", "  ", "\t", ". ", "\n"])
        docs.append((rng.choice(["en", "de", None]), text))
    docs += docs[-3:]
    df = spark.createDataFrame([(k, t, x, "n") for k, (x, t) in enumerate(docs)], "doc_id long, text string, lang string, w1 string")
    got = defaultdict(list)
    for r in collocations.collocations(df, min_count=8).orderBy("lang", "rank").collect():
        got[r.lang].append((r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score))
    want = brute_phrases(docs, 8)
    assert dict(got) == want and any(len(r[1].split()) > 2 for rows in want.values() for r in rows)
    few = collocations.collocations(df, min_count=8, top=3).collect()
    assert len(few) == sum(min(3, len(rows)) for rows in want.values())


def test_collocations_of_odd_tables(odd, make_docs):
    assert collocations.collocations(make_docs([])).count() == 0
    rows = collocations.collocations(odd).collect()
    assert {r.lang for r in rows} == {"und"} and [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    assert ("x x x x x", 292) in {(r.phrase, r.a) for r in rows}


def test_pairs_are_not_counted_again_as_windows():
    """Beside known pairs only windows of three words or more leave a task."""
    words = {"en": pa.array(["a", "b", "c", "d"])}
    known = collocations.Known(words, {"en": np.array([0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 3])})
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 3, "text": ["a b x " * 50, "a b c d. b c", "a"]})
    rows = [r for b in collocations.window_batches(iter([batch]), 5, known) for r in b.to_pylist()]
    got = sorted((tuple(r[f"w{i}"] for i in range(1, 6) if r[f"w{i}"] is not None), r["n"]) for r in rows)
    assert got == [((0, 1, 2, 3), 1), ((1, 2, 3), 1)]


def many_pairs():
    """(lang, text) with more frequent pairs of words than frequent words, and a few longer phrases."""
    rng = random.Random(5)
    docs = []
    for k in range(150):
        words = [rng.choice(["New York city hall", "mill", *"abcdefghijk", f"r{rng.randrange(900)}"]) for _ in range(30)]
        docs.append(("en" if k % 3 else None, " ".join(words) + rng.choice(["", ". a b", "\nc"])))
    return docs + [("de", "x y z " * 20), ("en", None), ("fr", "one two")]


def test_windows_end_at_rare_pairs_and_prefixes_however_many_pairs_there_are(spark, monkeypatch):
    monkeypatch.setattr(collocations, "KNOWN_ROWS", 40)
    monkeypatch.setattr(collocations, "DEALT_WORDS", 700, raising=False)
    windows, seen = collocations._windows, []
    monkeypatch.setattr(collocations, "_windows", lambda *a: seen.append(windows(*a)) or seen[-1])
    docs = many_pairs()
    counts = defaultdict(Counter)
    for lang, text in docs:
        for piece in re.split(r"[.\n]", (text or "").lower()):
            w = piece.split()
            for k in range(1, 6):
                counts[k].update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    often = {k: sum(n >= 8 for n in c.values()) for k, c in counts.items()}
    assert often[1] <= 40 < often[2]
    got = defaultdict(list)
    for r in collocations.collocations(spark.createDataFrame(docs, "lang string, text string"), min_count=8).orderBy("lang", "rank").collect():
        got[r.lang].append((r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score))
    want = brute_phrases(docs, 8)
    assert dict(got) == want and max(len(r[1].split()) for r in want["en"]) > 3
    assert 0 < seen[0].count() <= often[3] + often[4] + often[5]


@pytest.mark.parametrize("held", [1 << 19, 60])
def test_blocks_hold_all_windows_and_are_cut_to_frequent_prefixes(monkeypatch, held):
    monkeypatch.setattr(collocations, "HELD_ROWS", held)
    rng = random.Random(11)
    pieces = [("en" if rng.random() < 0.8 else "de", [rng.randrange(rng.choice([2, 7])) for _ in range(rng.randrange(12))]) for _ in range(2000)]
    words = pa.array(list("abcdefg"))
    known = collocations.Known({"en": words, "de": words}, {x: np.arange(49) for x in ("en", "de")})
    batches = [
        pa.RecordBatch.from_pydict({"lang": [x for x, _ in part], "text": [" ".join("abcdefg"[i] for i in w) for _, w in part]})
        for part in (pieces[:900], pieces[900:])
    ]
    blocks = [r for b in collocations.window_blocks(iter(batches), 5, known, 4) for r in b.to_pylist()]
    assert {b["task"] for b in blocks} == {0, 1, 2, 3}
    got, whole = Counter(), Counter()
    for task in range(4):
        own = sorted((b for b in blocks if b["task"] == task), key=lambda b: b["lang"])
        schema = pa.schema({"task": pa.int32(), "lang": pa.string(), "size": pa.int32(), "block": pa.binary()})
        for b in collocations.frequent_windows(iter(pa.Table.from_pylist(own, schema).to_batches(max_chunksize=3)), 5, 9):
            for r in b.to_pylist():
                window = tuple(r[f"w{i}"] for i in range(1, 6))
                whole[r["lang"], window] += 1
                for k in range(3, 6):
                    if window[k - 1] is not None:
                        got[r["lang"], window[:k]] += r["n"]
    want = Counter((x, tuple(w[i : i + k])) for x, w in pieces for k in range(3, 6) for i in range(len(w) - k + 1))
    assert got == {p: n for p, n in want.items() if n >= 9} and {len(p) for _, p in got} == {3, 4, 5}
    assert set(whole.values()) == {1}


def test_packed_windows_come_back_whole():
    columns = [np.array([0, 0, 7, 999_999], np.int32), np.array([5, 5, 0, 999_999], np.int32), np.array([1, 2, -1, -1], np.int32)]
    n = np.array([1, 2**40 + 3, 2**32 - 1, 2**32])
    back, m = collocations._unpacked(collocations._packed(columns, n), 4, 3)
    assert [c.tolist() for c in back] == [c.tolist() for c in columns] and m.tolist() == n.tolist()


@pytest.mark.parametrize("most", [28, 12])
def test_marks_have_every_pair(spark, monkeypatch, most):
    monkeypatch.setattr(collocations, "MOST_BITS", most)
    monkeypatch.setattr(collocations, "PART_BITS", 9)
    rows = [(x, 1000 * a + b, 9) for x in ("en", "de") for a in range(40) for b in range(a, 40)]
    words = {x: pa.array([str(i) for i in range(1000)]) for x in ("en", "de", "fr")}
    known = collocations.Known(words, collocations._marks(spark.createDataFrame(rows, "lang string, code long, n long")))
    for lang in ("en", "de"):
        left, right = (np.array(x) for x in zip(*(divmod(c, 1000) for own, c, _ in rows if own == lang)))
        assert known.joined(lang, left, right).all()
    others = known.joined("fr", np.repeat(np.arange(200), 200), np.tile(np.arange(200), 200)).mean()
    assert others < (0.08 if most == 28 else 0.4) and len(known.pairs) == (1 << 15 if most == 28 else 1 << 12) >> 3


def test_scores_are_exact_beyond_64_bits(spark):
    words = spark.createDataFrame([("en", "p", 3 * 10**15), ("en", "q", 10**15 + 7), ("en", "z", 10**16)], "lang string, word string, n long")
    phrases = spark.createDataFrame([("en", "p q", 2, 10**15 + 3)], "lang string, phrase string, k int, f long")
    (row,) = collocations.scored(phrases, words).collect()
    n = 3 * 10**15 + 10**15 + 7 + 10**16
    assert row.n == n and row.score == 1000 * (10**15 + 3) * n // (3 * 10**15 * (10**15 + 7))


def every_repair(rows):
    """(cost, audit, repaired) of all edits of up to two inserts per place."""
    puts = ["", "u", "a", "ua", "au"]
    name = {"u": "user", "a": "assistant"}
    best = None
    for between in itertools.product(puts, repeat=len(rows) + 1):
        for edits in itertools.product(["D", "K", "Ru", "Ra"], repeat=len(rows)):
            cost, audit, roles, out = 0, "", "", []
            for k, put in enumerate(between):
                cost, audit, roles = cost + 2 * len(put), audit + "I" * len(put), roles + put
                out += [f"{name[x]}:" for x in put]
                if k < len(rows):
                    role, text, fault = rows[k]
                    edit = edits[k]
                    if edit != "D" and fault in ("blank", "duplicate"):
                        break
                    cost += {"D": 3, "K": 0}.get(edit, 2) + (edit != "D" and fault == "truncated")
                    audit += edit[0]
                    if edit != "D":
                        roles += role[:1] if edit == "K" else edit[1]
                        out.append(f"{role if edit == 'K' else name[edit[1]]}:{text}")
            else:
                if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best[:2]):
                    best = cost, audit, "\n".join(out)
    return best


def with_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\v\f\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "none"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def test_repairs_equal_every_edit(spark):
    rng = random.Random(3)
    table, want = [], {}
    for conv in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b?", "c", " ", "", "d!\n"])) for _ in range(conv % 4)]
        found = with_faults(rows)
        table += [(conv, turn * 3, role, text, "x") for turn, (role, text) in enumerate(rows)]
        want[conv] = (every_repair(found), Counter(x[2] for x in found), rows)
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string, digest string")
    got = {r.conv_id: r for r in conversations.repairs(df).collect()}
    assert set(got) == {c for c in want if want[c][2]}
    for conv, r in got.items():
        (cost, audit, text), faults, rows = want[conv]
        assert (r.cost, r.audit, r.repaired_sha256) == (cost, audit, hashlib.sha256(text.encode()).hexdigest()), rows
        assert (r.blank, r.duplicate, r.truncated) == (faults["blank"], faults["duplicate"], faults["truncated"])
        assert r.illegal == sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        assert r.gaps == (3 * len(rows) - 2) - len(rows)
    said = defaultdict(list)
    for r in conversations.messages(df).orderBy("conv_id", "seq").collect():
        said[r.conv_id].append(f"{r.role}:{r.text}")
    assert all("\n".join(said[c]) == want[c][0][2] for c in got)


def test_long_runs_equal_row_by_row():
    rng = random.Random(4)

    def plain_dp(symbols):
        best = {q: (0, "") if q in (0, 3) else None for q in range(4)}

        def inserted(best):
            for _ in range(2):
                for q in range(4):
                    other = best[conversations._NEXT[q]]
                    if other and (best[q] is None or (2 + other[0], "I" + other[1]) < best[q]):
                        best[q] = 2 + other[0], "I" + other[1]
            return best

        best = inserted(best)
        for s in reversed(symbols):
            best = inserted({q: min((c + best[t][0], e + best[t][1]) for e, c, t in conversations._options(s, q)) for q in range(4)})
        return best[0]

    for _ in range(200):
        runs = [(rng.randrange(12), rng.choice([1, 1, 2, 3, 9, 40])) for _ in range(rng.randrange(1, 7))]
        symbols = [s for s, n in runs for _ in range(n)]
        assert conversations.cheapest(runs) == plain_dp(symbols)
    cost, audit = conversations.cheapest([(3, 100_000), (6, 100_000)])
    assert len(audit) >= 200_000 and cost > 0


def test_repairs_of_odd_tables(spark, monkeypatch):
    schema = "conv_id long, turn long, role string, text string, copies string, first string"
    assert conversations.repairs(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None, None, None), (None, 1, "user", "x."), (1, None, "user", "a."), (1, None, "user", "a."), (1, 5, "assistant", "b."), (1, 5, "user", ""), (2, None, "", "c.")]
    rows += [(3, k, ("user", "assistant")[k % 2], f"turn {k}." if k % 7 else "") for k in range(9000)]
    rows += [(4, 0, "user", "é" * 2_000_000 + "."), (4, 1, "assistant", "ok.")]
    df = spark.createDataFrame([(*r, "c", "f") for r in rows], schema)
    got = {r.conv_id: r for r in conversations.repairs(df).collect()}
    assert set(got) == {None, 1, 2, 3, 4}
    assert (got[None].blank, got[None].gaps, got[None].audit) == (1, 0, "DKI")
    assert (got[1].duplicate, got[1].blank, got[1].gaps, got[1].audit) == (1, 1, 0, "KDKD")
    assert (got[2].cost, got[2].audit) == (3, "D")
    assert got[3].blank == 1286 and got[3].gaps == 0 and got[3].illegal == 0
    assert got[4].repaired_sha256 == hashlib.sha256(f"user:{'é' * 2_000_000}.\nassistant:ok.".encode()).hexdigest()


def test_damage(spark):
    from zlib import crc32

    rows = [(c, t, ("user", "assistant")[(t or 0) % 2], f"say {c} {t}.") for c in range(30) for t in [None, *range(6)]] + [(None, 3, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((str(r.conv_id), str(r.turn), r.role, r.text, r.copies) for r in conversations.damaged(df).filter(F.col("copies") > 0).collect())
    want = []
    for c, t, role, text in rows:
        kind = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        if kind:
            want.append((str(c), str(t), "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text, 2 if kind == 3 else 1))
    assert got == sorted(want) and {r[4] for r in got} == {1, 2}
    done = conversations.repaired(df)
    assert done.count() == 31


def test_windows_of_a_large_batch_take_bounded_memory(monkeypatch):
    rng = np.random.default_rng(3)
    text = " ".join(f"w{i}" for i in rng.integers(0, 2000, 1_200_000).tolist())
    third = len(text) // 3
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3), pa.array([text[:third], text[third : 2 * third], text[2 * third :]])], ["lang", "text"])
    known = collocations.Known({"en": pa.array([f"w{i}" for i in range(2000)])})
    tracemalloc.start()
    seen = 0
    for out in collocations.window_batches(iter([batch]), 5, known):
        assert out.num_rows <= 1 << 16 and out.schema.field("w1").type == pa.int32()
        seen += pc.sum(out.column("n")).as_py()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen > 1_199_000 and peak < 90 << 20
