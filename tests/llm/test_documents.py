"""Document operators against brute force, on odd rows and on random texts full of repeats."""

import hashlib
import random
import re
import textwrap
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

import corpus_pipeline
from sitelens.llm import licenses, near, packing, quality, recompress, segments, shards, suffix
from sitelens.llm import repeats as engine
from sitelens.llm.keys import keyed

OPERATORS = {
    "quality": quality.quality_rules,
    "bytes": suffix.byte_repeats,
    "words": recompress.word_repeats,
    "near": near.near_duplicates,
    "pack": lambda d: packing.packed_documents(d, public_tokenizers.path("word_bpe_49k.json")),
    "pieces": lambda d: segments.best_segmentations(d, public_tokenizers.path("piece_bpe_32k.model")),
    "licenses": licenses.license_scan,
}


def ordered(texts):
    return list(enumerate(texts))


def random_texts(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"{rng.choice('abcdé')}{rng.randrange(40)}" for _ in range(60)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(10, 80))] for _ in range(6)]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(vocabulary) for _ in range(rng.randrange(1, 40))]
            if rng.random() < 0.2:
                words += [rng.choice(vocabulary)] * rng.randrange(1, 40)
        out.append(rng.choice([" ", "  ", "\n"]).join(words))
    return out


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_and_odd_tables(make_docs, odd, name):
    assert OPERATORS[name](make_docs([])).count() == 0
    rows = OPERATORS[name](odd).collect()
    assert len(rows) >= odd.count()


@pytest.mark.parametrize("group_rows", [engine.GROUP_ROWS, 1])
def test_byte_repeats(make_docs, monkeypatch, group_rows):
    monkeypatch.setattr(engine, "GROUP_ROWS", group_rows)
    texts = random_texts(1)
    got = {r.doc_id: r for r in suffix.byte_repeats(make_docs(texts)).collect()}
    seen = set()
    for i, text in ordered(texts):
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - 99):
            if raw[s : s + 100] in seen:
                gone[s : s + 100] = True
            seen.add(raw[s : s + 100])
        left = bytes(np.frombuffer(raw, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        want = (len(raw), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == want
    assert sum(r.n_removed for r in got.values()) > 0


def test_word_repeats(make_docs):
    texts = random_texts(2)
    got = {r.doc_id: r for r in recompress.word_repeats(make_docs(texts)).collect()}
    seen = {}
    for i, text in ordered(texts):
        words = text.split()
        gone = set()
        for s in range(len(words) - 12):
            if seen.setdefault(tuple(words[s : s + 13]), i) < i:
                gone |= set(range(s, s + 13))
        left = " ".join(w for k, w in enumerate(words) if k not in gone)
        assert (got[i].n_words, got[i].n_removed) == (len(words), len(gone))
        assert got[i].kept_sha256 == hashlib.sha256(left.encode()).hexdigest()


def thue_morse(n, letters):
    """Words that polynomial hashes modulo a power of two cannot tell from their complement."""
    return "".join(letters[i.bit_count() % 2] for i in range(n))


def test_words_that_collide_under_polynomials(make_docs):
    a, b = thue_morse(1024, "ab"), thue_morse(1024, "ba")
    tail = " ".join(f"t{i}" for i in range(12))
    docs = make_docs([f"{a} {tail}", f"{b} {tail}", f"{a} x y z", f"{b} x y z"])
    assert [r.n_removed for r in recompress.word_repeats(docs).orderBy("doc_id").collect()] == [0, 0, 0, 0]
    assert [r.kept for r in near.near_duplicates(docs).orderBy("doc_id").collect()] == [True, False, True, True]  # 0 and 1 share 8 of 10
    spoken = make_docs([" ".join(thue_morse(2048, ls)) for ls in ("ab", "ba")] + [a + a, b + b, thue_morse(4096, "cd"), thue_morse(4096, "dc")])
    for operator, pattern, width in ((recompress.word_repeats, "[^ ]+", 13), (suffix.byte_repeats, "(?s).", 100)):
        seen = {}
        got = {r.doc_id: r.n_removed for r in operator(spoken).collect()}
        for row in spoken.orderBy("doc_id").collect():
            parts, gone = re.findall(pattern, row.text), set()
            for i in range(len(parts) - width + 1):
                first = seen.setdefault(tuple(parts[i : i + width]), (row.doc_id, i))
                if first[0] < row.doc_id or width == 100 and first[1] < i:
                    gone |= set(range(i, i + width))
            assert got[row.doc_id] == len(gone)


def test_exact_bags():
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(12))) for _ in range(60)] + ["", " ", "a b", "a b c d", "a b c d e"]
    for width in (1, 2, 3, 5, 6):
        row, count, code = near.exact_bags(pa.array(texts), width)
        names = {}
        for i, text in enumerate(texts):
            w = text.split()
            want = Counter(tuple(w[j : j + width]) for j in range(max(1, len(w) - width + 1))) if w else Counter()
            assert sorted(count[row == i].tolist()) == sorted(want.values())
            here = set(code[row == i].tolist())
            for other, (their_codes, their_bag) in names.items():
                assert len(here & their_codes) == len(set(want) & their_bag)
            names[i] = here, set(want)


def bag(text):
    w = re.findall("[^\x20\x09-\x0d]+", text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def test_near_duplicates(make_docs):
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        base = [f"t{rng.randrange(500)}" for _ in range(rng.randrange(60, 300))]
        for _ in range(rng.randrange(1, 7)):
            copy = base[:]
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    bags = [bag(t) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values()):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    got = near.near_duplicates(make_docs(texts)).collect()
    assert {r.doc_id: r.class_id for r in got} == dict(enumerate(group))
    assert {r.doc_id for r in got if r.kept} == set(group)


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    items = near.mix(np.arange(300).astype(np.uint64)) >> np.uint64(16)
    a, b = rng.integers(1, 9, 300), rng.integers(1, 9, 300)
    s = near.signatures(np.repeat([0, 1], 300), np.tile(items, 2), np.concatenate([a, b]), 2, 4096)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[0] == s[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / 4096)


def test_word_tokenizer_equals_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    own = packing.WordTokenizer(path)
    texts = random_texts(3) + ["it's İstanbul ΣΑΣ don't éa  x\x85y ½ m² 12ab\x1fcd ＡＢ中文 ÀÉ ’“”", "", "\x0b a\tb", "a<|endoftext|>b"]
    for text in texts:
        want = own.whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == want


@pytest.mark.parametrize("histogram", [{}, {1: 100_000}, {2048: 3, 5: 10_000, 700: 33}, {k: k % 7 for k in range(1, 2049)}])
def test_patterns_hold_every_piece_once(histogram):
    found = packing.patterns(histogram)
    held = Counter()
    for n, pattern in found:
        assert n > 0 and sum(k * c for k, c in pattern.items()) <= 2048
        held.update({k: n * c for k, c in pattern.items()})
    assert held == Counter({k: n for k, n in histogram.items() if n})
    if histogram:
        assert sum(n for n, _ in found) <= 1.05 * sum(k * n for k, n in histogram.items()) / 2048 + 2


def test_packing_is_gapless(make_docs):
    texts = random_texts(4, 300)
    rows = OPERATORS["pack"](make_docs(texts)).collect()
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    for held in by_doc.values():
        at = 0
        for start, length, tokens in sorted(held):
            assert start == at
            at += length
        assert at == tokens
    assert len(by_doc) == 300


def test_shards_read_back(make_docs, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = make_docs(random_texts(6, 80) + [None])
    rows = shards.write_shards(docs, path, str(tmp_path / "out"), size=64, per_shard=16).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    records = list(shards.read_slots(str(tmp_path / "out"), 0, len(rows)))
    for r in rows:
        assert shards.checksum(records[r.slot], r.length) == r.ids_crc32
    assert (next(shards.read_slots(str(tmp_path / "out"), 17, 1)) == records[17]).all()
    assert shards.write_shards(make_docs([]), path, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 1025])
def test_permutation(n):
    slots = shards.permuted(np.arange(n), n)
    assert sorted(slots.tolist()) == list(range(n))
    assert n < 1000 or (slots != shards.permuted(np.arange(n), n, key=7)).any()


def test_n_best_segmentations():
    model = segments.Lattice(public_tokenizers.path("piece_bpe_32k.model"))

    def every(text):
        if not text:
            return [(0.0, ())]
        out = []
        for k in range(1, len(text) + 1):
            head = text[:k]
            if head in model.score:
                step = (model.score[head], (model.ids[head],))
            elif k == 1:
                step = (model.unknown, tuple(model.byte[b] for b in head.encode()))
            else:
                continue
            out += [(step[0] + s, step[1] + i) for s, i in every(text[k:])]
        return out

    for text in ("▁thing", "▁ünd中", "▁▁▁a", "xyzzy"):
        want = sorted(every(text), key=lambda x: (-x[0], x[1][::-1]))[:5]
        got = model.segment(text, 5)
        assert [s for s, _ in got] == [s for s, _ in want]
        assert set(got) <= set(every(text)) and len(set(got)) == len(got)
    whole = "the thing und"
    want = sorted((-s for s, _ in every("▁" + whole.replace(" ", "▁"))))[:3]
    assert [-s for s, _ in model.encode(whole, 3)] == want
    for whole in ("it, so.", "a.b, c", "aa aa aa", "中, 中"):
        want = sorted((-s for s, _ in every("▁" + whole.replace(" ", "▁"))))[:4]
        got = model.encode(whole, 4)
        assert [-s for s, _ in got] == pytest.approx(want, abs=1e-9) and len({i for _, i in got}) == len(got)
        assert all(model.decode(i) == whole for _, i in got)
    for unbroken in ("a" * 20_000, "ab中" * 5_000):  # many ties, no border
        got, back = model.choices(unbroken, 3)
        assert back == unbroken and len({b"".join(parts) for _, parts in got}) == 3
        assert got[0][0] >= got[1][0] >= got[2][0]
    for text in ("", "a  b\nc 中 ", "Größe 🙂"):
        assert model.decode(model.encode(text)[0][1]) == text


def test_licences(make_docs):
    notice = "RELEASED   under the MIT Licence!\n(c) 2020 someone"
    rows = {r.doc_id: r for r in licenses.license_scan(make_docs([notice, "x\n" + notice, None, "nothing"])).collect()}
    assert rows[0].license_id == "MIT notice" and rows[1].license_id is None
    assert rows[1].line_licenses == "MIT notice" and rows[2].line_licenses == rows[3].line_licenses == ""


def test_pipeline_stages(spark, make_docs):
    good = [" ".join(f"word{(i * 7919 + k * 104729) % 5000}" for k in range(80)) for i in range(6)]
    shared = " " + " ".join(f"passage{k}" for k in range(40))
    texts = [*good, good[0], "too short", good[1] + shared, good[2] + " other" * 2 + shared]
    docs, seen = make_docs(texts), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        seen.append({r.doc_id: r.text for r in out.collect()})
        docs = out
    assert set(seen[0]) == set(range(10)) - {7}
    assert 6 not in seen[1]
    left = "".join(seen[2].values())
    assert left.count("passage39") == 1 and len(seen[2]) == len(seen[1])
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == len(seen[2])


def test_parity_bitmaps_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    items = near.mix(np.arange(900).astype(np.uint64)) >> np.uint64(16)
    counts = rng.integers(1, 5, (2, 900)) * (rng.random((2, 900)) < 0.8)
    row, col = np.nonzero(counts)
    odd = near.odd_sketches(row, items[col], counts[row, col], 2)
    apart = int(np.bitwise_count(odd[0] ^ odd[1]).sum())
    assert 0 < apart <= np.abs(counts[0] - counts[1]).sum()
    assert (apart - np.abs(counts[0] - counts[1]).sum()) % 2 == 0
    assert not near.odd_sketches(row[:0], items[:0], counts[0][:0], 1).any()


def test_bucket_pairs_hold_every_link_once(spark, make_docs):
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(40):
        own = list(base)
        for i in rng.choice(120, k % 8, replace=False):
            own[i] = f"z{k}x{i}"
        texts.append(" ".join(own))
    sketched = near.sketch(near.keyed(make_docs(texts)))
    live = sketched.selectExpr("_key", "same", "same AS label", "n", "explode(bands) AS bucket")
    pairs = near.bucket_pairs(live, sketched.select("_key", "odd"), 0.8).collect()
    found = {(bytes(p.u), bytes(p.v)) for p in pairs}
    assert len(found) == len(pairs)
    rows = {bytes(r.same): set(zip(*[r.text.split()[j:] for j in range(5)])) for r in near.keyed(make_docs(texts)).join(sketched.select("_key", "same"), "_key").collect()}
    links = {(u, v) for u in rows for v in rows if u < v and len(rows[u] & rows[v]) >= 0.8 * len(rows[u] | rows[v])}
    assert links and links <= found < {(u, v) for u in rows for v in rows if u < v}


def test_whole_licence_files(make_docs):
    texts = {p.name.removesuffix(".txt"): p.read_text(encoding="utf-8") for p in licenses.TEXTS.glob("*.txt")} | dict(licenses.KNOWN[4:])
    head, docs = "Copyright (c) 2019, 2020 Some One <a@b.org>\nAll rights reserved.\n", []
    for name, text in texts.items():
        parts = [p if re.search(r"(?im)^\W*copyright +[\[(0-9]", p) else textwrap.fill(p, 58, break_long_words=False, break_on_hyphens=False) for p in text.split("\n\n")]
        wrapped = "\n\n".join(parts)
        docs += [(name, head + text), (name, f"{licenses.TITLES[name][0]}\n\n{head}\r\n{text}"), (name, f"// {head}" + wrapped.replace("\n", "\n// "))]
    docs += [("MIT", texts["MIT"].replace("sublicense", "sub-\nlicence")), ("Apache-2.0", texts["Apache-2.0"].split("END OF TERMS")[0])]
    docs += [("Apache-2.0", texts["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2021 Some One"))]
    docs += [("BSD-3-Clause", re.sub(r"(?m)^[0-9]\.", "*", texts["BSD-3-Clause"])), (None, texts["MIT"].replace("free of charge", "for a fee"))]
    docs += [(None, texts["BSD-2-Clause"].replace("source and binary forms", "source forms"))]
    got = {r.doc_id: r.license_id for r in licenses.license_scan(make_docs([text for _, text in docs])).collect()}
    assert [(i, name, got[i]) for i, (name, _) in enumerate(docs) if got[i] != name] == []


def test_training_order_ids_are_narrowed_by_the_tokenising_step(spark):
    """One Python step per task: a second one would make further workers hold a tokenizer."""
    docs = spark.createDataFrame([(1, "the cat sat"), (2, None)], "doc_id long, text string")
    wide, small = (packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 2, with_ids=t) for t in ("<u4", "<u2"))
    assert small._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    key = ["doc_id", "start"]
    for a, b in zip(wide.orderBy(*key).collect(), small.orderBy(*key).collect(), strict=True):
        assert np.frombuffer(a.ids, "<u4").tolist() == np.frombuffer(b.ids, "<u2").tolist() and a.ids_crc32 == b.ids_crc32
    with pytest.raises(Exception, match="ids beyond"):
        packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 2, with_ids="<u1").collect()


def test_a_segment_is_searched_once():
    model = segments.Lattice(public_tokenizers.path("piece_bpe_32k.model"))
    met, best = [], model.best
    model.best = lambda text: met.append(text) or best(text)
    first = model.choices("one house, a house. the house, house; one, one,", 3)
    assert len(met) == len(set(met)) and model.choices("one house, a house. the house, house; one, one,", 3) == first


@pytest.mark.parametrize("operator", [recompress.word_repeats, suffix.byte_repeats])
def test_texts_are_exchanged_once_behind_the_anchors(spark, make_docs, tmp_path, operator):
    make_docs([" ".join(f"w{(i * j * 7 + j) % 40}" for j in range(90)) for i in range(300)]).write.parquet(str(tmp_path / "d"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = operator(spark.read.parquet(str(tmp_path / "d")))
        assert len(rows.collect()) == 300
        assert "ReusedExchange" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_texts_are_exchanged_once(spark, make_docs):
    """Both joins with the texts read one exchange, with the other columns carried along or not."""
    docs = make_docs(random_texts(11))
    kept = {x: spark.conf.get(x) for x in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # reuse is then in the plan before it runs
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for operator in (suffix.without_repeats, suffix.byte_repeats, recompress.word_repeats):
            assert "ReusedExchange" in operator(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        for x, value in kept.items():
            spark.conf.set(x, value)


def test_few_word_blocks_share_an_anchor_by_chance(make_docs):
    """Texts of few words without repeats: hardly any block must be fetched and compared."""
    rng = random.Random(12)
    docs = keyed(make_docs([" ".join(f"v{int(rng.random() ** 2 * 60)}" for _ in range(600)) for _ in range(60)]))
    every = engine.block_rows(docs, recompress.METHOD).count()
    fetched = engine.located(docs, recompress.METHOD).filter(f"kind != {engine.REPEAT}").count()
    assert every > 3_000 and fetched < every / 100


class Task:
    """Stands for a DataFrame: ``mapInArrow`` runs in the test's own process, its batches as they are."""

    def __init__(self, *batches):
        self.batches = batches

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        return list(run(iter(self.batches)))


def test_sequences_are_handed_over_in_bounded_batches(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [" ".join(f"word{i % 7}" for i in range(3_000))] * 1500
    docs = Task(pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts}))
    out = packing.pieces(docs, path, 512, with_ids="<u2")
    (whole,) = packing.pieces(docs, path, 512)
    rows = pa.Table.from_batches(out)
    assert rows.select(whole.schema.names).to_pylist() == whole.to_pylist()
    assert len(out) > 1 and all(b.column("ids").nbytes < 17 << 20 for b in out)
    assert [zlib.crc32(np.frombuffer(x, "<u2").astype("<u4")) for x in rows["ids"].to_pylist()] == rows["ids_crc32"].to_pylist()


def test_shards_are_dealt_in_runs_and_each_exchange_is_removed(spark, make_docs, tmp_path, monkeypatch):
    """At a time a quarter of the shards is in an exchange; before the next run its files are gone."""
    path, frame = public_tokenizers.path("word_bpe_49k.json"), type(spark.range(0))
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    deal, dealt, seen = frame.repartitionById, [], []

    def exchanged():
        found = disk.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    def left():
        until = time.monotonic() + 20
        while (more := exchanged() - seen[0]) and time.monotonic() < until:  # removal does not block the write
            time.sleep(0.1)
        return more

    def watched(self, n, column):
        seen.append(exchanged()) if not seen else None
        assert not left()
        dealt.append(n)
        return deal(self, n, column)

    monkeypatch.setattr(frame, "repartitionById", watched)
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(clean, None)
    rows = shards.write_shards(make_docs(random_texts(6, 80)), path, str(tmp_path / "out"), size=64, per_shard=16).collect()
    number = max(r.shard for r in rows) + 1
    assert number > 8 and sum(dealt) == number and max(dealt) <= -(-number // 4)
    assert not left() and spark.conf.get(clean, None) == before
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert all((r.shard, r.byte_offset) == (r.slot // 16, r.slot % 16 * 128) for r in rows)
    records = list(shards.read_slots(str(tmp_path / "out"), 0, len(rows)))
    assert all(shards.checksum(records[r.slot], r.length) == r.ids_crc32 for r in rows)
    dealt.clear(), seen.clear()
    assert shards.write_shards(make_docs(["a b", None]), path, str(tmp_path / "few"), size=64).count() == 2 and dealt == [1]
