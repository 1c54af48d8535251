"""Rules, classifier, join, packing, sharding and the pipeline, against brute force on small tables."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quotegrid.llm import common, jaccard_join, packing, quality_classifier, quality_rules, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Clean and junk texts, near copies, exact copies, empty, NULL and very long ones; one hot source."""
    rng, rows = random.Random(3), []

    def add(text, lang="en", source=None):
        rows.append((len(rows), text, lang, source if source is not None else rng.choice(["s0", "s0", "s1", "s2"]), len(text or ""), False, 0.5))

    for _ in range(260):
        add(words(rng, rng.randint(12, 120)))
    for base in list(rows[:8]):  # chains of near copies, and exact ones
        text = base[1].split()
        for _ in range(5):
            text[rng.randrange(len(text))] = words(rng, 1)
            add(" ".join(text))
        add(base[1].upper())
        add(base[1])
    for _ in range(40):
        add(" ".join(f"{w.upper()}!!" for w in words(rng, 40).split()))
    for _ in range(20):
        add("spam again and more of it " * 9)
    for text in (None, "", "  \n\t", "one", "one", "two words", words(rng, 9000)):
        add(text, None, "s9")
    rows.append(rows[5])
    return rows


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


def tokens(text):
    return (text or "").encode().split()


def test_base_rules_equal_brute_force(docs, corpus):
    got = quality_rules.quality_report(docs).collect()
    assert len(got) == len(corpus)
    text = {r[0]: r[1] or "" for r in corpus}
    for r in got:
        t = text[r["doc_id"]]
        w = tokens(t)
        windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        repeat = len({i + j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(5)})
        seen, dup = set(), 0
        for line in t.split("\n"):
            if line.encode().split():
                dup += line in seen
                seen.add(line)
        failed = len(w) < 10 or 100 * repeat > 20 * len(w)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (
            len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), dup, repeat, failed)
        assert not (failed and r["kept"])
    junk = {r[0] for r in corpus if r[1] and "!!" in r[1]}
    assert not any(r["kept"] for r in got if r["doc_id"] in junk)
    clean = [r["kept"] for r in got if r["doc_id"] < 260 and not r["base_failed"]]
    assert np.mean(clean) > 0.98
    assert quality_rules.quality_report(docs.limit(0)).count() == 0
    assert quality_rules.keep_good(docs).columns == docs.columns


def test_estimates_follow_the_bulk(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0.3, 0.1, (3000, quality_rules.DIMENSIONS))
    x[:600] += 3.0  # a fifth lies elsewhere
    df = spark.createDataFrame([("en", "s", [float(v) for v in r]) for r in x], "lang string, source string, x array<double>")
    for r in quality_rules.estimates(df).collect():
        assert np.allclose(r["center"], 0.3, atol=0.05) and r["n"] == 3000


def test_classifier_learns_and_holds_out(spark, docs, corpus):
    labels = spark.createDataFrame(
        [(r[0], int("!!" not in (r[1] or "")), 0) for r in corpus[:350]] + [(10_000, 1, 0), (None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_classifier.score_report(docs, labels).collect()
    assert len(got) == len(corpus) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    text = {r[0]: r[1] or "" for r in corpus}
    held = [r["predicted"] == ("!!" not in text[r["doc_id"]]) for r in got if r["held_out"] and 10 < len(text[r["doc_id"]])]
    assert np.mean(held) > 0.95
    none = quality_classifier.score_report(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality_classifier.score_report(docs.limit(0), labels).count() == 0


def test_dual_descent_satisfies_its_optimum():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 50, 8)) for _ in range(120)]
    values = [np.ones(len(r)) / np.sqrt(len(r)) for r in rows]
    y = np.array([1.0 if 3 in r or 7 in r else -1.0 for r in rows])
    w, b = quality_classifier.dual_descent(rows, values, y, np.full(len(y), 1.0), 300)

    def primal(w, b):
        return 0.5 * (w @ w + b * b) + sum(max(0.0, 1 - t * (w[r] @ v + b)) for r, v, t in zip(rows, values, y, strict=True))

    best = primal(w, b)
    for _ in range(50):
        assert primal(w + rng.normal(0, 0.01, len(w)), b + rng.normal(0, 0.01)) >= best - 1e-6


def brute_components(corpus, k, p, q):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for r in corpus:
        w = tokens((r[1] or "").translate(low))
        sets[r[0]] = {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and q * both >= p * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("k, p", [(3, 90), (5, 80)])
def test_join_equals_all_pairs(docs, corpus, k, p):
    got = jaccard_join.components(docs, k, p, 100).collect()
    want = brute_components(corpus, k, p, 100)
    assert len(got) == len(corpus)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_one_of_each_group_stays(spark, docs, corpus):
    kept = jaccard_join.keep_one(docs).collect()
    want = brute_components(corpus, 5, 80, 100)
    assert sorted(r["doc_id"] for r in kept) == sorted({c for _, c in want.values()})
    assert {tuple(r) for r in kept} <= set(corpus)
    assert jaccard_join.keep_one(docs.limit(0)).count() == 0
    lone = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (4, None)], "doc_id long, text string")
    assert jaccard_join.keep_one(lone).count() == 2


@pytest.mark.parametrize("p", [80, 90])
def test_linked_sets_share_a_leaf_and_survive_the_bound(p):
    rng, of = np.random.default_rng(p), jaccard_join.bands(p, 100)
    for n in [1, 2, 5, 9, 10, 11, 19, 20, 47, 100, 333, 1000, 5000]:
        for _ in range(20):
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            cut = int(rng.integers(0, max(1, n // 4) + 1))
            b = np.unique(np.concatenate([a[cut:], rng.integers(0, 1 << 63, int(rng.integers(0, cut + 1))).astype(np.uint64)]))
            a = np.unique(a)
            both = len(np.intersect1d(a, b))
            if len(b) and 100 * both >= p * (len(a) + len(b) - both) and both < max(len(a), len(b)):
                assert set(jaccard_join.leaves(a, of)) & set(jaccard_join.leaves(b, of))
                points = np.stack([np.frombuffer(jaccard_join.point(x), dtype="<i4") for x in (a, b)])
                x, _ = jaccard_join.surviving(points, np.array([len(a), len(b)]), np.array([0, 1]), np.array([0, 0], dtype=np.int8), p, 100)
                assert len(x) == 1


def test_large_leaves_are_cut_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK_POINTS", 3)
    rng = random.Random(1)
    base = words(rng, 60).split()
    rows = [(i, " ".join(base[:50] + words(rng, 10).split())) for i in range(25)] + [(100 + i, " ".join([*base[:59], words(rng, 1)])) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.components(df, 3, 80, 100).collect()}
    assert got == brute_components(rows, 3, 80, 100)


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7), (200, 100), (-5, 300)]
    got = {r["node"]: r["label"] for r in common.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 41)} == {1} and got[101] == got[200] == 100 and got[300] == -5
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def check_bins(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["bin_id"]].append(r)
    for content in bins.values():
        spans = sorted((r["bin_offset"], r["length"]) for r in content)
        assert sum(n for _, n in spans) <= capacity
        assert all(a + n <= b for (a, n), (b, _) in zip(spans, spans[1:]))
        for c in ("source", "cluster"):
            values = [r[c] for r in content if r[c] is not None]
            assert len(values) == len(set(values))
    return bins


def test_packing_is_whole_and_free_of_conflicts(docs, corpus):
    rows = packing.pack(docs, capacity=300, group_docs=100).collect()
    check_bins(rows, 300)
    pieces = Counter()
    for r in rows:
        pieces[r["doc_id"]] += r["length"]
    copies = Counter(r[0] for r in corpus)
    assert pieces == Counter({r[0]: len(r[1] or "") * copies[r[0]] for r in corpus})
    assert packing.pack(docs.limit(0)).count() == 0


def test_tightest_compatible_bin():
    rng = random.Random(2)
    items = sorted(((rng.randint(1, 60), rng.randint(-1, 3), rng.randint(-1, 5)) for _ in range(400)), key=lambda x: -x[0])
    got = packing.best_fit(items, 100)
    room, held = [], []
    for (n, s, c), (found, offset) in zip(items, got, strict=True):
        fits = [(room[b], b) for b in range(len(room)) if room[b] >= n and ("s", s) not in held[b] and ("c", c) not in held[b]]
        if not fits:
            assert found == len(room) and offset == 0
            room.append(100)
            held.append(set())
        else:
            assert found == min(fits)[1] and offset == 100 - room[found]
        room[found] -= n
        held[found] |= {("s", s)} if s >= 0 else set()
        held[found] |= {("c", c)} if c >= 0 else set()


def test_sharding(spark, docs, corpus):
    rows = sharding.shard(docs, shards=7, slots=512).collect()
    assert len(rows) == len(corpus)
    text = {r[0]: r[1] for r in corpus}
    load, places = Counter(), defaultdict(list)
    for r in rows:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        load[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and set(places) <= set(range(7))
    big = max(r["size"] for r in rows)  # one text is larger than a fair share
    assert max(v for s, v in load.items() if big > v or s != load.most_common(1)[0][0]) - min(load.values()) <= 0.1 * np.mean(list(load.values())) + 200
    assert sharding.shard(docs.limit(0)).count() == 0


def test_the_map_is_edited_not_made_anew(spark, tmp_path):
    rng = np.random.default_rng(4)
    weight = rng.integers(900, 1100, 4096)
    at = np.arange(4096) % 40
    grown = sharding.edited(at, weight, 41)
    moved = grown != at
    assert moved.mean() < 0.04 and (grown == 40).mean() > 0.02  # the new shard takes its share, few slots are exchanged besides
    load = np.bincount(grown, weight, minlength=41)
    assert load.max() - load.min() < 0.01 * load.mean()
    shrunk = sharding.edited(at, weight, 39)
    assert shrunk.max() == 38 and (shrunk != at).mean() < 0.06
    table = sharding.SlotMap(spark, str(tmp_path / "map"), 64)
    new = table.rebalance(table.create(4), spark.createDataFrame([(i, 1 + 5 * (i % 4)) for i in range(64)], "slot int, bytes long"), 5)
    assert new == 1 and table.read(0).where("shard = 4").count() == 0 and table.read(1).where("shard = 4").count() > 0


def test_pipeline_stages(spark, docs, tmp_path):
    labels = spark.createDataFrame([(i, 1 if i < 260 else 0, 0) for i in range(0, 370)], "doc_id long, quality int, toxic int")
    docs.select("doc_id", "text", "lang", "source", "n_chars").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    labels.coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "packing"]
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (name, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, now, str(tmp_path)).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if i < 3:
            assert after.columns == now.columns and 0 < after.count() <= now.count()
            now = after
    rows = after.collect()
    check_bins(rows, packing.CAPACITY)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in now.collect()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(rows)


def test_classifier_stage_knows_bad_texts_the_rules_took(spark, docs, corpus, tmp_path):
    bad = {r[0] for r in corpus if r[1] and "!!" in r[1]}
    unlabelled = min(bad)
    labels = spark.createDataFrame([(r[0], int(r[0] not in bad), 0) for r in corpus[:350] if r[0] != unlabelled], "doc_id long, quality int, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    survivors = docs.where(~docs.doc_id.isin(list(bad - {unlabelled})))  # no labelled bad text is left
    kept = {r["doc_id"] for r in corpus_pipeline.classifier(spark, survivors, str(tmp_path)).collect()}
    assert unlabelled not in kept and len(kept & set(range(260))) > 250


def test_leaves_reach_python_one_by_one_not_as_lists(spark):
    held = common.in_bitmap
    table = common.bitmap(spark.range(0, 40_000, 2).select("id"), "id", 1 << 16)
    wide = spark.range(200).select(F.col("id").alias("node"), F.sequence(F.col("id") * 200, F.col("id") * 200 + 199).alias("leaves"))
    found = jaccard_join.leaf_rows(wide, table)
    got = {(r["leaf"], r["node"]) for r in found.collect()}
    assert got == {(i, i // 200) for i in range(40_000) if held(table, np.array([i]))[0]}
    python = found._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow", 1)[1]
    assert "Generate explode" in python  # 200 leaves of a row are 200 rows of a batch, whose rows are bounded
