"""Odd pages, small tables, ids that look like none, and a component that holds a third of all rows."""

import gc
import random
import time

import numpy as np

from quotegrid.llm import common, jaccard_join, quality_classifier, quality_rules, wrappers


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


def test_junk_is_rejected_in_tables_of_any_size(spark):
    rng = random.Random(4)
    for n in (50, 150, 1000):
        rows = [(i, words(rng, rng.randint(20, 120)), "en", f"s{i % 3}") for i in range(n)]
        rows += [(10_000 + i, " ".join(f"#{w}$%&|<>*" for w in words(rng, 40).split()), "en", "s0") for i in range(5)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        kept = {r["doc_id"]: r["kept"] for r in quality_rules.quality_report(docs).collect()}
        assert not any(kept[10_000 + i] for i in range(5)), n
        assert sum(kept[i] for i in range(n)) > 0.97 * n, n


def test_deep_nesting_and_unclosed_tags(spark):
    deep = "<html><body><article><p>Before it.</p>" + "<div>" * 10_000 + "In the depth." + "</div>" * 10_000 + "<p>After it.</p></article></body></html>"
    rows = [(1, "http://a.b/1", deep), (2, "http://a.b/2", "<article><p>Shown.</p>" + "<a " * 300_000 + "</article>"), (3, None, "<script " * 100_000)]
    start = time.time()
    assert len(wrappers.page_slots(rows[1][2])) > 0 and time.time() - start < 20
    got = {r["page_id"]: r["text"] for r in wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1] == "Before it.\n\nIn the depth.\n\nAfter it."
    assert got[2].startswith("Shown.")


def test_an_id_of_minus_one_is_no_missing_id(spark):
    docs = spark.createDataFrame([(-1, ""), (None, ""), (None, None), (-1, None), (5, "a b c d")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.components(docs).collect()), key=str)
    assert got == sorted([(-1, 0, -1), (-1, 0, -1), (None, 0, None), (None, 0, None), (5, 2, 5)], key=str)


def test_a_third_of_all_rows_in_one_component(spark):
    rng = random.Random(9)
    base = words(rng, 80).split()
    near = [[*base[:i % 80], words(rng, 1), *base[i % 80 + 1:]] for i in range(150)]
    rows = [(1000 - i, " ".join(w)) for i, w in enumerate(near)] + [(2000 + i, words(rng, 60)) for i in range(300)]
    rows += [(None, " ".join(base)), (3000, " ".join(base)), (3000, " ".join(base))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = jaccard_join.components(docs, 3, 90, 100).collect()
    sets = {i: {tuple(t.split()[j:j + 3]) for j in range(len(t.split()) - 2)} for i, t in enumerate(t for _, t in rows)}
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = {x: min((d for (d, _), y in zip(rows, label) if x == y and d is not None), default=None) for x in set(label)}
    want = sorted(((d, len(sets[i]), least[label[i]]) for i, (d, _) in enumerate(rows)), key=str)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == want


def test_a_worker_keeps_one_word_cache_whatever_operators_it_has_run():
    def alive():
        gc.collect()
        return sum(isinstance(x, common.Cache) for x in gc.get_objects())

    before = alive()
    text = words(random.Random(7), 50).encode()
    for module, compute in ((quality_rules, common.word_hash), (quality_classifier, quality_classifier.word_code), (jaccard_join, common.word_hash)):
        cache = module.worker_cache(compute)
        for word in text.split():
            assert cache[word] == compute(word)
    assert alive() <= before + 1
    assert quality_rules.worker_cache(common.word_hash) is cache
    assert common.CACHE_ENTRIES <= 150_000


def test_the_fit_holds_its_sets_in_one_array_each(spark, monkeypatch):
    rows = [(i, f"{'good' if i % 2 else 'bad'} text number {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    seen, descent = [], quality_classifier.dual_descent
    monkeypatch.setattr(quality_classifier, "dual_descent", lambda sets, values, *rest: seen.append((sets, values)) or descent(sets, values, *rest))
    ratio, _, _ = quality_classifier.fit(docs, labels)
    sets, values = seen[0]
    assert len(sets) > 10
    for s, v in zip(sets, values):
        assert s.base is sets[0].base and v.base is values[0].base
        assert (v == ratio[s] / np.linalg.norm(ratio[s])).all()
