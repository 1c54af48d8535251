"""Sketches of the n-gram join: a bound that never drops a link, and pairs that never reach the sets."""

from __future__ import annotations

import random

import numpy as np
import pytest

from quotegrid.llm import jaccard_join


@pytest.mark.parametrize("p", [80, 90])
def test_sketches_never_drop_a_link(p):
    rng = np.random.default_rng(p)
    for n in [1, 2, 5, 20, 130, 700, 1030, 2700, 2740, 9000]:
        sets = []
        for _ in range(12):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            cut = int(rng.integers(0, max(1, n // 4) + 1))
            sets += [a, np.unique(np.concatenate([a[cut:], rng.integers(0, 1 << 63, int(rng.integers(0, cut + 1))).astype(np.uint64)]))]
        sets = [s for s in sets if len(s)]
        sketches, sizes = [jaccard_join.sketch(s) for s in sets], np.array([len(s) for s in sets])
        x, y = np.triu_indices(len(sets), 1)
        apart = jaccard_join.least_apart(sketches, x, y)
        possible = jaccard_join.may_link(sketches, sizes, x, y, p, 100)
        for i, (a, b) in enumerate(zip(x, y)):
            both = len(np.intersect1d(sets[a], sets[b]))
            assert apart[i] <= sizes[a] + sizes[b] - 2 * both
            assert possible[i] or 100 * both < p * (sizes[a] + sizes[b] - both)


def test_texts_that_only_resemble_each_other_move_no_sets(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=8))
    base = [word() for _ in range(255)]
    rows = [(i, " ".join(base + [word() for _ in range(45)])) for i in range(40)]  # two of them are alike by some 0.74
    rows += [(100, rows[0][1] + " " + word()), (101, rows[1][1])]
    compared, moved, pairs = [], [], jaccard_join._pairs_of_leaves

    def seen(*args):
        found = pairs(*args)
        compared.append(found.count())
        return found

    class Steps(jaccard_join.WorkingTables):
        def keep(self, df, step):
            out = super().keep(df, step)
            if step == "near":
                moved.append(out.count())
            return out

    monkeypatch.setattr(jaccard_join, "_pairs_of_leaves", seen)
    monkeypatch.setattr(jaccard_join, "WorkingTables", Steps)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.components(df, 5, 80, 100).collect()}
    assert got == {i: i for i in range(40)} | {100: 0, 101: 1}
    assert sum(compared) <= 30 and sum(moved) <= 60, (compared, moved)  # without sketches, hundreds of the 780 pairs
