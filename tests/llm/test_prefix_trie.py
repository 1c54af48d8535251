"""The prefix trie against brute force, with bands of two depths and of the usual height."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from quotegrid.llm import prefix_trie as pt

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, md5(md5(role or "") + md5(text or "")), role or "", text or ""))
    original = {c: [x[3:] for x in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = original.get(c - int(abs(c) % 20 * (1 if c > 0 else -1)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, ms in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(ms) - 1) * words
    return [
        (min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(str(c) for c in sorted(ms) if len(built[c]) == len(node)).encode()).hexdigest())
        for node, ms in members.items()
    ]


@pytest.fixture(scope="module")
def rows():
    out = [(None, 0, "user", "lost"), (3, None, "user", "first"), (3, 0, None, None), (3, 0, None, None), (3, 0, "user", "tie"),
           (4, 0, "user", "a  b\tc"), (25, 0, "user", "x"), (-7, 1, "user", "below"), (-20, 0, "user", "below"), (61, 0, "a", "b")]
    for c in range(100, 160):  # a hot first turn, copies, and a family without its first member (100 has turns, 120 none)
        if 120 <= c < 123:
            continue
        for t in range(c % 7):
            out.append((c, t, "user" if t % 2 == 0 else "assistant", "hello there" if t == 0 else f"w{t} " * (c % 3)))
    for c in (200, 201, 202):  # long ones that part late
        out += [(c, t, "user", f"t{t} word" if t < 70 + c % 200 else f"{c} {t}") for t in range(75)]
    return out


def report(spark, rows, band=pt.BAND):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    steps, lengths = pt.rebuilt(pt.stage(pt.numbered(df), "numbered"))
    return [tuple(x) for x in pt.prefix_trie(steps, lengths, band).select(*COLUMNS).collect()]


@pytest.mark.parametrize("band", [3])
def test_trie_equals_brute_force(spark, rows, band):
    assert sorted(report(spark, rows, band), key=str) == sorted(brute(rows), key=str)


def test_conversation_over_several_chunks(spark, rows, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK", 8)
    assert sorted(report(spark, rows), key=str) == sorted(brute(rows), key=str)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert pt.trie_report(empty).count() == 0
    one = spark.createDataFrame([(1, 0, None, "a b", 5, "z")], "conv_id int, turn int, role string, text string, depth int, node string")
    assert pt.trie_report(one).select("depth", "n_convs").orderBy("depth").collect()[0] == (0, 1)


def test_sql_equals_brute_force(rows):
    import pandas as pd

    con = duckdb.connect()
    frame = pd.DataFrame([r for r in rows if r[0] is None or r[0] >= 0], columns=["conv_id", "turn", "role", "text"]).astype(
        {"conv_id": "Int64", "turn": "Int64"})
    con.register("conversations", frame)
    got = con.execute(pt.ORACLE).fetchall()
    assert sorted(got, key=str) == sorted(brute([r for r in rows if r[0] is None or r[0] >= 0]), key=str)
