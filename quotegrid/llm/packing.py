"""Conflict-constrained best-fit packing of documents into sequences of bounded length.

No bin holds two pieces of one source or of one duplicate cluster. Bins are kept in order of the room left
(residual) and carry a bitmap of their sources and one of their clusters; the search starts at
the smallest residual that fits and goes on to the next until a bin without a conflict is found: the
tightest compatible one. Documents are spread over groups by hash, each group packed by one task.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, functions as F

CAPACITY = 8192  # code points in a bin
GROUP_DOCS = 4096  # documents of a group, on average: the number of groups grows with the input
SCHEMA = "doc_id long, source string, cluster string, piece int, start long, length long, bin_id string, bin_offset long"


def best_fit(items: list[tuple[int, int, int]], capacity: int, least: int = 1) -> list[tuple[int, int]]:
    """(bin, offset) of each (length, source, cluster), given in order of placement.

    ``source`` and ``cluster`` are small non-negative numbers, -1 for none. Bins too full for ``least`` leave the search.
    """
    order: list[tuple[int, int]] = []  # (residual, bin), open bins only
    sources: list[int] = []
    clusters: list[int] = []
    out = []
    for length, source, cluster in items:
        a, b = (1 << source) if source >= 0 else 0, (1 << cluster) if cluster >= 0 else 0
        at = bisect_left(order, (length, -1))
        while at < len(order):
            found = order[at][1]
            if not (sources[found] & a or clusters[found] & b):
                break
            at += 1
        if at < len(order):
            residual, found = order.pop(at)
        else:
            residual, found = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[found] |= a
        clusters[found] |= b
        out.append((found, capacity - residual))
        if residual - length >= least:
            insort(order, (residual - length, found))
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, group_docs: int = GROUP_DOCS, key: str = "doc_id",
         text: str = "text", source: str = "source", cluster: str | None = None) -> DataFrame:
    """Rows as ``SCHEMA``: where each piece of each document lies.

    A document longer than a bin is cut into pieces of ``capacity`` and a rest; full pieces fill bins of
    their own. ``start`` and ``length`` count code points of the text. NULL and empty texts give one piece of length 0. ``cluster``
    names a column of duplicate clusters; by default equal texts are one. A NULL source conflicts with nothing. Repeated
    rows and rows without an id are all packed; an empty table gives an empty result. Order of placement: longest
    first, then cluster, id. Other columns are not read; the text itself is not shuffled.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    groups = max(1, -(-docs.count() // group_docs))
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.length(body).cast("long").alias("n"),
        (F.sha2(body.cast("binary"), 256) if cluster is None else F.col(cluster).cast("string")).alias("cluster"))
    salt = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0))
    rows = rows.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "cluster", salt), F.lit(groups)))

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame["pack_group"].iloc[0])
        out: list[tuple] = []
        rest = []
        n_full = 0
        frame = frame.sort_values(["cluster", "doc_id", "n", "source"], na_position="first")
        for doc, src, n, clu in zip(frame["doc_id"], frame["source"], frame["n"], frame["cluster"], strict=True):
            full = (n - 1) // capacity if n else 0
            for piece in range(full):
                out.append((doc, src, clu, piece, piece * capacity, capacity, f"{group}-f{n_full}", 0))
                n_full += 1
            rest.append((n - full * capacity, doc, src, clu, full, full * capacity))
        rest.sort(key=lambda r: -r[0])  # stable: ties stay in order of cluster and id
        names = {s: i for i, s in enumerate(sorted({r[2] for r in rest if isinstance(r[2], str)}))}
        shared = Counter(r[3] for r in rest if isinstance(r[3], str))
        cluster_no = {c: i for i, c in enumerate(sorted(c for c, k in shared.items() if k > 1))}
        least = max(1, rest[-1][0])
        places = best_fit([(r[0], names.get(r[2], -1), cluster_no.get(r[3], -1)) for r in rest], capacity, least)
        out += [(doc, src, clu, piece, start, n, f"{group}-{b}", at)
                for (n, doc, src, clu, piece, start), (b, at) in zip(rest, places, strict=True)]
        return pd.DataFrame(out, columns=["doc_id", "source", "cluster", "piece", "start", "length", "bin_id", "bin_offset"]).astype({"doc_id": "Int64"})

    return rows.groupBy("pack_group").applyInPandas(packed, SCHEMA)
