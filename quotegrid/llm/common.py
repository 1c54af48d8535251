"""What several operators share: staging, Arrow batch helpers, words and their hashes, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from quotegrid.session import WorkingTables

#: Rows of an Arrow batch are worked off in slices of about this many text bytes.
SLICE_BYTES = 2 << 20
#: Entries after which a worker's cache is emptied; bounds its memory, never its results.
CACHE_ENTRIES = 150_000

#: A-Z to a-z, all other bytes as they are.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that a slice holds about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        sizes = batch.column(column)
        ends = np.cumsum(pc.fill_null(pc.binary_length(sizes), 0).to_numpy(zero_copy_only=False).astype(float))
        start, n = 0, batch.num_rows
        while start < n:
            before = ends[start - 1] if start else 0.0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def as_array(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array(values, type=kind)


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one numpy array per row, without a Python object per item."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))


class Cache(dict):
    """A dict that computes what it lacks. ``trim`` empties it when it has grown large."""

    def __init__(self, compute: Callable):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        value = self[key] = self.compute(key)
        return value

    def trim(self, most: int = CACHE_ENTRIES) -> None:
        if len(self) > most:
            self.clear()


@lru_cache(maxsize=1)
def worker_cache(compute: Callable) -> Cache:
    """The worker's one cache: operators with the same function share it, and that of another function is given up.

    Spark keeps its workers from stage to stage, so a cache of each operator's own would stay for all stages that follow.
    """
    return Cache(compute)


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def mixed(x: np.ndarray) -> np.ndarray:
    """A finalizer over uint64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows; a shorter, non-empty sequence is one window of its own length."""
    n = len(hashes)
    if not n:
        return hashes
    k_now = min(k, n)
    out = np.full(n - k_now + 1, np.uint64(k_now), dtype=np.uint64)
    for i in range(k_now):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i:n - k_now + 1 + i])
    return out


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, label): the smallest node reachable over ``links`` (a, b), for nodes that have a link.

    Alternating large-star and small-star passes: each is a min-aggregate, reduced before the shuffle,
    and a join Spark may split; written to the shared folder after each pair of passes. No neighbour
    list is ever gathered. Ends when a pass changes nothing (checked by counts and hashes of the edges).
    """
    steps = WorkingTables(name)
    edges = steps.keep(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(down.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        old, edges = edges, steps.keep(small, "edges")
        steps.drop(old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        seen = now


BITS = 1 << 24


def bitmap(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """A set of hashed keys as ``bits`` bits: fixed in size whatever the number of keys.

    Used to leave rows out of a shuffle early: a key that is in the set is always reported, others are
    dropped by the exact join that follows. ``column`` is a 64-bit hash.
    """
    at = F.pmod(F.col(column), F.lit(bits))
    words = keys.select(((at - at % 32) / 32).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 32).cast("int")).alias("v"))
    got = words.groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()
    out = np.zeros(bits // 32, dtype=np.uint32)
    out[got["w"].to_numpy().astype(np.int64)] = got["v"].to_numpy().astype(np.uint32)
    return out


def in_bitmap(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the signed 64-bit keys are (probably) in the table."""
    at = np.mod(keys.astype(np.int64), np.int64(len(table) * 32))
    return (table[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1
