"""Exact ranks and quantiles from counts per distinct value.

Ranking a group with one window puts the whole group into one task, and an exact percentile keeps
all its values in one buffer. Here the values are counted first (with partial counts before the
shuffle, so a value or group that holds a third of all rows costs one row per map task), and the
running counts are built in two steps: over value buckets, then inside each bucket. No task sees
more than the distinct values of one bucket or the non-empty buckets of one group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET_WIDTH = 0.01


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys, value, n``: rows per distinct non-NULL value."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def running_counts(
    counts: DataFrame, keys: Sequence[str], value: str, width: float | Column = BUCKET_WIDTH
) -> DataFrame:
    """``keys, value, n, below, total`` from :func:`value_counts`.

    ``below`` counts the rows of the group with a smaller value, ``total`` all rows of the group.
    ``width`` is that of a bucket, or an expression over the keys that gives it.
    """
    keys = list(keys)
    bucketed = counts.withColumn("_b", F.floor(F.col(value) / width))
    ahead = (Window.unboundedPreceding, -1)
    per_bucket = bucketed.groupBy(*keys, "_b").agg(F.sum("n").alias("_bn"))
    in_group = Window.partitionBy(*keys)
    offsets = per_bucket.select(
        *keys, "_b",
        F.coalesce(F.sum("_bn").over(in_group.orderBy("_b").rowsBetween(*ahead)), F.lit(0)).alias("_before"),
        F.sum("_bn").over(in_group).alias("total"),
    )
    in_bucket = Window.partitionBy(*keys, "_b").orderBy(value).rowsBetween(*ahead)
    inner = bucketed.withColumn("_inside", F.coalesce(F.sum("n").over(in_bucket), F.lit(0)))
    return inner.join(offsets, [*keys, "_b"]).select(
        *keys, value, "n", (F.col("_before") + F.col("_inside")).alias("below"), "total"
    )


def quantiles(ranked: DataFrame, keys: Sequence[str], value: str, qs: dict[str, float]) -> DataFrame:
    """``keys, total, <name>...``: linearly interpolated quantiles from :func:`running_counts`."""
    total, below, n = F.col("total"), F.col("below"), F.col("n")

    def at(position):
        return F.max(F.when((below <= position) & (position < below + n), F.col(value)))

    parts = []
    for name, q in qs.items():
        position = (total - 1) * F.lit(float(q))
        parts += [at(F.floor(position)).alias(f"_lo_{name}"), at(F.ceil(position)).alias(f"_hi_{name}")]
    grouped = ranked.groupBy(*keys, "total").agg(*parts)

    def between(name, q):
        position = (total - 1) * F.lit(float(q))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return (lo + (hi - lo) * (position - F.floor(position))).alias(name)

    return grouped.select(*keys, "total", *[between(name, q) for name, q in qs.items()])
