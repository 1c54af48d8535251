"""Window specs and row-frame expressions over one series per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

STATION = ("station_id",)


def by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partition by key into ``spark.sql.shuffle.partitions`` parts, which adaptive execution keeps.

    For steps whose rows grow after the shuffle (calendar expansion, wide windows): sized by the bytes
    of the narrow input they would run in too few tasks.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys)


def series(keys: Sequence[str] = STATION) -> WindowSpec:
    """One series per key in date order.

    A series holds one row per calendar day, so its length is bounded by the calendar however
    many raw quotes one station has.
    """
    return Window.partitionBy(*keys).orderBy("date")


def last_rows(n: int, keys: Sequence[str] = STATION) -> WindowSpec:
    return series(keys).rowsBetween(1 - n, 0)


def so_far(keys: Sequence[str] = STATION) -> WindowSpec:
    return series(keys).rowsBetween(Window.unboundedPreceding, 0)


def rolling(agg, column: str, n: int, at_least: int, keys: Sequence[str] = STATION) -> Column:
    """``agg`` over the last ``n`` rows, NULL below ``at_least`` non-NULL values."""
    frame = last_rows(n, keys)
    return F.when(F.count(column).over(frame) >= at_least, agg(column).over(frame))


def recent_values(column: str, n: int, keys: Sequence[str] = STATION) -> Column:
    """The non-NULL values of the last ``n`` rows as a sorted array, at most ``n`` long."""
    return F.sort_array(F.collect_list(column).over(last_rows(n, keys)))


def median_of(values: str, at_least: int, zeros: str | None = None) -> Column:
    """Median of a column of sorted arrays, NULL below ``at_least`` values. ``zeros`` names the number of zeros that stand before the array's values.

    With :func:`recent_values` in a column of its own every array is sorted once. A framed
    ``percentile`` gives the same and rebuilds a hash map per row, which is several times slower.
    """
    before = F.col(zeros) if zeros else F.lit(0)
    size = F.size(values) + before
    nth = lambda i: F.when(i < before, F.lit(0.0)).otherwise(F.get(values, i - before))
    low, high = F.floor((size - 1) / 2).cast("int"), F.floor(size / 2).cast("int")
    return F.when(size >= at_least, (nth(low) + nth(high)) / 2)


class RollingExtremes:
    """Rolling min and max over a long frame in two short steps.

    Step one takes the extremes of a block of about ``sqrt(n)`` rows, step two the extremes of the
    block results lagged so that together they cover exactly the last ``n`` rows. About
    ``2 * sqrt(n)`` values per row instead of ``n``, on one sort. Lags before the start of a series
    are NULL, which ``least`` and ``greatest`` skip. The steps are given as columns, so that they can
    share a window pass with others.
    """

    def __init__(self, column: str, n: int, at_least: int, keys: Sequence[str] = STATION):
        self.column, self.n, self.at_least, self.keys = column, n, at_least, keys
        self.block = max(1, round(n ** 0.5))

    def blocks(self) -> dict[str, Column]:
        frame = last_rows(self.block, self.keys)
        return {
            "_lo": F.min(self.column).over(frame),
            "_hi": F.max(self.column).over(frame),
            "_seen": F.count(self.column).over(so_far(self.keys)),
        }

    def combined(self, min_name: str, max_name: str) -> dict[str, Column]:
        w = series(self.keys)
        starts = [*range(0, self.n - self.block, self.block), self.n - self.block]

        def over(fn, name):
            parts = [F.lag(name, k).over(w) if k else F.col(name) for k in starts]
            return fn(*parts) if len(parts) > 1 else parts[0]

        enough = F.col("_seen") - F.coalesce(F.lag("_seen", self.n).over(w), F.lit(0)) >= self.at_least
        return {
            min_name: F.when(enough, over(F.least, "_lo")),
            max_name: F.when(enough, over(F.greatest, "_hi")),
        }

    HELPERS = ("_lo", "_hi", "_seen")
