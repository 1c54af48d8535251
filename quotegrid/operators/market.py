"""Per-day statistics over all stations, and each station's place in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quotegrid.functions.frames import by_key
from quotegrid.operators.histogram import quantiles, running_counts, value_counts

DAY = ("date",)
#: What :func:`ranked_quotes` adds to a quote.
RANKED = ("price_ffill", "price_rank_pct", "n_cheaper_stations")


def market_stats(panel: DataFrame, price: str, keys: Sequence[str] = DAY) -> DataFrame:
    """``keys, market_min, market_mean, market_median, market_std`` of the observed prices."""
    rows = panel.where(F.col(price).isNotNull())
    moments = rows.groupBy(*keys).agg(
        F.min(price).alias("market_min"),
        F.avg(price).alias("market_mean"),
        F.stddev_samp(price).alias("market_std"),
    )
    ranked = running_counts(value_counts(rows, keys, price), keys, price)
    median = quantiles(ranked, keys, price, {"market_median": 0.5}).drop("total")
    return moments.join(median, list(keys)).select(
        *keys, "market_min", "market_mean", "market_median", "market_std"
    )


def with_market(df: DataFrame, market: DataFrame, keys: Sequence[str] = DAY) -> DataFrame:
    """Attach the day's statistics. Per day only, the statistics are bounded by the calendar and
    broadcast; with further keys Spark chooses the join by size."""
    side = F.broadcast(market) if tuple(keys) == DAY else market
    return df.join(side, list(keys), "left")


def with_spreads(df: DataFrame, price: str = "price_ffill") -> DataFrame:
    return df.withColumns({
        "spread_to_market_median": F.col(price) - F.col("market_median"),
        "spread_to_market_min": F.col(price) - F.col("market_min"),
    })


def with_price_ranks(df: DataFrame, price: str = "price_ffill", keys: Sequence[str] = DAY) -> DataFrame:
    """``price_rank_pct`` (average rank as a share) and ``n_cheaper_stations`` within a day.

    A day holds every station, so it is not sorted in one task: ranks come from counts per distinct
    price and are joined back on (day, price). Rows without a price keep NULL. Call it while the
    rows are narrow, since the join moves them.
    """
    keys = list(keys)
    ranked = running_counts(value_counts(df, keys, price), keys, price)
    ranks = ranked.select(
        *keys, price,
        ((F.col("below") + 1 + (F.col("n") - 1) / 2) / F.col("total")).alias("price_rank_pct"),
        F.col("below").alias("n_cheaper_stations"),
    )
    return df.join(ranks, [*keys, price], "left")


def ranked_quotes(quotes: DataFrame, last: Column, price: str, fill_limit: int = 3, scope: Sequence[str] = ()) -> DataFrame:
    """Fills and ranks worked out on the quotes, before the calendar is expanded: ``date, station_id``, ``price``,
    ``is_observed_price``, ``price_ffill``, ``price_rank_pct``, ``n_cheaper_stations``.

    A price holds from its day until the station's next price, for ``fill_limit`` more days at most and not after ``last``.
    Each quote gives a row of its own day and one for each day after it that has no quote and on which the price still
    holds, so there is one row per station and day, and none for the empty rest of the calendar. These narrow rows are what
    meets the ranks; the dense rows take them along by station. Of several quotes of a day the largest values hold.
    ``scope`` names columns of ``quotes`` that split the stations into markets.
    """
    best = [F.max(c).alias(c) for c in (price, "is_observed_price")]
    each = by_key(quotes, ["station_id"]).groupBy("station_id", "date").agg(*best, *[F.min(c).alias(c) for c in scope])
    w = Window.partitionBy("station_id").orderBy("date")
    priced = F.last(F.when(F.col(price).isNotNull(), F.struct("date", F.col(price).alias("price"))), ignorenulls=True)
    held = each.withColumns({
        "_held": priced.over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "_next": F.lead("date").over(w),
    }).withColumn("_until", F.date_add("_held.date", fill_limit))
    # greatest and least skip NULLs: without a price the row stands for its own day only, the last quote has no next.
    empty_until = F.least("_until", F.date_sub("_next", 1), last)
    end = F.when(F.col("_until").isNotNull(), F.greatest("date", empty_until)).otherwise(F.col("date"))
    here = F.col("_day") == F.col("date")
    days = held.withColumn("_day", F.explode(F.sequence("date", end))).select(
        F.col("_day").alias("date"), "station_id", *scope,
        *[F.when(here, F.col(c)).alias(c) for c in (price, "is_observed_price")],
        F.when(F.col("_day") <= F.col("_until"), F.col("_held.price")).alias("price_ffill"),
    )
    return with_price_ranks(days, "price_ffill", [*scope, "date"]).select(
        "date", "station_id", price, "is_observed_price", *RANKED)
