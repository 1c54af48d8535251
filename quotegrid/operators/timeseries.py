"""Series features of each station: fill, lags, rolling windows, future minimum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quotegrid.functions.frames import STATION, RollingExtremes, last_rows, rolling, series, so_far

LAGS = (1, 2, 3, 7, 14, 30)
CHANGES = (1, 3, 7, 14)
UNROLLED = 32  # more days than this are cut out of the array


def with_filled_price(df: DataFrame, price: str = "price", fill_limit: int = 3, keys: Sequence[str] = STATION) -> DataFrame:
    """``price_ffill``: the last price of this row or of up to ``fill_limit`` rows before."""
    filled = F.last(price, ignorenulls=True).over(last_rows(fill_limit + 1, keys))
    return df.withColumn("price_ffill", filled)


def observed_count(flag: str = "is_observed_price", keys: Sequence[str] = STATION) -> Column:
    """Number of observed days up to and including the row."""
    return F.sum(F.when(F.col(flag) == 1, 1).otherwise(0)).over(so_far(keys))


def lag_columns(column: str = "price_ffill", keys: Sequence[str] = STATION) -> dict[str, Column]:
    return {f"lag_{k}": F.lag(column, k).over(series(keys)) for k in LAGS}


def change_columns(column: str = "price_ffill") -> dict[str, Column]:
    return {f"change_{k}": F.col(column) - F.col(f"lag_{k}") for k in CHANGES}


def rolling_columns(column: str = "price_ffill", keys: Sequence[str] = STATION) -> dict[str, Column]:
    out = {}
    for n, at_least in ((7, 3), (30, 10)):
        out[f"roll_mean_{n}"] = rolling(F.avg, column, n, at_least, keys)
        out[f"roll_std_{n}"] = rolling(F.stddev_samp, column, n, at_least, keys)
    return out


YEAR = ("roll_min_365", "roll_max_365")


def year_extremes(column: str = "price_ffill", keys: Sequence[str] = STATION) -> RollingExtremes:
    return RollingExtremes(column, 365, 30, keys)


def price_position(column: str = "price_ffill") -> Column:
    """The price's place between the lowest and highest of the last 365 rows."""
    span = F.col(YEAR[1]) - F.col(YEAR[0])
    return F.when(span > 0, (F.col(column) - F.col(YEAR[0])) / span)


def with_price_position(df: DataFrame, column: str = "price_ffill", keys: Sequence[str] = STATION) -> DataFrame:
    """``roll_min_365``, ``roll_max_365`` and ``price_position_365``."""
    extremes = year_extremes(column, keys)
    df = df.withColumns(extremes.blocks()).withColumns(extremes.combined(*YEAR)).drop(*extremes.HELPERS)
    return df.withColumn("price_position_365", price_position(column))


def future_prices(price: str, furthest: int, keys: Sequence[str] = STATION) -> Column:
    """Array of the prices of the next ``furthest`` rows.

    One array serves every horizon, and also a horizon cut short at the end of a test window.
    """
    w = series(keys)
    return F.array(*[F.lead(price, k).over(w) for k in range(1, furthest + 1)])


def lowest_ahead(days: Column | int, ahead: str = "ahead") -> Column:
    """Lowest price of the next ``days`` rows (at least one); NULL where none of them has a price.

    A number of days known beforehand needs no copy of the array: ``least`` skips the missing ones as well.
    """
    if isinstance(days, int) and 2 <= days <= UNROLLED:
        return F.least(*[F.get(ahead, F.lit(i)) for i in range(days)])
    return F.array_min(F.slice(ahead, 1, days))


def target_columns(horizons: Sequence[int], price: str = "price", ahead: str = "ahead") -> dict[str, Column]:
    out = {}
    for h in horizons:
        target = lowest_ahead(h, ahead)
        out[f"target_min_{h}d"] = target
        out[f"target_saving_{h}d"] = F.col(price) - target
    return out


def calendar_columns(day: str = "date") -> dict[str, Column]:
    """Day of week (Monday 0), month and their places on the circle."""
    dow, month = F.weekday(day), F.month(day)
    turn = F.lit(2.0) * F.pi()
    return {
        "day_of_week": dow,
        "month": month,
        "dow_sin": F.sin(turn * dow / 7.0),
        "dow_cos": F.cos(turn * dow / 7.0),
        "month_sin": F.sin(turn * month / 12.0),
        "month_cos": F.cos(turn * month / 12.0),
    }
