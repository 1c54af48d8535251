"""The training frame: panel plus all features, regime and targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from quotegrid.functions.frames import by_key
from quotegrid.functions.text import to_number
from quotegrid.operators import market as mk
from quotegrid.operators import timeseries as ts
from quotegrid.operators.panel import expand_calendar, in_range, observed_flag, panel_bounds, parse_day, placed_quotes
from quotegrid.operators.regime import RegimeRules, quoted_regimes, with_regimes
from quotegrid.schema import METRICS


def features(
    panel: DataFrame,
    metric: str,
    horizons: Sequence[int] = (7,),
    fill_limit: int = 3,
    scope: Sequence[str] = (),
    market: DataFrame | None = None,
    rules: RegimeRules = RegimeRules(),
    keep: Sequence[str] = (),
    ends: Sequence = (),
    ranked: bool = False,
) -> DataFrame:
    """Features, regime and targets of one metric on a panel with one row per day and station.

    ``scope`` names columns that split the stations into separate markets. ``keep`` names panel
    columns to carry along. The price rank needs the rows once by (day, price); it is taken before
    the wide columns exist, so that the wide rows never leave the station partitioning. A panel of
    :func:`ranked_panel` brings fills and ranks along (``ranked``) and does not move at all.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric: {metric}")
    missing = {"date", "station_id", metric} - set(panel.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    day = [*scope, "date"]
    flag = F.col("is_observed_price") if "is_observed_price" in panel.columns else F.col(metric).isNotNull()
    carried = [c for c in dict.fromkeys([*scope, *keep]) if c not in ("date", "station_id")]
    narrow = panel.select(
        "date", "station_id", *carried,
        to_number(metric).alias("price"),
        F.coalesce(flag.cast("int"), F.lit(0)).alias("is_observed_price"),
        *(mk.RANKED if ranked else ()),
    )
    if market is None:
        market = mk.market_stats(narrow, "price", day)

    placed = narrow
    if not ranked:
        filled = ts.with_filled_price(narrow, "price", fill_limit)
        placed = by_key(mk.with_price_ranks(filled, "price_ffill", day), ["station_id"])
    extremes = ts.year_extremes()
    # Wide columns come with the last window pass; the passes before it carry narrow rows.
    frame = with_regimes(placed, "price_ffill", rules, alongside=(
        {"days_since_observed": ts.observed_count(), **extremes.blocks()},
        extremes.combined(*ts.YEAR),
        {**ts.lag_columns(), **ts.rolling_columns(), "ahead": ts.future_prices("price", max(horizons))},
    ), ends=ends).drop(*extremes.HELPERS)
    frame = frame.withColumns({**ts.change_columns(), "price_position_365": ts.price_position()})
    frame = mk.with_spreads(mk.with_market(frame, market, day))
    frame = frame.withColumns({**ts.calendar_columns(), **ts.target_columns(horizons)})
    return frame.withColumns({
        f"target_available_{h}d": F.col(f"target_min_{h}d").isNotNull().cast("int") for h in horizons
    })


def ranked_panel(
    quotes: DataFrame,
    stations: DataFrame,
    metric: str,
    scope: Sequence[str] = (),
    fetch_log: DataFrame | None = None,
    start=None,
    end=None,
    attributes: Sequence[str] = (),
    fill_limit: int = 3,
) -> DataFrame:
    """The expanded calendar of one metric with fills and ranks, both worked out on the sparse quotes.

    ``scope`` and ``attributes`` are columns of ``stations``; only the first split the market.
    """
    rows = in_range(quotes, start, end)
    bounds = panel_bounds(rows, stations, fetch_log)
    last = F.lit(parse_day(end)) if end else bounds.select("hi").scalar()
    known = rows.join(stations.select("station_id", *scope), "station_id")
    ranked = mk.ranked_quotes(known, last, metric, fill_limit, scope)
    return expand_calendar(
        ranked, stations, None, start, end, [*scope, *attributes], [metric, "is_observed_price", *mk.RANKED], bounds)


def _sparse(prices: DataFrame, metric: str) -> DataFrame:
    """One metric of the price table with the panel's observed flag (any metric has a value)."""
    return prices.withColumn("is_observed_price", observed_flag(METRICS)).select(
        "date", "station_id", to_number(metric).alias(metric), "is_observed_price"
    )


def model_frame(
    prices: DataFrame,
    stations: DataFrame,
    metric: str,
    furthest: int,
    fetch_log: DataFrame | None = None,
    start=None,
    end=None,
    scope: Sequence[str] = (),
    fill_limit: int = 3,
    rules: RegimeRules = RegimeRules(),
    ends: Sequence = (),
) -> DataFrame:
    """What the quantile forecaster learns from: observed rows with price, regime and prices ahead.

    The same columns as in :func:`training_frame`, without the market and rank features the
    forecaster does not use, so without their shuffles. ``ends``: see :func:`quotegrid.operators.regime.with_regimes`.
    """
    return _model_rows(_sparse(prices, metric), stations, metric, furthest, fetch_log, start, end, scope, fill_limit, rules, ends)


def _model_rows(
    quotes: DataFrame, stations: DataFrame, metric: str, furthest: int, fetch_log: DataFrame | None = None, start=None, end=None,
    keep: Sequence[str] = (), fill_limit: int = 3, rules: RegimeRules = RegimeRules(), ends: Sequence = (),
) -> DataFrame:
    """Regimes and prices ahead of the observed rows, worked out on the quotes: no empty day becomes a row.

    Stations listed more than once have several rows a day, and rules without a least jump make resets of days without a
    quote: those go by the expanded calendar.
    """
    metrics = [metric, "is_observed_price"]
    columns = [*keep, "date", "station_id", "price", "is_observed_price", "regime", "ahead", *(["by_end"] if ends else [])]
    bounds = panel_bounds(in_range(quotes, start, end), stations, fetch_log)

    def by_calendar(quotes: DataFrame, stations: DataFrame) -> DataFrame:
        panel = expand_calendar(quotes, stations, fetch_log, start, end, keep, metrics, bounds).withColumnRenamed(metric, "price")
        frame = with_regimes(
            ts.with_filled_price(panel, "price", fill_limit), "price_ffill", rules,
            alongside=({}, {}, {"ahead": ts.future_prices("price", furthest)}), ends=ends,
        )
        return frame.where(F.col("is_observed_price") == 1).select(*columns)

    if rules.min_reset_jump <= 0:
        return by_calendar(quotes, stations)
    often = stations.groupBy(F.col("station_id").alias("_often")).count().where("count > 1").select("_often")
    several = F.col("station_id").eqNullSafe(F.col("_often"))
    placed = placed_quotes(quotes, stations.join(often, several, "left_anti"), fetch_log, start, end, keep, metrics, bounds)
    frame = quoted_regimes(placed, metric, furthest, fill_limit, rules, ends)
    single = frame.where(F.col("is_observed_price") == 1).select(
        *[F.col(f"_attr.{c}").alias(c) for c in keep], F.col(metric).alias("price"), *[c for c in columns if c not in (*keep, "price")]
    ).select(*columns)
    return single.unionByName(by_calendar(*[df.join(often, several, "left_semi") for df in (quotes, stations)]))


def fuel_frame(
    prices: DataFrame,
    stations: DataFrame,
    pairs: DataFrame,
    horizons: Sequence[int],
    fetch_log: DataFrame | None = None,
    wide: bool = False,
    fill_limit: int = 3,
    rules: RegimeRules = RegimeRules(),
) -> DataFrame:
    """Observed rows of every (scope_id, fuel_col) in ``pairs``, as :func:`model_frame` gives them, or with all features if ``wide``.

    The prices are scanned once and melted to one row per quote and fuel; a series is one station's prices of one fuel, so
    fuels are worked on side by side and no series is longer than the calendar. Markets are those of a scope and fuel.
    """
    fuels = [r[0] for r in pairs.select("fuel_col").distinct().collect()]  # metrics: a few values
    unknown = set(fuels) - set(METRICS)
    if unknown:
        raise ValueError(f"unknown metrics: {sorted(unknown)}")
    known = pairs.select("scope_id", "fuel_col").distinct()
    series = F.concat_ws("/", "fuel_col", "station_id")
    carrier = METRICS[0]
    quotes = prices.where(observed_flag(METRICS) == 1).select("date", "station_id", F.explode(F.array(*[
        F.struct(F.lit(f).alias("fuel_col"), to_number(f).alias(carrier)) for f in fuels])).alias("_q"))
    quotes = quotes.select("date", F.concat_ws("/", "_q.fuel_col", "station_id").alias("station_id"), f"_q.{carrier}", F.lit(1).alias("is_observed_price"))
    named = stations.select("scope_id", "station_id").join(known, "scope_id").select(
        "scope_id", "fuel_col", F.col("station_id").alias("_station"), series.alias("station_id"))
    scope = ["scope_id", "fuel_col", "_station"]
    if wide:
        panel = ranked_panel(quotes, named, carrier, scope[:2], fetch_log, attributes=scope[2:], fill_limit=fill_limit)
        frame = features(panel, carrier, horizons, fill_limit, scope[:2], rules=rules, keep=["_station"], ranked=True).where("is_observed_price = 1")
    else:
        frame = _model_rows(quotes, named, carrier, max(horizons), fetch_log, keep=scope, fill_limit=fill_limit, rules=rules)
    return frame.drop("station_id").withColumnRenamed("_station", "station_id")


def training_frame(
    prices: DataFrame,
    stations: DataFrame,
    metric: str,
    horizons: Sequence[int] = (7,),
    fetch_log: DataFrame | None = None,
    start=None,
    end=None,
    scope: Sequence[str] = (),
    fill_limit: int = 3,
    rules: RegimeRules = RegimeRules(),
    ends: Sequence = (),
) -> DataFrame:
    """:func:`features` straight from the base tables.

    Market statistics, fills and price ranks are taken from the sparse quotes, which give the same
    result as the expanded panel at a fraction of its rows.
    """
    rows = _sparse(prices, metric)
    panel = ranked_panel(rows, stations, metric, scope, fetch_log, start, end, fill_limit=fill_limit)
    known = rows.join(stations.select("station_id", *scope), "station_id")
    market = mk.market_stats(in_range(known, start, end).withColumnRenamed(metric, "price"), "price", [*scope, "date"])
    return features(panel, metric, horizons, fill_limit, scope, market, rules, ends=ends, ranked=True)
