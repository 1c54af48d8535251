"""The (date, station) panel: joins, calendar expansion, daily summaries and look-ups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from quotegrid.functions.frames import by_key
from quotegrid.functions.text import to_number
from quotegrid.schema import METRIC_GROUPS, METRIC_LABELS, METRICS, STATION_ATTRIBUTES


def parse_day(value: str | date | None) -> date | None:
    """A date argument; text must read ``YYYY-MM-DD``."""
    if value is None or isinstance(value, date):
        return value
    try:
        return datetime.strptime(value, "%Y-%m-%d").date()
    except ValueError as exc:
        raise ValueError(f"invalid date {value!r}, expected YYYY-MM-DD") from exc


def in_range(df: DataFrame, start=None, end=None, column: str = "date") -> DataFrame:
    """Rows between two optional dates, both included; reaches the Parquet scan as a pushed filter."""
    start, end = parse_day(start), parse_day(end)
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end))
    return df


def observed_flag(metrics: Sequence[str] = METRICS) -> Column:
    """1 where any metric has a value."""
    return F.coalesce(*metrics).isNotNull().cast("int") if len(metrics) > 1 else F.col(metrics[0]).isNotNull().cast("int")


def date_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def panel_bounds(prices: DataFrame, stations: DataFrame, fetch_log: DataFrame | None) -> DataFrame:
    """First and last day of the prices of known stations, else of the fetch log, else today."""
    # One row per station before the semi join, so the join never moves the price rows.
    per_station = prices.groupBy("station_id").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    known = per_station.join(stations.select("station_id"), "station_id", "left_semi")
    bounds = known.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    today = F.current_date()
    if fetch_log is None:
        return bounds.select(F.coalesce("lo", today).alias("lo"), F.coalesce("hi", today).alias("hi"))
    log = fetch_log.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return bounds.select(
        F.coalesce("lo", log.select("lo").scalar(), today).alias("lo"),
        F.coalesce("hi", log.select("hi").scalar(), today).alias("hi"),
    )


def placed_quotes(
    prices: DataFrame,
    stations: DataFrame,
    fetch_log: DataFrame | None = None,
    start=None,
    end=None,
    attributes: Sequence[str] = (),
    metrics: Sequence[str] = METRICS,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """The quotes by station in date order, each station's row without a date first (see :func:`expand_calendar`).

    Adds the dates before and after (``_prev``, ``_next``), the station's attributes (``_attr``, NULL for unknown stations) and the
    calendar's first and last day (``_lo``, ``_hi``); ``_number`` is the date as a number, for frames of days. Of several quotes of one day the one that holds comes first.
    """
    start, end = parse_day(start), parse_day(end)
    rows = in_range(prices, start, end)
    if bounds is None and not (start and end):
        bounds = panel_bounds(rows, stations, fetch_log)
    lo = F.lit(start) if start else bounds.select("lo").scalar()
    hi = F.lit(end) if end else bounds.select("hi").scalar()
    carried = [c for c in ("fetched_at", *metrics) if c in prices.columns]

    station = stations.select("station_id", F.struct(F.lit(True).alias("known"), *attributes).alias("_station"))
    both = by_key(
        rows.select("station_id", "date", *carried).unionByName(station, allowMissingColumns=True), ["station_id"]
    )
    # Of several rows of one day the first one fills it, the others find no day left: the latest wins.
    w = Window.partitionBy("station_id").orderBy(F.asc_nulls_first("_number"), *[F.desc_nulls_last(c) for c in carried])
    return both.withColumn("_number", F.unix_date("date").cast("bigint")).withColumns({
        "_prev": F.lag("date").over(w),
        "_next": F.lead("date").over(w),
        "_attr": F.first("_station", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
    }).withColumns({"_lo": lo, "_hi": hi})


def expand_calendar(
    prices: DataFrame,
    stations: DataFrame,
    fetch_log: DataFrame | None = None,
    start=None,
    end=None,
    attributes: Sequence[str] = (),
    metrics: Sequence[str] = METRICS,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """One row per day and station; metrics are NULL on days without a quote.

    ``bounds`` are those of :func:`panel_bounds`, where they are known already.

    No day-by-station product is joined. Each station is put into the quotes as a row without a date;
    ordered by date it comes first, hands its attributes to the quotes behind it, and stands for the
    whole calendar where there are none (quotes of unknown stations drop out). Each quote row is then
    exploded into its own day and the empty days before it, the last one also into the days after
    it. Of several quotes of one day and station the one fetched last holds (of those, the largest values). Only the sparse quotes are shuffled, once, by station, which is also the partitioning every
    later series window needs.
    """
    carried = [c for c in ("fetched_at", *metrics) if c in prices.columns]
    placed = (
        placed_quotes(prices, stations, fetch_log, start, end, attributes, metrics, bounds)
        .where("_attr is not null and (date is not null or _next is null)")
        .withColumns({
            "_from": F.coalesce(F.date_add("_prev", 1), F.col("_lo")),
            "_to": F.when(F.col("_next").isNotNull(), F.col("date")).otherwise(F.col("_hi")),
        })
    )
    days = F.when(F.col("_from") <= F.col("_to"), F.sequence("_from", "_to"))
    here = F.col("_day") == F.col("date")
    return placed.withColumn("_day", F.explode(days)).select(
        F.col("_day").alias("date"), "station_id", *[F.col(f"_attr.{a}").alias(a) for a in attributes],
        *[F.when(here, F.col(c)).alias(c) for c in carried],
    )


def with_fetch_status(df: DataFrame, fetch_log: DataFrame | None) -> DataFrame:
    """Attach the status of the day; NULL where the log has none."""
    if fetch_log is None:
        return df.withColumn("fetch_status", F.lit(None).cast("string"))
    # The log holds one row per calendar day, which bounds the broadcast.
    status = fetch_log.select("date", F.col("status").alias("fetch_status"))
    return df.join(F.broadcast(status), "date", "left")


def station_panel(
    prices: DataFrame,
    stations: DataFrame,
    fetch_log: DataFrame | None = None,
    start=None,
    end=None,
    include_metadata: bool = True,
    drop_all_null: bool = True,
    full_calendar: bool = False,
    include_fetch_status: bool = True,
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """One row per (date, station): quotes of known stations, or every day with ``full_calendar``."""
    attributes = [a for a in STATION_ATTRIBUTES if a in stations.columns] if include_metadata else []
    numeric = prices.withColumns({m: to_number(m) for m in metrics})
    if full_calendar:
        panel = expand_calendar(numeric, stations, fetch_log, start, end, attributes, metrics)
    else:
        panel = in_range(numeric, start, end).join(stations.select("station_id", *attributes), "station_id")
    panel = panel.withColumn("is_observed_price", observed_flag(metrics))
    if drop_all_null:
        panel = panel.where(F.col("is_observed_price") == 1)
    columns = ["date", "fetched_at", "station_id", *attributes, *metrics, "is_observed_price"]
    panel = panel.select(*[c for c in columns if c in panel.columns])
    return with_fetch_status(panel, fetch_log) if include_fetch_status else panel


def model_panel(prices, stations, fetch_log=None, start=None, end=None) -> DataFrame:
    """The preset the model works on: every day, metadata, rows without prices kept."""
    return station_panel(
        prices, stations, fetch_log, start, end,
        include_metadata=True, drop_all_null=False, full_calendar=True, include_fetch_status=True,
    )


def daily_summary(
    prices: DataFrame,
    stations: DataFrame,
    fetch_log: DataFrame | None = None,
    start=None,
    end=None,
    full_calendar: bool = False,
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """Per day min, mean, max, std and number of stations of every metric.

    Empty (day, station) cells change none of the aggregates, so the full calendar needs the day
    list only, not the expanded panel.
    """
    panel = station_panel(
        prices, stations, None, start, end,
        include_metadata=False, drop_all_null=False, include_fetch_status=False, metrics=metrics,
    )
    aggs = []
    for m in metrics:
        aggs += [
            F.min(m).alias(f"{m}_min"),
            F.avg(m).alias(f"{m}_mean"),
            F.max(m).alias(f"{m}_max"),
            F.stddev_samp(m).alias(f"{m}_std"),
            F.count(m).alias(f"{m}_stations"),
        ]
    summary = panel.groupBy("date").agg(*aggs)
    if full_calendar:
        days = calendar(prices, stations, fetch_log, start, end)
        counts = {f"{m}_stations": 0 for m in metrics}
        summary = days.join(summary, "date", "left").fillna(counts)
    return with_fetch_status(summary, fetch_log)


def calendar(prices, stations, fetch_log=None, start=None, end=None) -> DataFrame:
    """The days of the full-calendar panel, one row each; empty where there is no station."""
    start, end = parse_day(start), parse_day(end)
    bounds = panel_bounds(in_range(prices, start, end), stations, fetch_log)
    any_station = stations.select("station_id").limit(1)
    lo = F.lit(start) if start else F.col("lo")
    hi = F.lit(end) if end else F.col("hi")
    span = bounds.select(lo.alias("lo"), hi.alias("hi")).where(any_station.exists())
    return span.select(F.explode(F.when(F.col("lo") <= F.col("hi"), F.sequence("lo", "hi"))).alias("date"))


# Look-ups ------------------------------------------------------------------------------------

def records_per_date(prices: DataFrame, start=None, end=None) -> DataFrame:
    return in_range(prices, start, end).groupBy("date").agg(F.count(F.lit(1)).alias("records_count"))


def price_history(
    prices: DataFrame, metric: str, as_of, days: int = 180, aggregate: str = "min", station_id: str | None = None
) -> DataFrame:
    """Price per day over the last ``days`` days before ``as_of``, of one station or over all.

    An unknown ``aggregate`` means the minimum.
    """
    since = F.date_sub(F.lit(parse_day(as_of)), days)
    rows = prices.where((F.col("date") >= since) & F.col(metric).isNotNull())
    if station_id is not None:
        return rows.where(F.col("station_id") == station_id).select("date", F.col(metric).alias("price"))
    fn = {"min": F.min, "mean": F.avg, "max": F.max}.get(aggregate, F.min)
    return rows.groupBy("date").agg(fn(metric).alias("price"))


def best_metric(group: str) -> tuple[Column, Column]:
    """Lowest price over a metric group and the label of the first metric that has it."""
    if group not in METRIC_GROUPS:
        raise ValueError(f"unknown metric group: {group}")
    metrics = METRIC_GROUPS[group]
    best = F.least(*metrics)
    label = None
    for m in metrics:
        hit, text = F.col(m) == best, F.lit(METRIC_LABELS[m])
        label = F.when(hit, text) if label is None else label.when(hit, text)
    return best, label


def latest_prices(prices: DataFrame, stations: DataFrame, group: str = "diesel") -> DataFrame:
    """Stations quoted on the last date with their best price in a metric group."""
    best, label = best_metric(group)
    last = prices.agg(F.max("date").alias("d")).scalar()
    return (
        prices.where(F.col("date") == last)
        .join(stations, "station_id")
        .select("station_name", "address", "schedule", *METRIC_GROUPS[group], "date")
        .withColumns({"mejor_precio": best, "mejor_tipo": label})
        .where(F.col("mejor_precio").isNotNull())
        .orderBy(F.asc_nulls_last("mejor_precio"), F.asc_nulls_last("station_name"))
    )


def flat_export(prices: DataFrame, stations: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    """Prices with station name and address; with ``metrics`` those columns only."""
    joined = prices.join(stations.select("station_id", "station_name", "address"), "station_id")
    if metrics:
        wanted = [m for m in metrics if m in joined.columns]
        return joined.select("date", "station_name", "address", *wanted)
    return joined.select("date", "station_name", "address", *[c for c in prices.columns if c != "date"])


def panel_profile(panel: DataFrame, metric: str) -> DataFrame:
    """Rows, date range, distinct dates and stations, observed and missing prices.

    The distinct counts come from one row per (date) and per (station), each pre-aggregated, instead
    of one aggregate that would expand every panel row.
    """
    price = F.col(metric)
    by_station = panel.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("date").alias("lo"), F.max("date").alias("hi"),
        F.count(price).alias("observed"),
    )
    dates = panel.select("date").distinct().agg(F.count("date")).scalar()
    return by_station.agg(
        F.sum("rows").alias("n_rows"),
        F.min("lo").alias("date_min"), F.max("hi").alias("date_max"),
        F.count("station_id").alias("n_stations"),
        F.sum("observed").alias("observed_prices"),
    ).select(
        "n_rows", "date_min", "date_max", dates.alias("n_dates"), "n_stations", "observed_prices",
        (F.col("n_rows") - F.col("observed_prices")).alias("missing_prices"),
        ((F.col("n_rows") - F.col("observed_prices")) / F.col("n_rows")).alias("share_missing_prices"),
    )


def table_counts(**tables: DataFrame) -> DataFrame:
    """``table_name, n_rows`` of each given table."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def has_prices(prices: DataFrame, day) -> bool:
    """Whether a day has any price row; stops at the first one."""
    return not prices.where(F.col("date") == F.lit(parse_day(day))).limit(1).isEmpty()
