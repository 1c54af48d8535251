"""The daily run: fit, back-test, recommend and publish for every scope and fuel in one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from quotegrid.operators import forecast as fc
from quotegrid.operators.policy import with_policy
from quotegrid.operators.timeseries import lowest_ahead
from quotegrid.plans.calibration import fit_and_test
from quotegrid.plans.frame import fuel_frame
from quotegrid.plans.publication import payloads, publish_summary, station_lines


@dataclass
class DailyRun:
    """The tables of one daily run; ``models`` are the forecaster's."""

    latest: DataFrame
    models: object
    summary: DataFrame
    payloads: DataFrame
    stations: DataFrame
    failures: DataFrame


def daily_run(
    prices: DataFrame,
    stations: DataFrame,
    scopes: DataFrame,
    production: DataFrame,
    metric: str | None = None,
    fetch_log: DataFrame | None = None,
    generated_at: str | None = None,
    stage=None,
    forecaster=fc.DifferenceForecaster(),
) -> DailyRun:
    """Recommendations of the last day for all scopes and fuels with a production model, or those of one ``metric``.

    ``stations`` carries ``scope_id``. A scope and fuel is a market of its own; all are worked on side by
    side, each with the horizon and waiting cost of its production row. One that cannot be fitted (no eligible
    row, or an empty side of its split) is reported in ``failures`` and keeps the others from nothing. ``stage`` (see
    ``quotegrid.session.stage``) stores the frame that fitting and recommending share.
    """
    pair = ["scope_id", "fuel_col"]
    keys = [*pair, "horizon_days"]
    active = production if metric is None else production.where(F.col("fuel_col") == metric)
    horizons = [r[0] for r in active.select("horizon_days").distinct().collect()]  # the grid: a few values
    if not horizons:
        raise ValueError("no production model" + (f" of {metric}" if metric else ""))
    frame = fuel_frame(prices, stations, active, horizons, fetch_log, wide=bool(forecaster.columns))
    columns = dict.fromkeys([*pair, "date", "station_id", "price", "regime", "ahead", *forecaster.columns])
    frame = frame.select(*columns)
    if stage is not None:
        frame = stage(frame, "daily-frame")
    rows = frame.join(active.select(*keys, "waiting_cost"), pair).withColumn(
        "target", lowest_ahead(F.col("horizon_days"))
    ).drop("ahead")
    models, _, sizes = fit_and_test(rows, keys, forecaster=forecaster)
    counted = active.select(*keys).join(sizes.drop("cutoff"), keys, "left").fillna(0, ["rows_train", "rows_test"])
    failures = counted.where("rows_train = 0 or rows_test = 0").withColumn("error", F.when(
        F.col("rows_train") + F.col("rows_test") == 0, "no_eligible_rows").otherwise("empty_split"))
    if stage is not None:
        failures = stage(failures, "daily-failures")

    # The last quoted day of each scope, from one row per station.
    per_station = prices.groupBy("station_id").agg(F.max("date").alias("date"))
    last_days = per_station.join(stations.select("station_id", "scope_id"), "station_id").groupBy("scope_id").agg(
        F.max("date").alias("date")
    )
    last = rows.join(last_days, ["scope_id", "date"]).join(failures.select(*pair), pair, "left_anti")
    predicted = forecaster.predict(last, models, keys).drop("rows_train")
    latest = with_policy(predicted, "target", F.col("waiting_cost"))
    latest = latest.drop("waiting_cost", "horizon_days")
    latest = latest.select(*pair, *[c for c in latest.columns if c not in pair])
    if stage is not None:
        latest = stage(latest, "daily-latest")
    return DailyRun(
        latest=latest,
        models=models,
        summary=publish_summary(latest, scopes=active.select(*pair)),
        payloads=payloads(latest, scopes, active, generated_at),
        stations=station_lines(latest),
        failures=failures,
    )
