"""Fit, test and compare horizons and waiting costs on one temporal split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from quotegrid.operators import forecast as fc
from quotegrid.operators.metrics import metric_aggregates
from quotegrid.operators.policy import policy_aggregates, with_policy, with_waiting_costs
from quotegrid.operators.timeseries import lowest_ahead
from quotegrid.schema import MIN_ROWS_PER_REGIME

HORIZONS = (3, 5, 7, 10, 14)  # fixed values: the search grid
WAITING_COSTS = (0.001, 0.002, 0.003, 0.005, 0.008)


def fit_and_test(
    rows: DataFrame, keys: Sequence[str], train_end=None, min_rows: int = MIN_ROWS_PER_REGIME,
    forecaster=fc.DifferenceForecaster(),
) -> tuple:
    """Models, forecasts of the test rows, and per key the cutoff with train and test row counts.

    ``rows`` come from :func:`quotegrid.operators.forecast.horizon_rows`, with the columns the ``forecaster`` needs.
    """
    usable = fc.eligible(rows)
    split = fc.with_split(usable, fc.split_dates(usable, keys, train_end), keys)
    train, test = split.where("is_train"), split.where("not is_train")
    models = forecaster.fit(train, keys, min_rows)
    sizes = split.groupBy(*keys, "cutoff").agg(
        F.count_if("is_train").alias("rows_train"), F.count_if(~F.col("is_train")).alias("rows_test")
    )
    return models, forecaster.predict(test, models, keys), sizes


def backtest_result(
    rows: DataFrame, keys: Sequence[str], cost: float, train_end=None, forecaster=fc.DifferenceForecaster()
) -> DataFrame:
    """The back-test of a fit: row counts, error measures and policy summary per key."""
    _, predicted, sizes = fit_and_test(rows, keys, train_end, forecaster=forecaster)
    measured = with_policy(predicted.drop("rows_train", "cutoff"), "target", cost).groupBy(*keys).agg(
        *metric_aggregates("target"), *policy_aggregates()
    ).drop("rows")
    return sizes.join(measured, list(keys))


def calibration_table(
    frame: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    costs: Sequence[float] = WAITING_COSTS,
    scope: Sequence[str] = (),
    train_end=None,
    min_rows: int = MIN_ROWS_PER_REGIME,
    forecaster=fc.DifferenceForecaster(),
) -> DataFrame:
    """One row per horizon and waiting cost with policy summary, error measures and row counts."""
    keys = [*scope, "horizon_days"]
    rows = fc.horizon_rows(frame, horizons, scope, forecaster.columns)
    _, predicted, _ = fit_and_test(rows, keys, train_end, min_rows, forecaster)
    cost = F.col("waiting_cost")
    evaluated = with_policy(with_waiting_costs(predicted, costs), "target", cost)
    return evaluated.groupBy(*keys, "waiting_cost", "rows_train", F.col("cutoff").alias("train_end_date")).agg(
        *policy_aggregates(), *metric_aggregates("target")
    ).withColumn("rows_test", F.col("rows"))


def calibration_failures(
    frame: DataFrame, horizons: Sequence[int] = HORIZONS, scope: Sequence[str] = (), train_end=None
) -> DataFrame:
    """Horizons that cannot be fitted: no eligible row, or an empty side of the split.

    Without ``scope`` every horizon is reported on, also one without any row.
    """
    keys = [*scope, "horizon_days"]
    _, _, sizes = fit_and_test(fc.horizon_rows(frame, horizons, scope), keys, train_end)
    sizes = sizes.drop("cutoff")
    if scope:
        wanted = frame.select(*scope).distinct().withColumn(
            "horizon_days", F.explode(F.array(*[F.lit(int(h)) for h in horizons]))
        )
    else:
        wanted = frame.sparkSession.createDataFrame([(int(h),) for h in horizons], "horizon_days int")
    counted = wanted.join(sizes, keys, "left").fillna(0, ["rows_train", "rows_test"])
    error = (
        F.when((F.col("rows_train") == 0) & (F.col("rows_test") == 0), "no_eligible_rows")
        .when((F.col("rows_train") == 0) | (F.col("rows_test") == 0), "empty_split")
    )
    return counted.withColumn("error", error).where(F.col("error").isNotNull())


def latest_rows(frame: DataFrame, last_day: DataFrame) -> DataFrame:
    """Observed rows of the last day of the panel (one row, column ``date``).

    The day comes from the price table: on the last day no station need be observed, and then there
    is no recommendation.
    """
    return frame.where((F.col("date") == last_day.select("date").scalar()) & (F.col("is_observed_price") == 1))


def predict_latest(
    frame: DataFrame, models, last_day: DataFrame, horizon: int, cost: float, scope: Sequence[str] = (),
    forecaster=fc.DifferenceForecaster(),
) -> DataFrame:
    """Recommendations of the last day, in the order decision, price, station."""
    target = f"target_min_{horizon}d"
    rows = latest_rows(frame, last_day).select(
        *dict.fromkeys([*scope, "date", "station_id", "price", "regime", *forecaster.columns]),
        lowest_ahead(horizon).alias(target), F.lit(int(horizon)).alias("horizon_days"),
    )
    predicted = forecaster.predict(rows, models, [*scope, "horizon_days"]).drop("horizon_days", "rows_train")
    return with_policy(predicted, target, cost).select(
        *scope, "date", "station_id", "price", "regime", "pred_q20", "pred_q50", "pred_q80", target,
        "decision", "realized_wait_gain", "policy_realized_saving", "oracle_best_action",
    ).orderBy("decision", F.col("price").asc_nulls_last(), "station_id")


def latest_by_cost(
    frame: DataFrame, models, last_day: DataFrame, horizons: Sequence[int], costs: Sequence[float],
    scope: Sequence[str] = (), forecaster=fc.DifferenceForecaster(),
) -> DataFrame:
    """Recommendations of the last day for every horizon and waiting cost; the future is unknown."""
    rows = fc.horizon_rows(latest_rows(frame, last_day), horizons, scope, forecaster.columns).withColumn(
        "target", F.lit(None).cast("double")
    )
    predicted = forecaster.predict(rows, models, [*scope, "horizon_days"]).drop("ahead", "rows_train")
    return with_policy(with_waiting_costs(predicted, costs), "target", F.col("waiting_cost"))
