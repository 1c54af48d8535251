"""Named queries over the star-schema tables, one or more per operator."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quotegrid.functions import text as tx
from quotegrid.functions.frames import rolling, series
from quotegrid.operators import boosting as bo
from quotegrid.operators import forecast as fc
from quotegrid.operators import lookup as lk
from quotegrid.operators import market as mk
from quotegrid.operators import panel as pn
from quotegrid.operators import timeseries as ts
from quotegrid.operators import upsert as up
from quotegrid.operators.metrics import forecast_metrics
from quotegrid.operators.policy import policy_summary, with_gains, with_policy, with_waiting_costs
from quotegrid.operators.regime import with_regimes
from quotegrid.plans import backtest as bt
from quotegrid.plans import calibration as cal
from quotegrid.plans import publication as pub
from quotegrid.plans import selection as sel
from quotegrid.plans.daily import daily_run
from quotegrid.plans.export import dataset, export_dataset
from quotegrid.plans.frame import model_frame, training_frame
from quotegrid.schema import METRIC_GROUPS, METRICS, NUMERIC_FEATURES
from quotegrid.session import stage, working_path
from quotegrid.sources import feed, star
from quotegrid.sources import tables as tb

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FUEL = "precio_gasoleo_a"
H = cal.HORIZONS
COSTS = cal.WAITING_COSTS
ROLLING = dict(min_train=730, test_window=30, step=30, max_folds=12)  # fixed values: rolling defaults
AS_OF = dt.date(2001, 11, 4)


ROUNDING = True


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    """Averages and the like to nine digits, so that the order of a sum does not show.

    The small shift moves exact ties (means over a multiple of 64 rows) off the rounding edge. Only
    a comparison needs this; ``ROUNDING`` turns it off for timings.
    """
    if not ROUNDING:
        return df
    return df.withColumns({c: F.round(F.col(c) + 1e-12, digits) for c in columns})


def now():
    return F.expr("timestamp '2002-02-01 00:00:00'")


def base(spark, d):
    return star.prices(spark, d), star.stations(spark, d)


def observed(spark, d) -> DataFrame:
    """The primary metric of every (date, station) with the panel's observed flag."""
    return star.prices(spark, d).withColumn("is_observed_price", pn.observed_flag()).select(
        "date", "station_id", F.col(FUEL).alias("price"), "is_observed_price"
    )


def dense(spark, d) -> DataFrame:
    df = pn.expand_calendar(observed(spark, d), star.stations(spark, d), metrics=["price", "is_observed_price"])
    return df.withColumn("is_observed_price", F.coalesce("is_observed_price", F.lit(0)))


def filled(spark, d) -> DataFrame:
    return ts.with_filled_price(dense(spark, d))


def model_rows(spark, d, scope=(), ends=()) -> DataFrame:
    p, s = base(spark, d)
    return model_frame(p, s, FUEL, max(H), scope=scope, ends=ends)


def staged_rows(spark, d, scope=(), ends=()) -> DataFrame:
    """Model rows as a table, for plans that read them more than once."""
    return stage(model_rows(spark, d, scope, ends), "model-rows")


# Panel ---------------------------------------------------------------------------------------

@query
def station_panel(spark, d):
    p, s = base(spark, d)
    return pn.station_panel(p, s, star.fetch_log(spark, d)).select(
        "date", "station_id", "station_name", "municipality", "province", *METRICS, "is_observed_price", "fetch_status"
    )


@query
def panel_date_range(spark, d):
    p, s = base(spark, d)
    return pn.station_panel(
        p, s, start="1998-01-01", end="1998-12-31", include_metadata=False, include_fetch_status=False
    ).drop("fetched_at")


@query
def panel_drop_all_null(spark, d):
    p, s = base(spark, d)
    return pn.station_panel(
        p, s, include_metadata=False, include_fetch_status=False, metrics=METRIC_GROUPS["gasolina"]
    ).drop("fetched_at")


@query
def panel_full_calendar(spark, d):
    p, s = base(spark, d)
    return pn.station_panel(
        p, s, include_metadata=False, drop_all_null=False, full_calendar=True, include_fetch_status=False
    ).drop("fetched_at")


@query
def panel_calendar_arguments(spark, d):
    """The calendar reaches beyond the data where the arguments say so."""
    p, s = base(spark, d)
    return pn.station_panel(
        p, s, start="2001-06-01", end="2002-03-31", include_metadata=False, drop_all_null=False,
        full_calendar=True, include_fetch_status=False,
    ).select("date", "station_id", FUEL, "is_observed_price")


@query
def model_panel(spark, d):
    p, s = base(spark, d)
    return pn.model_panel(p, s, star.fetch_log(spark, d)).select(
        "date", "station_id", "municipality", "province", FUEL, "is_observed_price", "fetch_status"
    )


@query
def panel_fetch_status(spark, d):
    p, _ = base(spark, d)
    log = _patchy_log(spark, d)
    return pn.with_fetch_status(p.select("date", "station_id", FUEL), log)


@query
def daily_summary(spark, d):
    p, s = base(spark, d)
    out = pn.daily_summary(p, s, star.fetch_log(spark, d))
    return rounded(out, *[f"{m}_{x}" for m in METRICS for x in ("mean", "std")])


@query
def daily_summary_full_calendar(spark, d):
    p, s = base(spark, d)
    out = pn.daily_summary(p, s, star.fetch_log(spark, d), start="1994-12-01", end="2001-12-31", full_calendar=True)
    return rounded(out, *[f"{m}_{x}" for m in METRICS for x in ("mean", "std")])


@query
def records_per_date(spark, d):
    return pn.records_per_date(star.prices(spark, d), "1996-01-01", "2000-12-31")


@query
def date_bounds(spark, d):
    return pn.date_bounds(star.prices(spark, d))


@query
def price_history_min(spark, d):
    return pn.price_history(star.prices(spark, d), FUEL, AS_OF, 180, "min")


@query
def price_history_mean(spark, d):
    return rounded(pn.price_history(star.prices(spark, d), METRICS[1], AS_OF, 720, "mean"), "price")


@query
def price_history_max(spark, d):
    return pn.price_history(star.prices(spark, d), METRICS[3], AS_OF, 3600, "max")


@query
def station_history(spark, d):
    return pn.price_history(star.prices(spark, d), METRICS[2], AS_OF, 3600, station_id="7")


@query
def table_counts(spark, d):
    p, s = base(spark, d)
    return pn.table_counts(prices=p, stations=s, fetch_log=star.fetch_log(spark, d))


@query
def latest_best_price_diesel(spark, d):
    return pn.latest_prices(*base(spark, d), "diesel")


@query
def latest_best_price_gasolina(spark, d):
    return pn.latest_prices(*base(spark, d), "gasolina")


@query
def best_price_in_group(spark, d):
    """The row-wise best price and its label over every price row, not the last day's only."""
    out = star.prices(spark, d)
    for group in METRIC_GROUPS:
        best, label = pn.best_metric(group)
        out = out.withColumns({f"best_{group}": best, f"label_{group}": label})
    return out.select("date", "station_id", *[f"{x}_{g}" for g in METRIC_GROUPS for x in ("best", "label")])


@query
def flat_export(spark, d):
    return pn.flat_export(*base(spark, d)).drop("fetched_at")


@query
def flat_export_columns(spark, d):
    return pn.flat_export(*base(spark, d), [FUEL, METRICS[4], "not_a_column"])


@query
def panel_profile(spark, d):
    return rounded(pn.panel_profile(dense(spark, d), "price"), "share_missing_prices")


@query
def distinct_date_status(spark, d):
    p, s = base(spark, d)
    panel = pn.station_panel(p, s, _patchy_log(spark, d), include_metadata=False)
    return panel.select("date", "fetch_status").distinct()


# Series windows ------------------------------------------------------------------------------

@query
def ffill_limit3(spark, d):
    return filled(spark, d).select("date", "station_id", "price", "price_ffill")


@query
def observed_cum_count(spark, d):
    return dense(spark, d).withColumn("days_since_observed", ts.observed_count()).select(
        "date", "station_id", "is_observed_price", "days_since_observed"
    )


@query
def lags_changes(spark, d):
    out = filled(spark, d).withColumns(ts.lag_columns()).withColumns(ts.change_columns())
    return out.select("date", "station_id", *[f"lag_{k}" for k in ts.LAGS], *[f"change_{k}" for k in ts.CHANGES])


@query
def detector_deltas(spark, d):
    w = series()
    return filled(spark, d).select(
        "date", "station_id",
        *[(F.col("price_ffill") - F.lag("price_ffill", k).over(w)).alias(f"delta_{k}") for k in (1, 3, 7)],
    )


@query
def rolling_7_14_30(spark, d):
    columns = {
        **ts.rolling_columns(),
        "rolling_mean_14": rolling(F.avg, "price_ffill", 14, 5),
        "rolling_std_14": rolling(F.stddev_samp, "price_ffill", 14, 5),
    }
    return rounded(filled(spark, d).withColumns(columns).select("date", "station_id", *columns), *columns)


@query
def rolling_extremes_365(spark, d):
    return ts.with_price_position(filled(spark, d)).select("date", "station_id", "roll_min_365", "roll_max_365")


@query
def price_position_365(spark, d):
    return rounded(
        ts.with_price_position(filled(spark, d)).select("date", "station_id", "price_position_365"), "price_position_365"
    )


@query
def market_stats(spark, d):
    return rounded(mk.market_stats(observed(spark, d), "price"), "market_mean", "market_median", "market_std")


@query
def market_stats_by_scope(spark, d):
    rows = observed(spark, d).join(star.stations(spark, d).select("station_id", "scope_id"), "station_id")
    return rounded(
        mk.market_stats(rows, "price", ["scope_id", "date"]), "market_mean", "market_median", "market_std"
    )


@query
def spread_to_market(spark, d):
    out = mk.with_spreads(mk.with_market(filled(spark, d), mk.market_stats(observed(spark, d), "price")))
    out = out.select("date", "station_id", "spread_to_market_median", "spread_to_market_min")
    return rounded(out, "spread_to_market_median")


@query
def price_rank_pct(spark, d):
    return rounded(
        mk.with_price_ranks(filled(spark, d)).select("date", "station_id", "price_ffill", "price_rank_pct"),
        "price_rank_pct",
    )


@query
def n_cheaper(spark, d):
    return mk.with_price_ranks(filled(spark, d)).select("date", "station_id", "n_cheaper_stations")


@query
def calendar_features(spark, d):
    columns = ts.calendar_columns()
    out = observed(spark, d).withColumns(columns).select("date", "station_id", *columns)
    return rounded(out, "dow_sin", "dow_cos", "month_sin", "month_cos")


REGIME_COLUMNS = {
    "robust_scale": ["delta_1", "robust_scale"],
    "cycle_resets": ["cycle_reset_flag", "recent_resets_90"],
    "days_since_reset": ["days_since_reset"],
    "regime_labels": ["delta_3", "regime"],
}


def _regime_query(name):
    def run(spark, d):
        return with_regimes(filled(spark, d)).select("date", "station_id", *REGIME_COLUMNS[name])
    run.__name__ = name
    return query(run)


for _name in REGIME_COLUMNS:
    _regime_query(_name)


@query
def future_min_targets(spark, d):
    out = dense(spark, d).withColumn("ahead", ts.future_prices("price", max(H)))
    columns = ts.target_columns(H)
    return out.withColumns(columns).withColumns(
        {f"target_available_{h}d": F.col(f"target_min_{h}d").isNotNull().cast("int") for h in H}
    ).select("date", "station_id", *columns, *[f"target_available_{h}d" for h in H])


@query
def training_features(spark, d):
    """The whole training frame of one horizon."""
    p, s = base(spark, d)
    frame = training_frame(p, s, FUEL, [7])
    columns = ["date", "station_id", "regime", *NUMERIC_FEATURES, "target_min_7d", "target_available_7d"]
    averages = [c for c in NUMERIC_FEATURES if c.startswith(("market_m", "market_s", "roll", "dow", "month_"))]
    return rounded(frame.select(*columns), *averages, "price_position_365", "spread_to_market_median", "price_rank_pct")


# Forecast ------------------------------------------------------------------------------------

def _split(spark, d):
    rows = fc.eligible(fc.horizon_rows(staged_rows(spark, d), H))
    return fc.with_split(rows, fc.split_dates(rows, ["horizon_days"]), ["horizon_days"])


@query
def eligible_rows(spark, d):
    return fc.eligible(fc.horizon_rows(model_rows(spark, d), H)).select(
        "date", "station_id", "horizon_days", "price", "target"
    )


@query
def temporal_split(spark, d):
    rows = fc.eligible(fc.horizon_rows(staged_rows(spark, d), H))
    _, _, sizes = cal.fit_and_test(rows, ["horizon_days"])
    return sizes.join(fc.split_dates(rows, ["horizon_days"]).select("horizon_days", "n_dates"), "horizon_days")


@query
def temporal_split_given_date(spark, d):
    rows = fc.horizon_rows(staged_rows(spark, d), H)
    return cal.fit_and_test(rows, ["horizon_days"], "2000-12-31")[2]


@query
def quantile_fit(spark, d):
    models = fc.fit(_split(spark, d).where("is_train"), ["horizon_days"])
    return rounded(models, "diff_q20", "diff_q50", "diff_q80")


@query
def quantile_fit_by_scope(spark, d):
    rows = fc.eligible(fc.horizon_rows(staged_rows(spark, d, ["scope_id"]), H, ["scope_id"]))
    keys = ["scope_id", "horizon_days"]
    split = fc.with_split(rows, fc.split_dates(rows, keys), keys)
    return rounded(fc.fit(split.where("is_train"), keys), "diff_q20", "diff_q50", "diff_q80")


def _predicted(spark, d):
    return cal.fit_and_test(fc.horizon_rows(staged_rows(spark, d), H), ["horizon_days"])[1]


@query
def quantile_predict(spark, d):
    out = _predicted(spark, d).select(
        "date", "station_id", "horizon_days", "price", "regime", "pred_q20", "pred_q50", "pred_q80"
    )
    return rounded(out, "pred_q20", "pred_q50", "pred_q80")


@query
def fit_backtest(spark, d):
    out = cal.backtest_result(fc.horizon_rows(staged_rows(spark, d), H), ["horizon_days"], 0.003)
    return rounded(out, *_MEASURES, *_POLICY)


def _last_day(spark, d) -> DataFrame:
    return star.prices(spark, d).agg(F.max("date").alias("date"))


@query
def predict_latest(spark, d):
    rows = staged_rows(spark, d)
    models = cal.fit_and_test(fc.horizon_rows(rows, [3]), ["horizon_days"])[0]
    return rounded(cal.predict_latest(rows, models, _last_day(spark, d), 3, 0.001), "pred_q20", "pred_q50", "pred_q80")


@query
def latest_gains(spark, d):
    rows = staged_rows(spark, d)
    models = cal.fit_and_test(fc.horizon_rows(rows, [14]), ["horizon_days"])[0]
    out = with_gains(cal.predict_latest(rows, models, _last_day(spark, d), 14, 0.001)).select(
        "station_id", "decision", "expected_gain_q50", "probable_gain_q80"
    )
    return rounded(out, "expected_gain_q50", "probable_gain_q80")


@query
def latest_by_waiting_cost(spark, d):
    rows = staged_rows(spark, d)
    models = cal.fit_and_test(fc.horizon_rows(rows, H), ["horizon_days"])[0]
    return cal.latest_by_cost(rows, models, _last_day(spark, d), H, COSTS).select(
        "station_id", "horizon_days", "waiting_cost", "price", "regime", "decision",
        "realized_wait_gain", "policy_realized_saving", "oracle_best_action",
    )


_POLICY = ["decision_accuracy_vs_oracle", "share_wait", "avg_realized_wait_gain", "avg_policy_realized_saving"]
_MEASURES = [f"{m}_q{q}" for q in (20, 50, 80) for m in ("mae", "pinball")] + ["rmse_q50"]


@query
def decision_policy(spark, d):
    return with_policy(_predicted(spark, d), "target", 0.003).select(
        "date", "station_id", "horizon_days", "decision", "realized_wait_gain", "policy_realized_saving",
        "oracle_best_action",
    )


@query
def policy_summary_by_horizon(spark, d):
    out = policy_summary(with_policy(_predicted(spark, d), "target", 0.003), ["horizon_days"])
    return rounded(out, *_POLICY)


@query
def forecast_error_measures(spark, d):
    return rounded(forecast_metrics(_predicted(spark, d), "target", ["horizon_days"]), *_MEASURES)


def boosted_rows(spark, d, ends=()) -> DataFrame:
    """The training frame of all horizons as a table: what the boosted model learns from."""
    p, s = base(spark, d)
    frame = training_frame(p, s, FUEL, H, ends=ends).where("is_observed_price = 1")
    states = ["by_end"] if ends else []
    return stage(frame.select("date", "station_id", "regime", *NUMERIC_FEATURES, "ahead", *states), "boosted-frame")


@query
def impute_medians(spark, d):
    """What stands for missing values in each of the 41 features, and how many rows of the frame it fills."""
    p, s = base(spark, d)
    columns = ["station_id", "regime", *NUMERIC_FEATURES]
    rows = stage(training_frame(p, s, FUEL, [7]).where("target_available_7d = 1").select(*columns), "impute-rows")
    fills = bo.fill_values(rows)
    full = bo.filled(rows, fills)
    counts = full.agg(*[F.count_if(F.col(c).isNull() & F.col(f"{c}_filled").isNotNull()).alias(f"_{c}") for c in columns])
    each = fills.crossJoin(F.broadcast(counts)).select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("feature"), (F.lit(None) if c in columns[:2] else F.col(c)).cast("double").alias("median"),
        (F.col(c) if c in columns[:2] else F.lit(None)).cast("string").alias("most_frequent"), F.col(f"_{c}").alias("rows_filled"),
    ) for c in columns])).alias("e")).select("e.*")
    return rounded(each, "median", digits=7)


def _boosted_split(spark, d, horizons):
    rows = fc.eligible(fc.horizon_rows(boosted_rows(spark, d), horizons, columns=bo.BoostedForecaster.columns))
    return fc.with_split(rows, fc.split_dates(rows, ["horizon_days"]), ["horizon_days"])


@query
def boosted_ensembles(spark, d):
    """The full-size model of every horizon, regime and quantile: its trees, and what their leaves hold."""
    train = _boosted_split(spark, d, H).where("is_train")
    nodes = bo.BoostedForecaster().fit(train, ["horizon_days"]).nodes
    start = F.col("tree") == bo.START
    trees = nodes.groupBy("horizon_days", "model_key", "q", "tree").agg(
        F.sum("rows").alias("rows"), F.min(F.when(~start, F.col("rows"))).alias("least"), F.max("node").alias("last"))
    return trees.groupBy("horizon_days", "model_key", "q").agg(
        F.count_if(~start).alias("trees"), F.max(F.when(start, F.col("rows"))).alias("rows_train"),
        F.min("rows").alias("least_rows_of_a_tree"), F.max("rows").alias("most_rows_of_a_tree"),
        (F.min("least") >= 10).alias("leaves_large_enough"), (F.max("last") < 16).alias("depth_kept"))


def _against_baseline(boosted, baseline, keys):
    """Per key: rows, quantiles in order, and whether the boosted model's pinball loss is at most the baseline's."""
    ordered = F.min((F.col("pred_q20") <= F.col("pred_q50")) & (F.col("pred_q50") <= F.col("pred_q80")))
    loss = [f"pinball_q{q}" for q in (20, 50, 80)]
    own = forecast_metrics(boosted, "target", [*keys, "rows_train"]).select(*keys, "rows_train", F.struct(*loss).alias("a"))
    other = forecast_metrics(baseline, "target", keys).select(*keys, F.struct(*loss).alias("b"))
    counts = boosted.groupBy(*keys).agg(F.count("*").alias("rows_test"), ordered.alias("quantiles_in_order"))
    total = lambda c: sum(F.col(f"{c}.{m}") for m in loss)
    return own.join(other, keys).join(counts, keys).select(
        *keys, "rows_train", "rows_test", "quantiles_in_order", (total("a") <= total("b")).alias("no_worse_than_baseline"))


@query
def boosted_calibration(spark, d):
    """Horizons compared with the full-size model, next to the feature-free one on the same split."""
    rows = stage(fc.horizon_rows(boosted_rows(spark, d), H, columns=bo.BoostedForecaster.columns), "boosted-horizons")
    boosted = cal.fit_and_test(rows, ["horizon_days"], forecaster=bo.BoostedForecaster())[1]
    baseline = cal.fit_and_test(rows, ["horizon_days"])[1]
    return _against_baseline(stage(boosted, "boosted-predictions"), baseline, ["horizon_days"])


@query
def boosted_save_load(spark, d):
    """A saved and loaded model with its parameters gives the same forecasts, digit by digit."""
    split = stage(_boosted_split(spark, d, [7]), "boosted-split")
    models = bo.BoostedForecaster().fit(split.where("is_train"), ["horizon_days"])
    path = tb.save_boosted(models, {"fuel_col": FUEL, "waiting_cost": 0.003}, working_path(spark, "boosted"))
    loaded, parameters = tb.load_boosted(spark, path)
    test = split.where("not is_train").drop("cutoff", "is_train")
    names = ["pred_q20", "pred_q50", "pred_q80"]
    before, after = (m.predict(test).select("date", "station_id", "price", "target", F.struct(*names).alias(c))
                     for m, c in ((models, "before"), (loaded, "after")))
    return before.join(after.select("date", "station_id", "after"), ["date", "station_id"]).select(
        "date", "station_id", "price", "target", (F.col("before") == F.col("after")).alias("same_forecasts"),
        *[F.lit(v).alias(k) for k, v in parameters.items()])


@query
def boosted_backtest_folds(spark, d):
    """Rolling folds with the full-size model of one horizon, all folds grown together."""
    days = _calendar(spark, d)
    folds = bt.index_folds(days, **ROLLING)
    frame = boosted_rows(spark, d, bt.fold_ends(folds))
    boosted = stage(bt.backtest_predictions(frame, folds, days, [7], forecaster=bo.BoostedForecaster()), "boosted-backtest")
    ordered = F.min((F.col("pred_q20") <= F.col("pred_q50")) & (F.col("pred_q50") <= F.col("pred_q80")))
    return boosted.groupBy("horizon_days", "fold_id", "rows_train").agg(
        F.count("*").alias("rows_test"), ordered.alias("quantiles_in_order"))


@query
def boosted_predict_latest(spark, d):
    """Recommendations of the last day by the full-size model."""
    frame = boosted_rows(spark, d)
    boosted = bo.BoostedForecaster()
    rows = fc.horizon_rows(frame, [3], columns=boosted.columns)
    models = cal.fit_and_test(rows, ["horizon_days"], forecaster=boosted)[0]
    out = cal.predict_latest(frame, models, _last_day(spark, d), 3, 0.001, forecaster=boosted)
    gain = F.col("price") - F.col("pred_q80")
    return out.select(
        "date", "station_id", "price", "regime", "target_min_3d", "realized_wait_gain", "oracle_best_action",
        ((F.col("pred_q20") <= F.col("pred_q50")) & (F.col("pred_q50") <= F.col("pred_q80"))).alias("quantiles_in_order"),
        ((F.col("decision") == "wait") | (gain <= 0.001)).alias("sure_gains_wait"))


# Calibration and backtest --------------------------------------------------------------------

@query
def waiting_cost_sweep(spark, d):
    evaluated = with_policy(with_waiting_costs(_predicted(spark, d), COSTS), "target", F.col("waiting_cost"))
    return rounded(policy_summary(evaluated, ["horizon_days", "waiting_cost"]), *_POLICY)


@query
def calibration_table(spark, d):
    return rounded(cal.calibration_table(staged_rows(spark, d)), *_MEASURES, *_POLICY)


@query
def calibration_table_by_scope(spark, d):
    out = cal.calibration_table(staged_rows(spark, d, ["scope_id"]), scope=["scope_id"])
    return rounded(out, *_MEASURES, *_POLICY)


@query
def calibration_failures(spark, d):
    """A cutoff near the end of the data leaves some horizons without test rows."""
    return cal.calibration_failures(staged_rows(spark, d), H, train_end="2001-11-03").select(
        "horizon_days", "rows_train", "rows_test", "error"
    )


def _calendar(spark, d):
    """The days of the panel as a table: folds, membership and measures all read them."""
    return stage(pn.calendar(*base(spark, d)), "calendar")


@query
def rolling_folds_index(spark, d):
    return bt.index_folds(_calendar(spark, d), **ROLLING)


@query
def rolling_folds_calendar(spark, d):
    rows = fc.eligible(fc.horizon_rows(staged_rows(spark, d), H))
    return bt.calendar_folds(rows, **ROLLING, keys=["horizon_days"])


@query
def fold_membership(spark, d):
    """Rows per fold, training and test, counted through the per-day membership."""
    days = _calendar(spark, d)
    folds = bt.index_folds(days, **ROLLING)
    members = bt.membership(folds, days, H, [], truncate=True).where(F.col("horizon_days") == H[0])
    rows = observed(spark, d).join(F.broadcast(members), "date")
    train = rows.select(F.explode("train").alias("p")).groupBy("p.fold_lo", "p.fold_hi").count().select(
        F.explode(F.sequence("fold_lo", "fold_hi")).alias("fold_id"), F.col("count").alias("rows_train")
    ).groupBy("fold_id").agg(F.sum("rows_train").alias("rows_train"))
    test = rows.select(F.explode("test").alias("p")).groupBy(F.col("p.fold_lo").alias("fold_id")).agg(
        F.count(F.lit(1)).alias("rows_test")
    )
    return train.join(test, "fold_id")


def _index_rows(spark, d, **folds_as):
    """The days, the folds over them, and the model rows with their states per fold."""
    days = _calendar(spark, d)
    folds = bt.index_folds(days, **{**ROLLING, **folds_as})
    return days, folds, staged_rows(spark, d, ends=bt.fold_ends(folds))


def _index_backtest(spark, d, **folds_as):
    days, folds, rows = _index_rows(spark, d, **folds_as)
    return bt.backtest_predictions(rows, folds, days, H, truncate=True), folds


def _calendar_backtest(spark, d):
    rows = staged_rows(spark, d)
    folds = bt.calendar_folds(fc.eligible(fc.horizon_rows(rows, H)), **ROLLING, keys=["horizon_days"])
    return bt.backtest_predictions(rows, folds, _calendar(spark, d), H, truncate=False), folds


@query
def rolling_backtest_folds(spark, d):
    return rounded(bt.fold_metrics(*_index_backtest(spark, d)), *_MEASURES)


@query
def rolling_backtest_short_window(spark, d):
    """Test windows shorter than the horizons: labels near a fold's end see fewer days."""
    return rounded(
        bt.fold_metrics(*_index_backtest(spark, d, test_window=5, step=150, max_folds=None)), *_MEASURES
    )


@query
def rolling_backtest_policy(spark, d):
    return rounded(bt.fold_policy(_index_backtest(spark, d)[0], COSTS), *_POLICY)


_SUMMARY = [
    "avg_policy_realized_saving", "median_policy_realized_saving", "decision_accuracy_vs_oracle", "share_wait",
    "avg_realized_wait_gain", "mae_q20", "mae_q50", "mae_q80", "rmse_q50", "rows_train_mean", "rows_test_mean",
]


def _summary(predicted, folds):
    predicted = stage(predicted, "backtest-predictions")
    return rounded(bt.rolling_summary(bt.fold_metrics(predicted, folds), bt.fold_policy(predicted, COSTS)), *_SUMMARY)


@query
def rolling_backtest_summary(spark, d):
    return _summary(*_index_backtest(spark, d))


@query
def rolling_backtest_calendar_folds(spark, d):
    return rounded(bt.fold_metrics(*_calendar_backtest(spark, d)), *_MEASURES)


@query
def rolling_backtest_calendar_summary(spark, d):
    return _summary(*_calendar_backtest(spark, d))


@query
def rolling_backtest_failures(spark, d):
    """Folds at the very end of the data leave the last days without a known target."""
    days = _calendar(spark, d)
    predicted, folds = _index_backtest(spark, d, min_train=2490, test_window=2, step=2, max_folds=None)
    return bt.backtest_failures(folds, bt.fold_metrics(predicted, folds), H)


# Selection -----------------------------------------------------------------------------------

@query
def rank_configs(spark, d):
    table = rounded(cal.calibration_table(staged_rows(spark, d)), *_MEASURES, *_POLICY)
    return sel.rank_configs(table).select("position", "horizon_days", "waiting_cost", *_POLICY, "mae_q50")


@query
def rank_configs_bounded(spark, d):
    table = rounded(cal.calibration_table(staged_rows(spark, d)), *_MEASURES, *_POLICY)
    return sel.rank_configs(table, "decision_accuracy_vs_oracle", 0.1, 0.6).select(
        "position", "horizon_days", "waiting_cost", "decision_accuracy_vs_oracle", "share_wait"
    )


@query
def best_config(spark, d):
    rows = staged_rows(spark, d)
    days = _calendar(spark, d)
    table = rounded(cal.calibration_table(rows), *_MEASURES, *_POLICY)
    folds = bt.index_folds(days, **ROLLING)
    rolling_table = _summary(bt.backtest_predictions(rows, folds, days, H), folds)
    return sel.best_configs(table, rolling_table)


def _production(spark, d):
    """A production row per scope, with the version numbers a history of changes would leave."""
    n = F.conv(F.substring(F.md5("scope_id"), 1, 2), 16, 10).cast("int")
    return star.stations(spark, d).select("scope_id").distinct().select(
        "scope_id", F.lit(FUEL).alias("fuel_col"), F.lit(3).alias("horizon_days"), F.lit(0.001).alias("waiting_cost"),
        F.lit(dt.date(2001, 1, 1)).alias("selected_on"), F.lit("manual").alias("selection_method"),
        F.concat(F.lit("v"), (n % 5 + 1).cast("string")).alias("version"),
    )


def _candidates(spark, d):
    table = cal.calibration_table(staged_rows(spark, d, ["scope_id"]), scope=["scope_id"])
    best = sel.best_configs(rounded(table, *_MEASURES, *_POLICY), keys=["scope_id"])
    return sel.candidates(best.withColumn("fuel_col", F.lit(FUEL)), _production(spark, d), AS_OF, "run-1")


@query
def candidate_records(spark, d):
    return _candidates(spark, d).select(
        "scope_id", "fuel_col", "horizon_days", "waiting_cost", "selected_on", "selection_method", "based_on_run",
        F.col("current_production.version").alias("current_version"), "metrics.share_wait",
        "metrics.avg_policy_realized_saving",
    )


@query
def promotion_gate(spark, d):
    return sel.promotion_gate(_candidates(spark, d), (0.1, 0.6)).select(
        "scope_id", "approved", F.array_join("reasons", ",").alias("reasons")
    )


@query
def promote_production(spark, d):
    gated = stage(sel.promotion_gate(_candidates(spark, d), (0.1, 0.6)), "gated")
    return sel.promote(_production(spark, d), gated)


@query
def search_grid(spark, d):
    """Grid of every station's fuels: own candidates for some metrics, the defaults for the others."""
    metrics = star.prices(spark, d).select(F.explode(F.array(*[
        F.when(F.col(m).isNotNull(), F.lit(m)) for m in METRICS
    ])).alias("fuel_col")).where("fuel_col is not null").distinct()
    space = metrics.where(F.col("fuel_col").startswith("precio_gasoleo")).select(
        "fuel_col", F.array(*[F.lit(h) for h in (3, 7)]).alias("horizon_candidates"),
        F.when(F.col("fuel_col") == FUEL, F.array(F.lit(0.001), F.lit(0.002))).alias("waiting_cost_candidates"),
    )
    defaults = spark.range(1).select(
        F.array(*[F.lit(h) for h in H]).alias("horizon_candidates"),
        F.array(*[F.lit(c) for c in COSTS]).alias("waiting_cost_candidates"),
    )
    return sel.search_grid(space, defaults, metrics)


# Publication ---------------------------------------------------------------------------------

def _daily(spark, d):
    p, s = base(spark, d)
    scopes = s.select("scope_id", "municipality", "province").distinct()
    return daily_run(p, s, scopes, _production(spark, d), FUEL, generated_at="2002-01-01T00:00:00+00:00", stage=stage)


@query
def daily_run_latest(spark, d):
    return rounded(_daily(spark, d).latest, "pred_q20", "pred_q50", "pred_q80")


@query
def publish_summary(spark, d):
    return _daily(spark, d).summary


@query
def publish_payload_stations(spark, d):
    """The station lines read back, with the summary of their scope's document."""
    run = _daily(spark, d)
    head = run.payloads.select("scope_id", F.from_json("payload", "summary struct<recommendation:string,n_stations:bigint>").alias("p"))
    lines = run.stations.select("scope_id", F.from_json("line", "station_id string, price double, decision string").alias("s"))
    return lines.join(head, "scope_id").select("scope_id", "p.summary.recommendation", "p.summary.n_stations", "s.*")


@query
def publish_payload_json(spark, d):
    """The summary documents parsed back."""
    summary = (
        "recommendation:string,n_stations:bigint,n_buy_now:bigint,n_wait:bigint,selected_station_id:string,"
        "selected_station_price:double,cheapest_station_id:string,cheapest_station_price:double"
    )
    document = f"scope_id string, fuel_col string, model struct<horizon_days:int,waiting_cost:double>, summary struct<{summary}>"
    return _daily(spark, d).payloads.select(F.from_json("payload", document).alias("p")).select(
        "p.scope_id", "p.fuel_col", "p.model.horizon_days", "p.model.waiting_cost", "p.summary.*")


SECOND_FUEL = METRICS[3]


def _production_of_fuels(spark, d):
    """Production rows of two fuels per scope, each with a horizon and waiting cost of its own."""
    own = _production(spark, d)
    other = own.withColumns({"fuel_col": F.lit(SECOND_FUEL), "horizon_days": F.lit(7), "waiting_cost": F.lit(0.002)})
    return own.unionByName(other)


def _daily_of_fuels(spark, d):
    p, s = base(spark, d)
    scopes = s.select("scope_id", "municipality", "province").distinct()
    return daily_run(p, s, scopes, _production_of_fuels(spark, d), generated_at="2002-01-01T00:00:00+00:00", stage=stage)


@query
def daily_run_all_fuels(spark, d):
    """Recommendations of the last day for every scope and fuel, with the pairs that cannot be fitted counted beside them."""
    run = _daily_of_fuels(spark, d)
    out = run.latest.join(F.broadcast(run.failures.agg(F.count("*").alias("failed_pairs"))), F.lit(True))
    return rounded(out, "pred_q20", "pred_q50", "pred_q80")


@query
def published_feed(spark, d):
    """Two versions begun, one of them completed: readers see the feed, documents and station lines of that one."""
    run, folder = _daily_of_fuels(spark, d), working_path(spark, "published")
    pub.write_version(run.payloads, run.stations, folder, 1)
    pub.commit_version(spark, folder, 1, "2002-01-01T00:00:00+00:00")
    pub.write_version(run.payloads.limit(1), run.stations.limit(1), folder, 2)  # broken off before it is named
    newest = pub.published_version(spark, folder)
    summary = "summary struct<recommendation:string,n_stations:bigint,n_buy_now:bigint,n_wait:bigint>"
    document = f"model struct<horizon_days:int,waiting_cost:double>, {summary}, artifacts struct<stations:string>"
    feed = pub.read_published(spark, folder, "feed").select("scope_id", "fuel_col", F.from_json("payload", document).alias("p"))
    lines = pub.read_published(spark, folder, "stations").withColumn(
        "path", F.regexp_extract(F.input_file_name(), r"v1/(stations/scope_id=[^/]+/fuel_col=[^/]+)", 1))
    lines = lines.groupBy("scope_id", "fuel_col").agg(F.count("*").alias("station_lines"), F.first("path").alias("path"))
    return feed.join(lines, ["scope_id", "fuel_col"]).select(
        "scope_id", "fuel_col", F.lit(newest["version"]).alias("version"), F.lit(newest["documents"]).alias("documents"),
        "p.model.horizon_days", "p.model.waiting_cost", "p.summary.recommendation", "p.summary.n_stations", "p.summary.n_buy_now",
        "p.summary.n_wait", "station_lines", (F.col("path") == F.col("p.artifacts.stations")).alias("artifact_found"))


def _config_folder(spark, d) -> str:
    """Scopes, production and policy as configuration documents."""
    folder = working_path(spark, "config")
    scopes = star.stations(spark, d).select("scope_id", "municipality", "province").distinct()
    rows = {"scopes": scopes, "models": _production(spark, d)}
    for name, df in rows.items():
        df.agg(F.to_json(F.struct(F.collect_list(F.struct(*df.columns)).alias(name))).alias("value")).write.text(f"{folder}/{name}")
    policy = F.struct(F.array(F.lit(0.1), F.lit(0.6)).alias("share_wait_between"), F.lit(0.05).alias("min_relative_gain_saving"),
                      F.lit(0.02).alias("max_accuracy_drop"))
    spark.range(1).select(F.to_json(F.struct(policy.alias("promote_if"))).alias("value")).write.text(f"{folder}/policy")
    return folder


@query
def promotion_from_policy(spark, d):
    """Scopes, production and policy read from files; candidates judged against what is in production; a second, stale
    round of the same candidates is turned away by the versions."""
    config, store = _config_folder(spark, d), working_path(spark, "production")
    scopes, policy = tb.read_scopes(spark, f"{config}/scopes"), tb.read_promotion_policy(spark, f"{config}/policy").first()
    production = tb.read_production(spark, f"{config}/models").join(scopes.select("scope_id"), "scope_id", "left_semi")
    sel.append_production(production, store)
    table = stage(rounded(cal.calibration_table(staged_rows(spark, d, ["scope_id"]), scope=["scope_id"]), *_MEASURES, *_POLICY), "calibration")
    best = sel.best_configs(table, keys=["scope_id"])
    candidates = sel.candidates(best.withColumn("fuel_col", F.lit(FUEL)), sel.current_production(spark, store), AS_OF, "run-1")
    now = production.select("scope_id", "fuel_col", "horizon_days", "waiting_cost").join(table, ["scope_id", "horizon_days", "waiting_cost"]).select(
        "scope_id", "fuel_col", F.col("avg_policy_realized_saving").alias("current_saving"),
        F.col("decision_accuracy_vs_oracle").alias("current_accuracy"))
    gated = stage(sel.promotion_gate(
        candidates, tuple(policy["share_wait_between"]), policy["min_relative_gain_saving"], policy["max_accuracy_drop"], now), "gated")
    first = sel.promote_if_current(spark, store, gated).withColumnRenamed("outcome", "first_outcome")
    second = sel.promote_if_current(spark, store, gated).withColumnRenamed("outcome", "second_outcome")
    pair = ["scope_id", "fuel_col"]
    return sel.current_production(spark, store).join(gated.select(*pair, F.array_join("reasons", ",").alias("reasons")), pair).join(
        first, pair).join(second, pair).select(
        *pair, "horizon_days", "waiting_cost", "version", "reasons", "first_outcome", "second_outcome")


@query
def json_null_clean(spark, d):
    """Values that JSON cannot hold, through the document and back."""
    x = (
        F.when(F.col("l_linenumber") == 1, F.lit(float("nan")))
        .when(F.col("l_linenumber") == 2, F.lit(float("inf")))
        .when(F.col("l_linenumber") == 3, F.lit(float("-inf")))
        .otherwise(F.col("l_extendedprice"))
    )
    rows = star.read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", x.alias("x"), F.array(x, F.lit(1.5)).alias("xs")
    )
    text = F.to_json(F.struct("x", "xs"), {"ignoreNullFields": "false"})
    back = F.from_json(text, "x double, xs array<double>")
    return pub.json_ready(rows).withColumn("j", back).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "j.x", F.get("j.xs", F.lit(0)).alias("x0"),
        F.contains(text, F.lit('"x":null')).cast("int").alias("has_null"),
    )


# Ingest --------------------------------------------------------------------------------------

def _line_batch(spark, d):
    """Lines as price records of their own: many per (date, station), in a fixed sequence."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    none = {m: F.lit(None).cast("double") for m in METRICS[1:]}
    return star.read(spark, d, "lineitem").where("l_linenumber >= 4").select(
        F.col("l_shipdate").cast("date").alias("date"), F.expr("timestamp '2002-01-02 00:00:00'").alias("fetched_at"),
        F.col("l_suppkey").cast("string").alias("station_id"), star.quote(cents, F.lit(1)).alias(FUEL),
        *[c.alias(m) for m, c in none.items()], "l_orderkey", "l_linenumber", cents.alias("cents"),
    )


@query
def upsert_prices(spark, d):
    """The later batch wins, its last record per key, NULLs included."""
    current = star.prices(spark, d, "l_linenumber <= 4")
    return up.upsert_prices(current, _line_batch(spark, d), ["l_orderkey", "l_linenumber", "cents"])


@query
def upsert_stations(spark, d):
    current = star.stations(spark, d).drop("scope_id")
    batch = star.read(spark, d, "lineitem").where("l_quantity > 45 and l_suppkey % 3 = 0").select(
        F.col("l_suppkey").cast("string").alias("station_id"),
        F.concat_ws("-", F.lit("Line"), "l_orderkey", "l_linenumber").alias("station_name"),
        F.lit("Calle 1").alias("address"), F.lit(None).cast("string").alias("municipality"),
        F.lit("P").alias("province"), F.lit(1.5).alias("latitude"), F.lit(-1.5).alias("longitude"),
        F.lit("24H").alias("schedule"), "l_orderkey", "l_linenumber",
    )
    return up.upsert_stations(current, batch, ["l_orderkey", "l_linenumber"], now()).drop("latitude", "longitude")


def _patchy_log(spark, d):
    """The log with every seventh day of a month failed and nothing known from 2001 on."""
    failed = F.dayofmonth("date") % 7 == 0
    return star.fetch_log(spark, d).where(F.year("date") < 2001).withColumns({
        "status": F.when(failed, "failed").otherwise(F.col("status")),
        "records_count": F.when(failed, F.lit(0)).otherwise(F.col("records_count")),
        "error_type": F.when(failed, F.lit("IOError")),
    })


@query
def upsert_fetch_log(spark, d):
    batch = star.fetch_log(spark, d).where(F.year("date") >= 2000).withColumns(
        {"created_at": now(), "updated_at": now()}
    )
    return up.upsert_fetch_log(_patchy_log(spark, d), batch)


@query
def fetch_log_range(spark, d):
    return up.fetch_log_range(_patchy_log(spark, d), "1998-01-01", "2000-06-30").select(
        "date", "status", "records_count", F.col("status").isin(*up.PROCESSED).cast("int").alias("processed")
    )


def _bootstrap(spark, d, overwrite):
    return up.bootstrap_fetch_log(
        star.prices(spark, d), _patchy_log(spark, d), now(), "1998-01-01", "2001-12-31", overwrite
    )


@query
def bootstrap_fetch_log(spark, d):
    return _bootstrap(spark, d, False)[0]


@query
def bootstrap_fetch_log_overwrite(spark, d):
    return _bootstrap(spark, d, True)[0]


@query
def bootstrap_counts(spark, d):
    return _bootstrap(spark, d, False)[1].unionByName(_bootstrap(spark, d, True)[1])


@query
def missing_dates(spark, d):
    log = _patchy_log(spark, d)
    return up.missing_dates(up.requested_days(log, "1994-12-01", "2001-12-31"), log)


def _collected(spark, d, **options):
    log = _patchy_log(spark, d)
    records = star.prices(spark, d).where(F.dayofweek("date") > 1)  # nothing arrives on Sundays
    failures = star.prices(spark, d).where(F.dayofmonth("date") == 13).select(
        "date", F.lit("IOError").alias("error_type"), F.lit("broken file").alias("error_message")
    )
    return up.collection_results(
        up.requested_days(log, "2000-06-01", "2001-12-31"), log, records, failures, **options
    )


@query
def collect_dates(spark, d):
    return _collected(spark, d)


@query
def collect_dates_forced(spark, d):
    return _collected(spark, d, force=True, allow_empty=False)


@query
def collection_summary(spark, d):
    return up.collection_summary(_collected(spark, d)).select(
        "start_date", "end_date", "requested_dates", "processed_dates", "fetched_dates", "skipped_dates",
        "empty_dates", "failed_dates", "inserted_rows", F.size("errors").alias("n_errors"),
        F.get("errors", F.lit(0))["date"].alias("first_error"),
    )


@query
def fallback_source(spark, d):
    s = star.stations(spark, d).select("station_id", "municipality")
    primary = star.prices(spark, d, "l_linenumber <= 2").join(s, "station_id").where("municipality = 'NATION_1'")
    province = star.prices(spark, d).join(s.withColumn("municipality", F.lower("municipality")), "station_id")
    both = lk.with_fallback(
        primary.select("date", "station_id", "municipality", FUEL),
        province.select("date", "station_id", "municipality", FUEL), municipality="Nátion_1",
    )
    return both.select("date", "station_id", FUEL, F.lower("municipality").alias("municipality"))


@query
def lookup_municipality(spark, d):
    supplier, customer, nation = (star.read(spark, d, t) for t in ("supplier", "customer", "nation"))
    catalog = supplier.join(F.broadcast(nation), supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").cast("string").alias("municipality_id"),
        F.concat(F.lit(" Villá "), F.floor(F.col("s_suppkey") / 3).cast("string")).alias("municipality"),
        F.col("n_name").alias("province"), F.col("s_suppkey").alias("position"),
    )
    requests = customer.select(
        F.concat(F.lit("VILLA "), (F.col("c_custkey") % 60).cast("string"), F.lit(" ")).alias("name"),
        F.concat(F.lit("Nation_"), (F.col("c_custkey") % 7).cast("string")).alias("province"),
    )
    return lk.find_municipalities(requests, catalog)


@query
def lookup_province(spark, d):
    catalog = star.read(spark, d, "supplier").select(
        F.when(F.col("s_suppkey") % 3 == 0, F.lit("")).when(F.col("s_suppkey") % 3 == 1, F.col("s_suppkey").cast("string")).alias("IDPovincia"),
        F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("IDProvincia"),
        F.concat(F.lit("Peñón "), (F.col("s_suppkey") % 50).cast("string")).alias("province"), F.col("s_suppkey").alias("position"),
    )
    requests = star.read(spark, d, "customer").select(F.concat(F.lit(" PENON "), (F.col("c_custkey") % 70).cast("string")).alias("name"))
    return lk.find_provinces(requests, catalog)


def _cents(column="l_extendedprice"):
    return F.round(F.col(column) * 100).cast("bigint")


@query
def decimal_comma_parse(spark, d):
    cents = _cents()
    number = F.concat((cents / 100).cast("bigint").cast("string"), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))
    text = (
        F.when(F.col("l_orderkey") % 17 == 0, F.lit("  "))
        .when(F.col("l_orderkey") % 19 == 0, F.lit("n/d"))
        .when(F.col("l_orderkey") % 23 == 0, F.lit("1.234,5"))
        .when(F.col("l_orderkey") % 29 == 0, F.concat(number, F.lit("d")))
        .otherwise(F.concat(F.lit(" \t"), number, F.lit(" \n")))
    )
    return star.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.alias("raw")).withColumn(
        "value", tx.decimal_comma("raw")
    ).drop("raw")


@query
def numeric_coerce(spark, d):
    text = F.when(F.col("l_linenumber") == 1, F.lit("NaN")).when(F.col("l_linenumber") == 2, F.lit("abc")).otherwise(
        F.col("l_quantity").cast("string")
    )
    return star.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", tx.to_number(text).alias("value"))


@query
def name_normalize(spark, d):
    text = F.concat(F.lit("  Estación ÑÜ "), F.col("l_suppkey").cast("string"), F.lit(" "), F.col("l_linestatus"), F.lit(" Àö\t"))
    return star.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", tx.normalized_name(text).alias("name"))


@query
def column_name_normalize(spark, d):
    text = F.concat(F.lit("-- Precio "), F.col("l_returnflag"), F.lit(" ("), F.col("l_linenumber").cast("string"), F.lit(") E5 --"))
    return star.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", tx.column_name(text).alias("name"))


@query
def date_normalize(spark, d):
    day = F.col("l_shipdate").cast("date")
    text = (
        F.when(F.col("l_linenumber") == 1, F.date_format(day, "yyyy-M-d"))
        .when(F.col("l_linenumber") == 2, F.date_format(day, "dd/MM/yyyy"))
        .when(F.col("l_linenumber") == 3, F.concat(F.date_format(day, "yyyy"), F.lit("-02-30")))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    return star.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", tx.strict_date(text).alias("date")).withColumn(
        "api_date", tx.api_date("date")
    )


@query
def version_bump(spark, d):
    text = F.when(F.col("l_linenumber") == 1, F.lit("v")).when(F.col("l_linenumber") == 2, F.lit(None)).otherwise(
        F.concat(F.lit("v"), F.col("l_suppkey").cast("string"))
    )
    return star.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", tx.next_version(text).alias("version"))


def comma_text(column: str):
    """A price in whole thousandths as feed text, empty where missing."""
    mills = F.round(F.col(column) * 1000).cast("bigint")
    text = F.concat(F.floor(mills / 1000).cast("string"), F.lit(","), F.lpad((mills % 1000).cast("string"), 3, "0"))
    return F.coalesce(text, F.lit(""))


def feed_documents(spark, d) -> DataFrame:
    """Feed documents of the price table, one per (date, station), half of them in the envelope."""
    n = F.col("station_id").cast("int")
    long_key = F.when(n % 3 != 0, F.concat(F.lit("-1,"), F.lpad(F.col("station_id"), 6, "0")))
    record = F.struct(
        F.col("station_id").alias("IDEESS"), F.concat(F.lit(" "), F.col("station_name"), F.lit(" ")).alias("Rótulo"),
        F.lit("").alias("Dirección"), F.col("municipality").alias("Municipio"), F.col("province").alias("Provincia"),
        F.lit("37,5").alias("Latitud"), long_key.alias("Longitud (WGS84)"), F.lit("2,25").alias("Longitud"),
        F.lit(" L-D: 24H ").alias("Horario"),
        *[comma_text(m).alias(f) for m, f in zip(METRICS, feed.PRICE_FIELDS)],
    )
    listed = F.to_json(F.array(record))
    enveloped = F.to_json(F.struct(F.array(record).alias(feed.ENVELOPE_KEY), F.lit("OK").alias("ResultadoConsulta")))
    rows = star.prices(spark, d).join(star.stations(spark, d).drop("scope_id"), "station_id")
    return rows.select("date", F.when(n % 2 == 0, enveloped).otherwise(listed).alias("value"), "station_id")


@query
def raw_feed_normalize(spark, d):
    raw = feed.raw_records(feed_documents(spark, d).drop("station_id"))
    return feed.parse_records(raw, F.expr(star.FETCHED_AT)).drop("position", "fetched_at")


@query
def history_roundtrip(spark, d):
    """The tables as history CSVs, imported again: prices joined to their stations."""
    p, s = base(spark, d)
    folder = working_path(spark, "history")
    tb.export_history({"prices": p, "stations": s, "fetch_log": star.fetch_log(spark, d)}, folder)
    paths = tb.import_history(spark, folder, working_path(spark, "tables"))
    prices = spark.read.parquet(paths["prices"])
    stations = spark.read.parquet(paths["stations"])
    log = spark.read.parquet(paths["fetch_log"])
    return pn.station_panel(prices, stations, log).select(
        "date", "station_id", "station_name", "municipality", *METRICS, "fetch_status"
    )


@query
def model_save_load(spark, d):
    models = fc.fit(_split(spark, d).where("is_train"), ["horizon_days"])
    path = tb.save_models(models, {"fuel_col": FUEL, "waiting_cost": 0.003}, working_path(spark, "models"))
    loaded, parameters = tb.load_models(spark, path)
    out = loaded.withColumns({k: F.lit(v) for k, v in parameters.items()})
    return rounded(out, "diff_q20", "diff_q50", "diff_q80")


#: Lines of the star schema for which the feed's least number of files holds; a larger feed lands in as many times more.
LINES_LANDED = 250_000


def _more_files(spark, d) -> int:
    """How many times the least number of files a feed of this size lands in, so that no file grows with the tables."""
    return max(1, -(-star.read(spark, d, "lineitem").count() // LINES_LANDED))


def _land(documents: DataFrame, files: int, *by: str) -> str:
    """Documents as ``files`` compressed bundles dealt out by ``by``. One task writes a bundle, and none can split it: they must stay small."""
    landing = working_path(documents.sparkSession, "landing")
    documents.repartition(files, *by).select("date", "value").write.option("compression", "gzip").json(landing)
    return landing


@query
def stream_ingest(spark, d):
    """Documents landed as bundles, taken in as a stream in several batches, read back as the current
    price table."""
    from quotegrid.streaming.ingest import current_table, ingest

    more, store = _more_files(spark, d), working_path(spark, "store")
    landing = _land(feed_documents(spark, d).select(F.col("date").cast("string").alias("date"), "value"), 8 * more, "date")
    ingest(spark, landing, store, files_per_batch=4 * more, layout="bundles")
    return current_table(spark, store, "prices").drop("fetched_at")


def _split_landing(spark, d, more: int) -> str:
    """The feed landed so that each day lies in several files, some days unreadable, some documents broken."""
    n = F.col("station_id").cast("int")
    docs = feed_documents(spark, d).withColumn("part", F.pmod(n, F.lit(5)))
    day = F.col("date").cast("string")
    bad_day = F.when((n % 11 == 3), F.concat(F.lit("day "), day)).otherwise(day)
    broken = F.when(n % 13 == 5, F.lit("{broken")).otherwise(F.col("value"))
    return _land(docs.select(bad_day.alias("date"), broken.alias("value"), "part"), 5 * more, "part", "date")


@query
def stream_ingest_split_days(spark, d):
    """Every day in several files, fewer files a batch than a day has: the log's records per day against the rows kept."""
    from quotegrid.streaming.ingest import current_fetch_log, current_table, ingest

    more, store = _more_files(spark, d), working_path(spark, "store")
    ingest(spark, _split_landing(spark, d, more), store, files_per_batch=more, layout="bundles")
    kept = current_table(spark, store, "prices").groupBy("date").agg(F.count("*").alias("rows"), F.sum("precio_gasoleo_a").alias("total"))
    log = current_fetch_log(spark, store).select("date", "status", "records_count")
    return log.join(kept, "date", "left").select("date", "status", "records_count", "rows", F.round("total", 3).alias("total"))


@query
def stream_ingest_rejects(spark, d):
    """Documents not taken in, by reason and day as landed."""
    from quotegrid.streaming.ingest import ingest, rejected

    more, store = _more_files(spark, d), working_path(spark, "store")
    ingest(spark, _split_landing(spark, d, more), store, files_per_batch=2 * more, layout="bundles")
    return rejected(spark, store).groupBy("reason", "day").agg(F.count("*").alias("documents"))


# Jobs that write and read back --------------------------------------------------------------

@query
def panel_overlapping_batches(spark, d):
    """Two batches of one period: where both quote a day and station, the one fetched later holds."""
    p, s = base(spark, d)
    later = star.prices(spark, d, "l_linenumber <= 3").withColumn("fetched_at", now())
    return pn.station_panel(
        p.unionByName(later), s, include_metadata=False, drop_all_null=False, full_calendar=True, include_fetch_status=False
    ).drop("fetched_at")


@query
def dataset_export_panel(spark, d):
    p, s = base(spark, d)
    log = star.fetch_log(spark, d)
    path = export_dataset(p, s, log, working_path(spark, "panel") + ".csv", "panel")
    schema = dataset(p, s, log, "panel").schema
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False).select(
        "date", "station_id", "station_name", "municipality", "province", *METRICS, "is_observed_price", "fetch_status"
    )


@query
def dataset_export_daily(spark, d):
    p, s = base(spark, d)
    path = export_dataset(p, s, star.fetch_log(spark, d), working_path(spark, "daily") + ".parquet", "summary")
    return rounded(spark.read.parquet(path), *[f"{m}_{x}" for m in METRICS for x in ("mean", "std")])


@query
def collect_then_export(spark, d):
    """Landed documents are taken in, and the panel of all that was collected is written and read back."""
    from quotegrid.streaming.ingest import ingest_and_export

    path = working_path(spark, "panel") + ".parquet"
    landing = _land(feed_documents(spark, d).select(F.col("date").cast("string").alias("date"), "value"), 8 * _more_files(spark, d), "date")
    ingest_and_export(
        spark, landing, working_path(spark, "store"), lambda p, s, log: dataset(p, s, log, "panel"), path, layout="bundles"
    )
    return spark.read.parquet(path).select("date", "station_id", *METRICS, "is_observed_price")


@query
def experiment_tables_roundtrip(spark, d):
    table = cal.calibration_table(staged_rows(spark, d))
    folder = working_path(spark, "experiments")
    tb.write_results({"calibration": table}, folder, "run-1")
    return rounded(tb.read_results(spark, folder, "calibration"), *_MEASURES, *_POLICY)


@query
def experiment_store(spark, d):
    """All six tables of a calibration and rolling backtest, of two runs and one broken off; what a reader finds of the last whole run."""
    folder = working_path(spark, "experiments")
    days, folds, rows = _index_rows(spark, d)
    predicted = stage(bt.backtest_predictions(rows, folds, days, H, truncate=True), "store-predictions")
    # Several of the tables are made from these, and each is written: they are worked out once.
    metrics = stage(bt.fold_metrics(predicted, folds), "store-folds")
    summary = stage(bt.rolling_summary(metrics, bt.fold_policy(predicted, COSTS)), "store-summary")
    rows = rows.drop("by_end")
    calibration = stage(cal.calibration_table(rows), "store-calibration")
    tables = {
        "calibration": calibration, "calibration_failures": cal.calibration_failures(rows, H, train_end="2001-11-03"),
        "rolling_summary": summary, "rolling_folds": metrics, "rolling_failures": bt.backtest_failures(folds, metrics, H),
        "latest_best": sel.best_configs(calibration, summary),
    }
    tb.write_results({"calibration": calibration.limit(1)}, folder, "run-1")
    tb.write_results(tables, folder, "run-2")
    metrics.limit(2).write.parquet(f"{folder}/rolling_folds/run_id=run-3")  # broken off: not in the registry
    saving = "avg_policy_realized_saving"
    parts = []
    for name in tables:
        found = tb.read_results(spark, folder, name)
        value = F.sum(saving) if saving in found.columns else F.sum("mae_q50") if "mae_q50" in found.columns else F.lit(None).cast("double")
        parts.append(found.agg(F.count("*").alias("rows"), value.alias("total")).select(F.lit(name).alias("name"), "rows", "total"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return rounded(out, "total", digits=6)


@query
def latest_table_roundtrip(spark, d):
    paths = tb.write_results({"latest": _daily(spark, d).latest}, working_path(spark, "results"), "run-1")
    return rounded(spark.read.parquet(paths["latest"]), "pred_q20", "pred_q50", "pred_q80")


@query
def search_grid_from_config(spark, d):
    """The search space as a configuration document, read again: candidates per fuel, defaults for the others."""
    metrics = star.prices(spark, d).select(F.explode(F.array(*[
        F.when(F.col(m).isNotNull(), F.lit(m)) for m in METRICS
    ])).alias("fuel_col")).where("fuel_col is not null").distinct()
    costs = F.when(F.col("fuel_col") == FUEL, F.array(F.lit(0.001), F.lit(0.002)))
    candidates = F.struct(F.array(F.lit(3), F.lit(7)).alias("horizon_candidates"), costs.alias("waiting_cost_candidates"))
    document = metrics.where(F.col("fuel_col").startswith("precio_gasoleo")).agg(F.to_json(F.struct(
        F.array(*[F.lit(h) for h in H]).alias("default_horizon_candidates"),
        F.array(*[F.lit(c) for c in COSTS]).alias("default_waiting_cost_candidates"),
        F.map_from_entries(F.collect_list(F.struct("fuel_col", candidates))).alias("fuel_search_spaces"),
    )).alias("value"))
    path = working_path(spark, "search-space")
    document.write.text(path)
    space, defaults, _ = tb.read_search_space(spark, path)
    return sel.search_grid(space, defaults, metrics)
