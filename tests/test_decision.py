"""Quantiles, policy, selection and publication; published tables as literals."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotegrid.operators import forecast as fc
from quotegrid.operators.histogram import quantiles, running_counts, value_counts
from quotegrid.operators.policy import with_policy
from quotegrid.plans import backtest as bt
from quotegrid.plans import publication as pub
from quotegrid.plans import selection as sel

# A published recommendation table: station, price, regime, three forecasts, decision.
LATEST = [
    ("15366", 1.639, "shock_down", 1.6390566099899533, 1.6699295615762875, 1.671973481322098, "buy_now"),
    ("14016", 1.699, "shock_down", 1.7044119595083422, 1.7294502021350537, 1.7310629936982276, "buy_now"),
    ("10945", 1.802, "shock_down", 1.7920767569181129, 1.7967063287071285, 1.8190170781365256, "buy_now"),
    ("2132", 1.885, "shock_up", 1.8786360718942154, 1.8824811337770648, 1.8979437748551433, "buy_now"),
    ("13562", 1.659, "cyclical", 1.611648330018789, 1.6205351587315584, 1.6475735857414986, "wait"),
    ("14084", 1.679, "cyclical", 1.6576954159586836, 1.6618250843856182, 1.6857272190874535, "wait"),
    ("15740", 1.679, "cyclical", 1.6576954159586836, 1.6589208580073334, 1.6616770409112451, "wait"),
    ("16398", 1.679, "cyclical", 1.6576954159586836, 1.6589208580073334, 1.6622164888773827, "wait"),
    ("15390", 1.7, "cyclical", 1.66276142887399, 1.6877147413881808, 1.7261156011732353, "wait"),
    ("13973", 1.709, "cyclical", 1.6712350614566398, 1.6912859881302347, 1.7304121433187603, "wait"),
    ("4157", 1.829, "cyclical", 1.753451661527698, 1.768545959522775, 1.8373212747756125, "wait"),
    ("4188", 1.829, "cyclical", 1.7507276890579135, 1.7657163971699879, 1.8343491712496407, "wait"),
    ("4232", 1.849, "cyclical", 1.7606065290361643, 1.7695023795224225, 1.8538442908731434, "wait"),
]


@pytest.fixture(scope="module")
def latest(spark):
    df = spark.createDataFrame(
        [(*r[:6], None, r[6]) for r in LATEST],
        "station_id string, price double, regime string, pred_q20 double, pred_q50 double, pred_q80 double, "
        "target double, want string",
    )
    return with_policy(df, "target", 0.001)


def test_published_decisions(latest):
    rows = latest.collect()
    assert len(rows) == 13 and all(r["decision"] == r["want"] for r in rows)
    # an unknown future: a wait saves an unknown amount, buying now saves nothing
    assert all(r["policy_realized_saving"] == (None if r["decision"] == "wait" else 0.0) for r in rows)
    assert {r["oracle_best_action"] for r in rows} == {"buy_now"}


def test_missing_forecasts_fall_through(spark):
    df = spark.createDataFrame(
        [(2.0, "stable", None, 1.0, None), (2.0, "stable", 1.0, None, None), (2.0, "cyclical", 1.0, None, 3.0), (None, "stable", 1.0, 1.0, 1.0)],
        "price double, regime string, pred_q20 double, pred_q50 double, pred_q80 double",
    ).withColumn("target", F.lit(1.5))
    assert [r["decision"] for r in with_policy(df, "target", 0.1).collect()] == ["wait", "buy_now", "wait", "buy_now"]


def test_published_summary_and_payload(spark, latest):
    keyed = latest.drop("want", "target").select(F.lit("alc").alias("scope_id"), F.lit("precio_gasoleo_a").alias("fuel_col"), "*")
    scopes = spark.createDataFrame([("alc", "A", "M"), ("none", "B", "M")], "scope_id string, municipality string, province string")
    models = spark.createDataFrame(
        [(s, "precio_gasoleo_a", 3, 0.001, dt.date(2026, 3, 24), "rolling_backtest", "v1") for s in ("alc", "none")],
        "scope_id string, fuel_col string, horizon_days int, waiting_cost double, selected_on date, selection_method string, version string",
    )
    documents = {r["scope_id"]: json.loads(r["payload"]) for r in pub.payloads(keyed, scopes, models, "now").collect()}
    summary = documents["alc"]["summary"]
    assert (summary["n_stations"], summary["n_buy_now"], summary["n_wait"]) == (13, 4, 9)
    assert (summary["recommendation"], summary["selected_station_id"], summary["selected_station_price"]) == ("buy_now", "15366", 1.639)
    assert documents["none"]["summary"]["recommendation"] == "no_data"
    lines = [json.loads(r["line"]) for r in pub.station_lines(keyed).where("scope_id = 'alc'").collect()]
    assert sorted(x["station_id"] for x in lines) == sorted(r[0] for r in LATEST)
    assert all(x["policy_realized_saving"] is None or isinstance(x["policy_realized_saving"], float) for x in lines)


def test_stations_without_a_price_come_last(spark):
    rows = [("s", "f", "1", None, "buy_now"), ("s", "f", "2", 1.5, "wait"), ("s", "f", "3", 1.6, "buy_now"), ("t", "f", "4", None, "buy_now")]
    df = spark.createDataFrame(rows, "scope_id string, fuel_col string, station_id string, price double, decision string")
    got = {r["scope_id"]: r for r in pub.publish_summary(df).collect()}
    assert (got["s"]["cheapest_station_id"], got["s"]["selected_station_id"]) == ("2", "3")
    assert got["t"]["selected_station_id"] == "4" and got["t"]["selected_station_price"] is None


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    values = {"a": np.round(rng.normal(0, 0.05, 999), 3), "b": np.array([0.25]), "hot": np.r_[np.zeros(500), rng.normal(0, 3, 300)]}
    df = spark.createDataFrame([(k, float(v)) for k, vs in values.items() for v in vs], "k string, v double")
    ranked = running_counts(value_counts(df, ["k"], "v"), ["k"], "v")
    for r in quantiles(ranked, ["k"], "v", {"q20": 0.2, "q50": 0.5, "q80": 0.8}).collect():
        np.testing.assert_allclose([r["q20"], r["q50"], r["q80"]], np.quantile(values[r["k"]], [0.2, 0.5, 0.8]), atol=1e-12)


def test_regime_model_needs_enough_rows(spark):
    rows = [(7, "stable", 1.0, 1.0 + i / 1000) for i in range(149)] + [(7, "cyclical", 1.0, 0.5)] * 150
    df = spark.createDataFrame(rows, "horizon_days int, regime string, price double, target double")
    models = fc.fit(df, ["horizon_days"])
    assert {r["model_key"] for r in models.collect()} == {"__global__", "cyclical"}
    new = spark.createDataFrame([(7, None, 2.0), (7, "cyclical", 2.0)], "horizon_days int, regime string, price double")
    got = {r["regime"]: r for r in fc.predict(new, models, ["horizon_days"]).collect()}
    assert got["cyclical"]["pred_q50"] == 1.5 and got[None]["pred_q80"] > got[None]["pred_q20"]


def test_rows_without_price_are_kept_for_the_last_day_only(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "a", None, "stable", 1, [1.0])],
                               "date date, station_id string, price double, regime string, is_observed_price int, ahead array<double>")
    rows = fc.horizon_rows(df, [1])
    assert rows.count() == 1 and fc.eligible(rows).count() == 0


@pytest.mark.parametrize("settings", [(10, 5, 3, None), (10, 5, 3, 4), (40, 5, 3, None)])
def test_index_folds(spark, settings):
    min_train, window, step, most = settings
    days = sorted({dt.date(2024, 1, 1) + dt.timedelta(days=int(d)) for d in np.cumsum(np.random.default_rng(3).integers(1, 4, 36))})
    want, i = [], min_train
    while i < len(days) and (most is None or len(want) < most):
        inside = [d for d in days if days[i] <= d <= days[i] + dt.timedelta(days=window - 1)]
        want.append((len(want) + 1, days[i - 1], days[i], max(inside)))
        i += step
    df = spark.createDataFrame([(d,) for d in days], "date date")
    got = [tuple(r) for r in bt.index_folds(df, min_train, window, step, most).orderBy("fold_id").collect()]
    assert got == want


def test_calendar_folds_keep_the_last(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 12, 31),)], "date date")
    got = bt.calendar_folds(df, 100, 30, 30, 3).orderBy("fold_id").collect()
    cut, cutoffs = dt.date(2024, 1, 1) + dt.timedelta(days=100), []
    while cut <= dt.date(2024, 12, 31) - dt.timedelta(days=30):
        cutoffs.append(cut)
        cut += dt.timedelta(days=30)
    assert [r["train_end"] for r in got] == cutoffs[-3:] and [r["fold_id"] for r in got] == [1, 2, 3]
    assert bt.calendar_folds(df, 360, 30, 30).count() == 0


def test_promotion(spark):
    best = spark.createDataFrame(
        [("a", "f", 14, 0.002, 0.01, 0.6, 0.5, 0.02, "rolling_backtest"), ("b", "f", 7, 0.002, 0.01, 0.6, 0.9, 0.02, "temporal_split"),
         ("c", "f", 7, 0.002, None, None, 0.5, 0.02, "temporal_split")],
        "scope_id string, fuel_col string, horizon_days int, waiting_cost double, avg_policy_realized_saving double, "
        "decision_accuracy_vs_oracle double, share_wait double, mae_q50 double, selection_method string",
    )
    production = spark.createDataFrame(
        [(s, "f", 3, 0.001, dt.date(2020, 1, 1), "manual", "v9", "note") for s in "abcd"],
        "scope_id string, fuel_col string, horizon_days int, waiting_cost double, selected_on date, selection_method string, version string, notes string",
    )
    gated = sel.promotion_gate(sel.candidates(best, production, dt.date(2026, 1, 1), "r"), (0.1, 0.6))
    reasons = {r["scope_id"]: r["reasons"] for r in gated.collect()}
    assert reasons == {"a": [], "b": ["share_wait_out_of_range"], "c": ["missing_saving", "missing_accuracy"]}
    after = {r["scope_id"]: r for r in sel.promote(production, gated).collect()}
    assert after["a"]["version"] == "v10" and after["a"]["horizon_days"] == 14 and after["a"]["notes"] == "note"
    assert [after[s]["version"] for s in "bcd"] == ["v9"] * 3


def test_rows_are_counted_once_for_all_branches_of_a_fit(spark):
    rows = spark.createDataFrame([(3, "stable", 1.0, 0.9), (3, "shock_up", 1.0, 0.8)] * 200, "horizon_days int, regime string, price double, target double")
    models = fc.fit(rows, ["horizon_days"])
    assert models.count() == 3 and all("difference-counts" in f for f in models.inputFiles())
    folds = rows.withColumns({"fold_lo": F.lit(1), "fold_hi": F.lit(2)})
    models = fc.DifferenceForecaster().fit(folds, ["horizon_days"])
    assert models.count() == 6 and all("difference-counts" in f for f in models.inputFiles())
