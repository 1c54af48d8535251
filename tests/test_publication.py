"""Versions on files, the production table, the run registry, and the daily run over several fuels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotegrid import catalog
from quotegrid.operators.boosting import BoostedForecaster, BoostingSettings
from quotegrid.plans import publication as pub
from quotegrid.plans import selection as sel
from quotegrid.plans.daily import daily_run
from quotegrid.schema import METRICS, PRICES
from quotegrid.session import stage
from quotegrid.sources import tables as tb

DAY = dt.date(2024, 1, 1)
A, B, C = METRICS[0], METRICS[3], METRICS[7]


@pytest.fixture(scope="module")
def base(spark):
    """Two scopes of three stations; fuel B is quoted in the first scope only, fuel C nowhere."""
    rows = []
    for i in range(80):
        for s in range(6):
            price = 1.5 + 0.01 * ((i * 7 + s * 3) % 11)
            rows.append((DAY + dt.timedelta(i), None, f"s{s}", *[price if m == A or (m == B and s < 3) else None for m in METRICS]))
    prices = spark.createDataFrame(rows, PRICES)
    stations = spark.createDataFrame([(f"s{s}", "one" if s < 3 else "two") for s in range(6)], "station_id string, scope_id string")
    scopes = spark.createDataFrame([("one", "m1", "p"), ("two", "m2", "p")], "scope_id string, municipality string, province string")
    production = spark.createDataFrame(
        [(s, f, h, 0.001, dt.date(2024, 1, 1), "manual", "v1") for s in ("one", "two") for f, h in ((A, 3), (B, 7), (C, 3))],
        "scope_id string, fuel_col string, horizon_days int, waiting_cost double, selected_on date, selection_method string, version string")
    return prices, stations, scopes, production


def test_fuels_side_by_side_and_failures_apart(base):
    prices, stations, scopes, production = base
    run = daily_run(prices, stations, scopes, production)
    got = {(r["scope_id"], r["fuel_col"]): r["count"] for r in run.latest.groupBy("scope_id", "fuel_col").count().collect()}
    assert got == {("one", A): 3, ("two", A): 3, ("one", B): 3}
    failed = {(r["scope_id"], r["fuel_col"]): r["error"] for r in run.failures.collect()}
    assert failed == {("two", B): "no_eligible_rows", ("one", C): "no_eligible_rows", ("two", C): "no_eligible_rows"}
    summary = {(r["scope_id"], r["fuel_col"]): r["recommendation"] for r in run.summary.collect()}
    assert summary[("two", B)] == summary[("one", C)] == "no_data" and summary[("one", A)] in ("wait", "buy_now")


def test_one_fuel_alone_gives_the_same(base):
    prices, stations, scopes, production = base
    every = daily_run(prices, stations, scopes, production).latest.where(F.col("fuel_col") == A)
    alone = daily_run(prices, stations, scopes, production, A).latest
    assert alone.exceptAll(every).count() == 0 and alone.count() == every.count() == 6
    with pytest.raises(ValueError):
        daily_run(prices, stations, scopes, production, "unknown")


def test_daily_run_with_the_boosted_model(base):
    prices, stations, scopes, production = base
    boosted = BoostedForecaster(BoostingSettings(rounds=3))
    run = daily_run(prices, stations, scopes, production.where("scope_id = 'one'"), A, forecaster=boosted)
    rows = run.latest.collect()
    assert len(rows) == 3 and all(r["pred_q20"] <= r["pred_q50"] <= r["pred_q80"] for r in rows)
    assert run.models.nodes.select("scope_id", "fuel_col").distinct().count() == 1


def test_readers_follow_the_manifest(spark, tmp_path):
    folder = str(tmp_path / "pub")
    docs = spark.createDataFrame([("a", "f", "{}"), ("b", "f", "{}")], "scope_id string, fuel_col string, payload string")
    lines = spark.createDataFrame([("a", "f", "s1", "{1}")], "scope_id string, fuel_col string, station_id string, line string")
    assert pub.published_version(spark, folder) is None
    with pytest.raises(ValueError):
        pub.read_published(spark, folder, "feed")
    pub.write_version(docs, lines, folder, 1)
    assert pub.published_version(spark, folder) is None
    pub.commit_version(spark, folder, 1, "now")
    pub.write_version(docs.limit(1), lines, folder, 2)
    assert pub.read_published(spark, folder, "feed").count() == 2
    pub.write_version(docs.limit(1), lines, folder, 2)  # the broken-off run taken up again
    pub.commit_version(spark, folder, 2)
    assert pub.read_published(spark, folder, "feed").count() == 1
    assert pub.read_published(spark, folder, "stations").collect()[0].asDict() == {"value": "{1}", "scope_id": "a", "fuel_col": "f"}
    with pytest.raises(ValueError):
        pub.commit_version(spark, folder, 2)


def candidate(spark, production, **changes):
    metrics = dict(avg_policy_realized_saving=0.02, decision_accuracy_vs_oracle=0.6, share_wait=0.4, mae_q50=0.1) | changes
    best = production.select("scope_id", "fuel_col").withColumns({
        "horizon_days": F.lit(14), "waiting_cost": F.lit(0.002), "selection_method": F.lit("temporal_split"),
        **{k: F.lit(v).cast("double") for k, v in metrics.items()}})
    return sel.candidates(best, production, dt.date(2024, 5, 1), "run-1")


def test_gate_against_what_is_in_production(spark, base):
    production = base[3].where("scope_id = 'one'").limit(1)
    current = production.select("scope_id", "fuel_col", F.lit(0.0195).alias("current_saving"), F.lit(0.63).alias("current_accuracy"))

    def reasons(cand, now=current):
        return sel.promotion_gate(cand, (0.1, 0.6), 0.05, 0.02, now).first()["reasons"]

    assert reasons(candidate(spark, production)) == ["saving_gain_too_small", "accuracy_drop_too_large"]
    assert reasons(candidate(spark, production, avg_policy_realized_saving=0.03, decision_accuracy_vs_oracle=0.62)) == []
    assert reasons(candidate(spark, production, share_wait=0.9, avg_policy_realized_saving=0.03, decision_accuracy_vs_oracle=0.62)) == [
        "share_wait_out_of_range"]
    assert reasons(candidate(spark, production), current.limit(0)) == []
    assert reasons(candidate(spark, production, avg_policy_realized_saving=None), current.limit(0)) == ["missing_saving"]


def test_production_only_moves_from_the_version_that_was_judged(spark, base, tmp_path):
    store = str(tmp_path / "production")
    assert sel.current_production(spark, store) is None
    production = base[3].where(F.col("fuel_col") == A)
    sel.append_production(production, store)
    gated = stage(sel.promotion_gate(candidate(spark, sel.current_production(spark, store))), "gated")
    assert {r["outcome"] for r in sel.promote_if_current(spark, store, gated).collect()} == {"promoted"}
    now = sel.current_production(spark, store).collect()
    assert {(r["version"], r["horizon_days"], r["selection_method"]) for r in now} == {("v2", 14, "temporal_split")}
    assert {r["outcome"] for r in sel.promote_if_current(spark, store, gated).collect()} == {"stale"}
    assert {r["version"] for r in sel.current_production(spark, store).collect()} == {"v2"}


def test_runs_broken_off_are_not_read(spark, tmp_path):
    folder, df = str(tmp_path / "runs"), spark.range(5)
    tb.write_results({"a": df, "b": df.limit(2)}, folder, "1")
    tb.write_results({"a": df.limit(3)}, folder, "2")
    df.limit(1).write.parquet(f"{folder}/a/run_id=3")
    assert tb.read_results(spark, folder, "a").count() == 3
    assert tb.read_results(spark, folder, "a", "1").count() == 5
    assert tb.read_results(spark, folder, "b").count() == 2
    with pytest.raises(ValueError):
        tb.read_results(spark, folder, "a", "3")


def test_tables_of_a_run_are_worked_out_once(spark, base, monkeypatch):
    """What several tables of the experiment store are made from is read from files by each of them."""
    class Written(Exception):
        pass

    found = {}

    def capture(tables, folder, run_id):
        found.update(tables)
        if len(tables) > 1:
            raise Written

    prices, stations = base[0], base[1]
    for name, value in {"base": lambda spark, d: (prices, stations), "FUEL": A, "H": (3,), "COSTS": (0.001,),
                        "ROLLING": dict(min_train=30, test_window=5, step=5, max_folds=2)}.items():
        monkeypatch.setattr(catalog, name, value)
    monkeypatch.setattr(catalog.tb, "write_results", capture)
    with pytest.raises(Written):
        catalog.experiment_store(spark, "")
    for name in ("calibration", "rolling_folds", "rolling_summary"):
        assert "Aggregate" not in found[name]._jdf.queryExecution().optimizedPlan().toString(), name
