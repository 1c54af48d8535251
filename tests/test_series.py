"""Series features against pandas formulas on random panels with gaps."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quotegrid.operators import forecast as fc
from quotegrid.operators import market as mk
from quotegrid.operators import panel as pn
from quotegrid.operators import timeseries as ts
from quotegrid.operators.regime import RegimeRules, with_regimes
from quotegrid.plans.frame import features, fuel_frame, model_frame, training_frame
from quotegrid.schema import METRICS

DAY0 = dt.date(2024, 1, 1)


def random_panel(seed, stations=4, days=420, share=0.6):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(stations):
        price = 1.4 + 0.05 * s
        for d in range(days):
            price = max(0.8, price + rng.choice([0.0, 0.001, -0.002, 0.02, -0.03], p=[0.5, 0.2, 0.2, 0.05, 0.05]))
            seen = rng.random() < share and not 100 <= d < 140
            rows.append((DAY0 + dt.timedelta(days=d), f"s{s}", round(price, 3) if seen else None, int(seen)))
    return pd.DataFrame(rows, columns=["date", "station_id", "price", "is_observed_price"])


def to_spark(spark, pdf):
    rows = [(d, s, None if pd.isna(p) else float(p), int(o)) for d, s, p, o in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "date date, station_id string, price double, is_observed_price int")


def same(got, want, **tolerance):
    got, want = pd.to_numeric(got).to_numpy(float), pd.to_numeric(want).to_numpy(float)
    np.testing.assert_allclose(got, want, equal_nan=True, **(tolerance or dict(rtol=0, atol=1e-9)))


@pytest.mark.parametrize("seed", [1, 2])
def test_features_match_pandas(spark, seed):
    pdf = random_panel(seed).sort_values(["station_id", "date"]).reset_index(drop=True)
    panel = to_spark(spark, pdf).withColumnRenamed("price", "precio_gasoleo_a")
    got = features(panel, "precio_gasoleo_a", [3, 7]).orderBy("station_id", "date").toPandas()

    by = pdf.groupby("station_id")["price"]
    pdf["x"] = by.transform(lambda s: s.ffill(limit=3))
    x = pdf.groupby("station_id")["x"]
    same(got["price_ffill"], pdf["x"])
    for k in (1, 14, 30):
        same(got[f"lag_{k}"], x.shift(k))
    for n, least in ((7, 3), (30, 10)):
        same(got[f"roll_mean_{n}"], x.transform(lambda s: s.rolling(n, min_periods=least).mean()))
        same(got[f"roll_std_{n}"], x.transform(lambda s: s.rolling(n, min_periods=least).std()), atol=1e-7, rtol=0)
    low = x.transform(lambda s: s.rolling(365, min_periods=30).min())
    high = x.transform(lambda s: s.rolling(365, min_periods=30).max())
    same(got["roll_min_365"], low)
    same(got["roll_max_365"], high)
    same(got["price_position_365"], ((pdf["x"] - low) / (high - low)).where(high > low))
    for h in (3, 7):
        want = by.transform(lambda s: s.shift(-1)[::-1].rolling(h, min_periods=1).min()[::-1])
        same(got[f"target_min_{h}d"], want)
        assert (got[f"target_available_{h}d"] == want.notna().astype(int)).all()
    day = pdf.groupby("date")["x"]
    same(got["price_rank_pct"], day.rank(method="average", pct=True))
    same(got["n_cheaper_stations"], day.rank(method="min") - 1)
    market = pdf.groupby("date")["price"]
    same(got["market_median"], market.transform("median"))
    same(got["market_std"], market.transform("std"))
    same(got["days_since_observed"], pdf.groupby("station_id")["is_observed_price"].cumsum())
    assert (got["day_of_week"] == pd.to_datetime(pdf["date"]).dt.dayofweek).all()

    # the regime, rule by rule
    delta = x.diff()
    scale = delta.abs().groupby(pdf["station_id"]).transform(
        lambda s: s.rolling(60, min_periods=10).median().fillna(s.median())
    )
    flag = (delta >= np.maximum(0.015, 3 * scale)).astype(int)
    shock, three = np.maximum(0.025, 4 * scale), x.diff(3)
    resets = flag.groupby(pdf["station_id"]).transform(lambda s: s.rolling(90, min_periods=1).sum())
    want = np.where(three >= shock, "shock_up", np.where(three <= -shock, "shock_down", np.where(resets >= 2, "cyclical", "stable")))
    same(got["robust_scale"], scale)
    same(got["recent_resets_90"], resets)
    assert (got["regime"].to_numpy() == want).all()
    assert set(want) >= {"shock_down", "cyclical"}


def test_missing_scale_gives_no_reset_and_no_shock(spark):
    pdf = random_panel(3, stations=1, days=8, share=1.0)
    pdf["price"] = [1.0, 2.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    got = with_regimes(to_spark(spark, pdf), "price", RegimeRules(scale_fallback="none")).toPandas()
    assert got["robust_scale"].isna().all() and (got["cycle_reset_flag"] == 0).all()
    assert (got["regime"] == "stable").all() and (got["days_since_reset"] == 999).all()


def test_calendar_expansion(spark):
    prices = spark.createDataFrame(
        [(DAY0, "a", 1.0), (DAY0 + dt.timedelta(days=4), "a", 2.0), (DAY0 + dt.timedelta(days=2), "b", 3.0),
         (DAY0 + dt.timedelta(days=9), "unknown", 9.0)],
        "date date, station_id string, precio_gasoleo_a double",
    )
    stations = spark.createDataFrame([("a", "M1"), ("b", "M2"), ("c", "M3")], "station_id string, municipality string")
    got = pn.expand_calendar(prices, stations, attributes=["municipality"], metrics=["precio_gasoleo_a"]).toPandas()
    assert len(got) == 15 and not got.duplicated(["date", "station_id"]).any()
    assert got["precio_gasoleo_a"].sum() == 6.0
    assert set(zip(got["station_id"], got["municipality"])) == {("a", "M1"), ("b", "M2"), ("c", "M3")}
    empty = pn.expand_calendar(prices, stations, start="2024-02-02", end="2024-02-01", metrics=["precio_gasoleo_a"])
    assert empty.count() == 0
    none = pn.expand_calendar(prices, stations.where("false"), metrics=["precio_gasoleo_a"])
    assert none.count() == 0
    log = spark.createDataFrame([(DAY0, "empty"), (DAY0 + dt.timedelta(days=1), "empty")], "date date, status string")
    assert pn.expand_calendar(prices.where("false"), stations, log, metrics=["precio_gasoleo_a"]).count() == 6


def test_ranks_with_one_hot_price(spark):
    rows = [(DAY0, f"s{i}", 1.5 if i % 3 == 0 else 1.0 + i / 1000) for i in range(600)] + [(DAY0, "null", None)]
    df = spark.createDataFrame(rows, "date date, station_id string, price_ffill double")
    got = mk.with_price_ranks(df).toPandas().set_index("station_id")
    want = pd.DataFrame(rows, columns=["d", "s", "x"]).set_index("s")["x"].astype(float)
    same(got["price_rank_pct"].reindex(want.index), want.rank(pct=True))
    same(got["n_cheaper_stations"].reindex(want.index), want.rank(method="min") - 1)


@pytest.mark.parametrize("scope, span, fill_limit", [((), (None, None), 3), (("market",), (None, None), 3),
                                                     (("market",), (DAY0 + dt.timedelta(days=5), DAY0 + dt.timedelta(days=31)), 1)])
def test_ranks_of_sparse_quotes_are_those_of_the_dense_panel(spark, scope, span, fill_limit):
    """Gaps shorter and longer than the fill, repeated quotes, quotes without this price, unknown and silent stations, a last day nobody else has."""
    rng = np.random.default_rng(7)
    rows = []
    for s in range(9):
        for d in np.flatnonzero(rng.random(40) < (0.15, 0.5, 0.95)[s % 3]).tolist():
            price = None if rng.random() < 0.2 else 1.0 + int(rng.integers(6)) / 100
            rows += [(DAY0 + dt.timedelta(days=d), f"s{s}", price, 1.0)] * int(rng.integers(1, 3))
            rows += [(DAY0 + dt.timedelta(days=d), f"s{s}", 1.03, None)] if rng.random() < 0.1 else []
    rows += [(DAY0 + dt.timedelta(days=45), "s0", 1.2, 1.0), (DAY0 + dt.timedelta(days=60), "unknown", 0.1, 0.1)]
    prices = spark.createDataFrame(rows, f"date date, station_id string, precio_gasoleo_a double, {METRICS[-1]} double")
    missing = [m for m in METRICS if m not in prices.columns]
    prices = prices.withColumns({m: F.lit(None).cast("double") for m in missing})
    stations = spark.createDataFrame([(f"s{s}", "AB"[s % 2] if s < 8 else None) for s in range(10)], "station_id string, market string")
    metric, (start, end) = "precio_gasoleo_a", span
    got = training_frame(prices, stations, metric, [3], None, start, end, scope, fill_limit)

    sparse = prices.withColumn("is_observed_price", pn.observed_flag())
    panel = pn.expand_calendar(sparse, stations, None, start, end, scope, [metric, "is_observed_price"])
    filled = ts.with_filled_price(panel.withColumnRenamed(metric, "price"), "price", fill_limit)
    columns = ["date", "station_id", *scope, "price", "is_observed_price", "price_ffill", "price_rank_pct", "n_cheaper_stations"]
    want = mk.with_price_ranks(filled, "price_ffill", [*scope, "date"]).fillna(0, ["is_observed_price"])
    left, right = (df.select(*columns).orderBy("station_id", "date").toPandas() for df in (got, want))
    assert len(left) == len(right) > 100
    assert left[["date", "station_id", *scope]].equals(right[["date", "station_id", *scope]])
    for c in columns[-5:]:
        same(left[c], right[c])
    assert left["price_rank_pct"].notna().sum() > left["price"].notna().sum()


def test_dense_rows_are_not_moved_for_ranks(spark):
    """Between the expansion of the calendar and the result no exchange lies on the way of the dense rows."""
    prices = spark.createDataFrame([(DAY0, "a", 1.0)], "date date, station_id string, precio_gasoleo_a double")
    prices = prices.withColumns({m: F.lit(None).cast("double") for m in METRICS if m != "precio_gasoleo_a"})
    stations = spark.createDataFrame([("a",), ("b",)], "station_id string")
    node = training_frame(prices, stations, "precio_gasoleo_a", [3])._jdf.queryExecution().executedPlan().initialPlan()
    passed = []
    while node.nodeName() != "Generate":
        passed.append(node.nodeName())
        node = node.children().head()
    assert "Window" in passed and "Exchange" not in passed


def test_fuels_side_by_side_are_ranked_in_their_own_markets(spark):
    """The wide frame of every scope and fuel against one training frame per fuel; days bounded by all fuels' quotes."""
    rng = np.random.default_rng(11)
    fuels = [METRICS[0], METRICS[1]]
    days = [(DAY0 + dt.timedelta(days=int(d)), f"s{s}", *(1.0 + int(rng.integers(5)) / 100 if rng.random() < 0.7 else None for _ in fuels))
            for s in range(6) for d in [0, *np.flatnonzero(rng.random(20) < 0.6).tolist()[1:], 20]]
    prices = spark.createDataFrame(days, f"date date, station_id string, {fuels[0]} double, {fuels[1]} double")
    prices = prices.withColumns({m: F.lit(None).cast("double") for m in METRICS if m not in fuels})
    stations = spark.createDataFrame([(f"s{s}", "AB"[s % 2]) for s in range(6)], "station_id string, scope_id string")
    pairs = spark.createDataFrame([(c, f) for c in "AB" for f in fuels], "scope_id string, fuel_col string")
    columns = ["fuel_col", "scope_id", "station_id", "date", "price", "price_ffill", "price_rank_pct", "n_cheaper_stations", "market_median"]
    got = fuel_frame(prices, stations, pairs, [3], wide=True).select(*columns).orderBy(*columns[:4]).toPandas()
    each = [training_frame(prices, stations, f, [3], scope=["scope_id"]).where("is_observed_price = 1").withColumn("fuel_col", F.lit(f)) for f in fuels]
    want = each[0].select(*columns).union(each[1].select(*columns)).orderBy(*columns[:4]).toPandas()
    assert len(got) == len(want) > 60 and got[columns[:4]].equals(want[columns[:4]])
    for c in columns[4:]:
        same(got[c], want[c])


def test_invalid_arguments():
    with pytest.raises(ValueError):
        pn.parse_day("2024/01/01")
    with pytest.raises(ValueError):
        pn.best_metric("kerosene")


@pytest.mark.parametrize("fallback,fill_limit", [("series", 3), ("series", 0), ("none", 5)])
def test_model_rows_from_quotes_are_those_of_the_calendar(spark, fallback, fill_limit):
    """Observed days without a price, quotes that come twice, unknown stations and stations listed twice included."""
    pdf = random_panel(7, stations=5, days=330, share=0.45)
    pdf = pdf[(pdf["is_observed_price"] == 1) | (pdf.index % 17 == 0)]
    pdf = pdf[(pdf["station_id"] != "s3") | (pdf.index % 9 == 0)]  # few quotes: the scale of the series
    quotes = to_spark(spark, pdf).withColumnRenamed("price", "precio_gasoleo_a").drop("is_observed_price").withColumns(
        {m: F.lit(1.0 if m == METRICS[1] else None).cast("double") for m in METRICS[1:]})
    prices = quotes.unionByName(quotes.limit(20)).unionByName(quotes.limit(3).withColumn("date", F.lit(None).cast("date")))
    stations = spark.createDataFrame([("s0", "A"), ("s1", "A"), ("s2", "B"), ("s2", "B"), ("s3", "B"), ("none", "A")], "station_id string, scope_id string")
    rules = RegimeRules(scale_fallback=fallback)
    ends = [DAY0 + dt.timedelta(days=n) for n in (40, 200, 329)]
    got = model_frame(prices, stations, "precio_gasoleo_a", 14, scope=["scope_id"], fill_limit=fill_limit, rules=rules, ends=ends)

    sparse = prices.withColumn("is_observed_price", pn.observed_flag(METRICS)).select("date", "station_id", "precio_gasoleo_a", "is_observed_price")
    panel = pn.expand_calendar(sparse, stations, attributes=["scope_id"], metrics=["precio_gasoleo_a", "is_observed_price"])
    panel = ts.with_filled_price(panel.withColumnRenamed("precio_gasoleo_a", "price"), "price", fill_limit)
    want = with_regimes(panel, rules=rules, alongside=({}, {}, {"ahead": ts.future_prices("price", 14)}), ends=ends)
    want = want.where("is_observed_price = 1").select(*got.columns)
    assert got.count() == want.count() > 400
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.select("regime").distinct().count() >= 3


def test_no_empty_day_of_the_model_rows_becomes_a_row(spark):
    days = [(DAY0, "a"), (DAY0 + dt.timedelta(days=3000), "a"), (DAY0 + dt.timedelta(days=1), "b")]
    prices = spark.createDataFrame([(d, s, *[1.5] * len(METRICS)) for d, s in days], ["date", "station_id", *METRICS])
    stations = spark.createDataFrame([("a",), ("b",)], ["station_id"])
    rows = model_frame(prices, stations, "precio_gasoleo_a", 14)
    assert rows.count() == 3
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode(") == 1  # stations listed twice only


def test_scale_counts_zeros_and_sorts_the_rest(spark):
    """The median of the last 60 changes is that of all of them, though the zeros are not gathered."""
    pdf = random_panel(11, stations=2, days=200, share=0.9)
    out = with_regimes(to_spark(spark, pdf), "price")
    gathered = [e for e in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "collect_list(" in e]
    assert gathered and all("collect_list(_moved" in e for e in gathered)
    got = out.toPandas().sort_values(["station_id", "date"])
    for _, rows in got.groupby("station_id"):
        change = pdf[pdf.station_id == rows.station_id.iloc[0]].price.diff().abs()
        same(rows.robust_scale, change.rolling(60, min_periods=10).median().fillna(change.median()))


def test_lowest_price_ahead_copies_no_array(spark):
    df = spark.createDataFrame([([3.0, None, 1.0, 2.0],), ([None, None, None, None],), ([5.0],), (None,)], "ahead array<double>")
    assert [tuple(r) for r in df.select(ts.lowest_ahead(2), ts.lowest_ahead(3), ts.lowest_ahead(1)).collect()] == [
        (3.0, 1.0, 3.0), (None, None, None), (5.0, 5.0, 5.0), (None, None, None)]
    frame = df.selectExpr("ahead", "date'2024-01-01' date", "'s' station_id", "1d price", "'stable' regime", "1 is_observed_price")
    rows = fc.horizon_rows(frame, [2, 3])
    assert "slice(" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.horizon_days, r.target) for r in rows.collect() if r.target) == [(2, 3.0), (2, 5.0), (3, 1.0), (3, 5.0)]


def test_dates_of_a_key_are_gathered_once_per_day(spark):
    rows = spark.range(1000).selectExpr("cast(id % 2 as int) k", "date_add(date'2024-01-01', cast(id % 7 as int)) date")
    dates = fc.distinct_dates(rows.unionByName(spark.sql("select 0 k, cast(null as date) date")), ["k"])
    assert "collect_set" not in dates._jdf.queryExecution().optimizedPlan().toString()
    assert [r._dates for r in dates.orderBy("k").collect()] == [[DAY0 + dt.timedelta(days=i) for i in range(7)]] * 2
