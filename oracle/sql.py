"""SQL for the results of the catalog's queries, over the plain tables.

Written independently of the library: sorts and row numbers where it counts values, per-row copies
where it shares them between folds.
"""

from __future__ import annotations

import re

METRICS = [
    "precio_gasoleo_a", "precio_gasoleo_b", "precio_gasoleo_premium", "precio_gasolina_95_e5",
    "precio_gasolina_95_e10", "precio_gasolina_95_e5_premium", "precio_gasolina_98_e5", "precio_gasolina_98_e10",
]
DIESEL, GASOLINA = METRICS[:3], METRICS[3:]
LABELS = [
    "Diésel A", "Diésel B", "Diésel Premium", "Gasolina 95", "Gasolina 95 E10", "Gasolina 95 Premium",
    "Gasolina 98", "Gasolina 98 E10",
]
CONDITIONS = [
    "true", "l_returnflag = 'A'", "l_returnflag = 'R'",
    "l_linenumber = 1", "l_linenumber = 2", "l_linenumber = 3", "l_linenumber = 4", "l_linenumber = 5",
]
FUEL = METRICS[0]
H = (3, 5, 7, 10, 14)
COSTS = (0.001, 0.002, 0.003, 0.005, 0.008)
QS = (20, 50, 80)
ALL = ", ".join(METRICS)


def quote(sum_, count):
    return f"floor((1.2e0 + {sum_} / (nullif({count}, 0) * 1e7)) * 1000 + 0.5e0) / 1e3"


def prices_sql(where="true"):
    cols = ", ".join(
        quote(f"sum(c) FILTER (WHERE {cond})", f"count(*) FILTER (WHERE {cond})") + f" AS {m}"
        for m, cond in zip(METRICS, CONDITIONS)
    )
    return (
        f"SELECT CAST(l_shipdate AS date) AS date, CAST(l_suppkey AS varchar) AS station_id, {cols} "
        f"FROM (SELECT *, CAST(round(l_extendedprice * 100) AS bigint) AS c FROM lineitem WHERE {where}) t GROUP BY 1, 2"
    )


def days_sql(lo, hi):
    return (
        f"SELECT CAST(d AS date) AS date FROM (SELECT unnest(generate_series(CAST({lo} AS timestamp), "
        f"CAST({hi} AS timestamp), INTERVAL 1 DAY)) AS d) g"
    )


ST = "PARTITION BY station_id ORDER BY date"
DATE_LO, DATE_HI = "(SELECT min(date) FROM prices)", "(SELECT max(date) FROM prices)"


def last(n):
    return f"({ST} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def guarded(fn, col, n, least):
    return f"CASE WHEN count({col}) OVER {last(n)} >= {least} THEN {fn}({col}) OVER {last(n)} END"


# name -> (names it builds on, SQL)
CTES: dict[str, tuple[list[str], str]] = {
    "prices": ([], prices_sql()),
    "stations": ([], (
        "SELECT CAST(s_suppkey AS varchar) AS station_id, s_name AS station_name, CAST(NULL AS varchar) AS address, "
        "n_name AS municipality, r_name AS province, CAST(NULL AS double) AS latitude, CAST(NULL AS double) AS longitude, "
        "CAST(NULL AS varchar) AS schedule, lower(replace(n_name || '_' || r_name, ' ', '_')) AS scope_id "
        "FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
    )),
    "days": (["prices"], days_sql(DATE_LO, DATE_HI)),
    "fetch_log": (["days", "prices"], (
        "SELECT days.date, CASE WHEN count(station_id) > 0 THEN 'fetched' ELSE 'empty' END AS status, "
        "count(station_id) AS records_count, count(station_id) AS inserted_rows, CAST(NULL AS varchar) AS error_type, "
        "CAST(NULL AS varchar) AS error_message, TIMESTAMP '2002-01-01 00:00:00' AS created_at, "
        "TIMESTAMP '2002-01-01 00:00:00' AS updated_at FROM days LEFT JOIN prices ON days.date = prices.date GROUP BY days.date"
    )),
    "patchy": (["fetch_log"], (
        "SELECT date, CASE WHEN day(date) % 7 = 0 THEN 'failed' ELSE status END AS status, "
        "CASE WHEN day(date) % 7 = 0 THEN 0 ELSE records_count END AS records_count, inserted_rows, "
        "CASE WHEN day(date) % 7 = 0 THEN 'IOError' END AS error_type, error_message, created_at, updated_at "
        "FROM fetch_log WHERE year(date) < 2001"
    )),
    "dense": (["days", "stations", "prices"], (
        f"SELECT days.date, stations.station_id, scope_id, municipality, province, {', '.join('prices.' + m for m in METRICS)}, "
        f"prices.{FUEL} AS price, CASE WHEN coalesce({', '.join('prices.' + m for m in METRICS)}) IS NOT NULL THEN 1 ELSE 0 END AS is_observed_price "
        "FROM days CROSS JOIN stations LEFT JOIN prices ON prices.date = days.date AND prices.station_id = stations.station_id"
    )),
    "filled": (["dense"], (
        f"SELECT date, station_id, scope_id, price, is_observed_price, last_value(price IGNORE NULLS) OVER {last(4)} AS x FROM dense"
    )),
    "deltas": (["filled"], (
        f"SELECT *, x - lag(x, 1) OVER w AS delta_1, x - lag(x, 3) OVER w AS delta_3, x - lag(x, 7) OVER w AS delta_7 "
        f"FROM filled WINDOW w AS ({ST})"
    )),
    "scales": (["deltas"], (
        f"SELECT *, list_sort(list(abs(delta_1)) FILTER (WHERE delta_1 IS NOT NULL) OVER {last(60)}) AS recent, "
        "list_sort(list(abs(delta_1)) FILTER (WHERE delta_1 IS NOT NULL) OVER (PARTITION BY station_id)) AS whole FROM deltas"
    )),
    "scaled": (["scales"], (
        "SELECT * EXCLUDE (recent, whole), CASE WHEN len(recent) >= 10 "
        "THEN (recent[(len(recent) + 1) // 2] + recent[len(recent) // 2 + 1]) / 2 "
        "ELSE (whole[(len(whole) + 1) // 2] + whole[len(whole) // 2 + 1]) / 2 END AS robust_scale FROM scales"
    )),
    "flagged": (["scaled"], (
        "SELECT *, CASE WHEN robust_scale IS NOT NULL AND delta_1 >= greatest(0.015e0, 3e0 * robust_scale) THEN 1 ELSE 0 END AS cycle_reset_flag, "
        "CASE WHEN robust_scale IS NOT NULL THEN greatest(0.025e0, 4e0 * robust_scale) END AS shock FROM scaled"
    )),
    "regimes": (["flagged"], (
        f"SELECT *, CASE WHEN delta_3 >= shock THEN 'shock_up' WHEN delta_3 <= -shock THEN 'shock_down' "
        "WHEN recent_resets_90 >= 2 THEN 'cyclical' ELSE 'stable' END AS regime FROM ("
        f"SELECT *, CAST(sum(cycle_reset_flag) OVER {last(90)} AS bigint) AS recent_resets_90, "
        f"coalesce(date_diff('day', max(CASE WHEN cycle_reset_flag = 1 THEN date END) OVER ({ST} ROWS UNBOUNDED PRECEDING), date), 999) AS days_since_reset "
        "FROM flagged) r"
    )),
    "futures": (["dense"], (
        "SELECT date, station_id, " + ", ".join(
            f"min(price) OVER ({ST} ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING) AS t{h}" for h in H
        ) + ", [" + ", ".join(f"lead(price, {k} ) OVER ({ST})" for k in range(1, 15)) + "] AS ahead FROM dense"
    )),
    "seen": (["regimes", "futures"], (
        "SELECT r.date, r.station_id, r.scope_id, r.price, r.regime, t3, t5, t7, t10, t14, ahead FROM regimes r "
        "JOIN futures f ON r.date = f.date AND r.station_id = f.station_id WHERE is_observed_price = 1"
    )),
    "mrows": (["seen"], "SELECT * FROM seen WHERE price IS NOT NULL"),
    "lrows": (["mrows"], " UNION ALL ".join(
        f"SELECT date, station_id, scope_id, price, regime, ahead, {h} AS horizon_days, t{h} AS target FROM mrows" for h in H
    )),
    "erows": (["lrows"], "SELECT * FROM lrows WHERE target IS NOT NULL"),
    "hist": (["prices"], f"SELECT date, station_id, {FUEL} AS price FROM prices WHERE {FUEL} IS NOT NULL"),
    "market": (["hist"], (
        "SELECT date, min(price) AS market_min, avg(price) AS market_mean, median(price) AS market_median, "
        "stddev_samp(price) AS market_std FROM hist GROUP BY date"
    )),
    "ranks": (["filled"], (
        "SELECT date, station_id, x, CASE WHEN x IS NOT NULL THEN "
        "(rank() OVER (PARTITION BY date ORDER BY x NULLS LAST) + (count(*) OVER (PARTITION BY date, x) - 1) / 2e0) "
        "/ count(x) OVER (PARTITION BY date) END AS price_rank_pct, "
        "CASE WHEN x IS NOT NULL THEN rank() OVER (PARTITION BY date ORDER BY x NULLS LAST) - 1 END AS n_cheaper FROM filled"
    )),
}


def fit_ctes(prefix, keys, source="erows", cutoff="0.8"):
    """Split, models and test predictions per key, by sorting rows."""
    k = ", ".join(keys)
    joined = " AND ".join(f"a.{c} = b.{c}" for c in keys)
    by = f"PARTITION BY {k}, model_key"
    if cutoff == "0.8":
        cut = (
            f"SELECT {k}, n_dates, date AS cutoff FROM (SELECT {k}, date, row_number() OVER (PARTITION BY {k} ORDER BY date) AS i, "
            f"count(*) OVER (PARTITION BY {k}) AS n_dates FROM (SELECT DISTINCT {k}, date FROM {source}) s) u "
            "WHERE i - 1 = CAST(floor(n_dates * 0.8e0) AS bigint)"
        )
    else:
        cut = f"SELECT {k}, count(DISTINCT date) AS n_dates, CAST('{cutoff}' AS date) AS cutoff FROM {source} GROUP BY {k}"
    c = {}
    c[f"{prefix}cut"] = ([source], cut)
    c[f"{prefix}split"] = ([source, f"{prefix}cut"], (
        f"SELECT a.*, b.cutoff, a.date <= b.cutoff AS is_train FROM {source} a JOIN {prefix}cut b ON {joined}"
    ))
    c.update(model_ctes(prefix, keys, f"{prefix}split", "is_train"))
    c[f"{prefix}pred"] = ([f"{prefix}split", f"{prefix}eff"], pred_sql(prefix, keys, f"{prefix}split", "NOT is_train"))
    return c


def model_ctes(prefix, keys, source, where):
    k = ", ".join(keys)
    joined = " AND ".join(f"a.{c} = b.{c}" for c in keys)
    by = f"PARTITION BY {k}, model_key"
    quants = []
    for q in QS:
        pos = f"((n - 1) * 0.{q // 10}e0)"
        lo = f"max(CASE WHEN i - 1 = floor({pos}) THEN diff END)"
        hi = f"max(CASE WHEN i - 1 = ceil({pos}) THEN diff END)"
        quants.append(f"{lo} + ({hi} - {lo}) * (max({pos}) - floor(max({pos}))) AS diff_q{q}")
    c = {}
    c[f"{prefix}sorted"] = ([source], (
        f"SELECT *, row_number() OVER ({by} ORDER BY diff) AS i, count(*) OVER ({by}) AS n FROM ("
        f"SELECT {k}, regime AS model_key, target - price AS diff FROM {source} WHERE {where} UNION ALL "
        f"SELECT {k}, '__global__', target - price FROM {source} WHERE {where}) u"
    ))
    c[f"{prefix}models"] = ([f"{prefix}sorted"], (
        f"SELECT {k}, model_key, max(n) AS rows_train, {', '.join(quants)} FROM {prefix}sorted "
        f"GROUP BY {k}, model_key HAVING max(n) >= 150 OR model_key = '__global__'"
    ))
    c[f"{prefix}eff"] = ([f"{prefix}models"], (
        f"SELECT {', '.join('a.' + x for x in keys)}, r.regime, a.rows_train, "
        + ", ".join(f"coalesce(b.diff_q{q}, a.diff_q{q}) AS diff_q{q}" for q in QS)
        + f" FROM {prefix}models a CROSS JOIN (VALUES ('shock_up'), ('shock_down'), ('cyclical'), ('stable')) r(regime) "
        f"LEFT JOIN {prefix}models b ON {joined} AND b.model_key = r.regime WHERE a.model_key = '__global__'"
    ))
    return c


def pred_sql(prefix, keys, source, where):
    joined = " AND ".join(f"a.{c} = b.{c}" for c in keys)
    return (
        "SELECT * EXCLUDE (p), p[1] AS pred_q20, p[2] AS pred_q50, p[3] AS pred_q80 FROM ("
        "SELECT a.*, b.rows_train, list_sort([a.price + diff_q20, a.price + diff_q50, a.price + diff_q80]) AS p "
        f"FROM (SELECT * FROM {source} WHERE {where}) a JOIN {prefix}eff b ON {joined} AND coalesce(a.regime, 'stable') = b.regime) z"
    )


def policy_select(source, cost, target="target"):
    """All columns of the source and the policy's columns."""
    return (
        f"SELECT *, CASE WHEN decision = 'wait' THEN greatest(realized_wait_gain - {cost}, 0e0) ELSE 0e0 END AS policy_realized_saving_raw, "
        f"CASE WHEN realized_wait_gain > {cost} THEN 'wait' ELSE 'buy_now' END AS oracle_best_action FROM ("
        f"SELECT *, price - {target} AS realized_wait_gain, CASE WHEN price - coalesce(pred_q80, pred_q50) > {cost} THEN 'wait' "
        f"WHEN price - coalesce(pred_q50, pred_q20) <= {cost} THEN 'buy_now' "
        f"WHEN regime = 'cyclical' AND price - coalesce(pred_q50, pred_q20) > {cost} / 2 THEN 'wait' ELSE 'buy_now' END AS decision "
        f"FROM ({source}) a) b"
    )


SAVING = "CASE WHEN decision = 'wait' AND realized_wait_gain IS NULL THEN NULL ELSE policy_realized_saving_raw END"
COST_ROWS = "(VALUES " + ", ".join(f"({c}e0)" for c in COSTS) + ") c(waiting_cost)"
POLICY = (
    "count(*) AS rows, round(avg(CASE WHEN decision = oracle_best_action THEN 1e0 ELSE 0e0 END), 9) AS decision_accuracy_vs_oracle, "
    "round(avg(CASE WHEN decision = 'wait' THEN 1e0 ELSE 0e0 END), 9) AS share_wait, "
    "round(avg(realized_wait_gain), 9) AS avg_realized_wait_gain, "
    f"round(avg({SAVING}), 9) AS avg_policy_realized_saving"
)
POLICY_NO_ROWS = POLICY.removeprefix("count(*) AS rows, ")
MEASURES = ", ".join(
    f"round(avg(abs(target - pred_q{q})), 9) AS mae_q{q}, round(avg(CASE WHEN target - pred_q{q} >= 0 "
    f"THEN 0.{q // 10}e0 * (target - pred_q{q}) ELSE (0.{q // 10}e0 - 1e0) * (target - pred_q{q}) END), 9) AS pinball_q{q}" for q in QS
) + ", round(sqrt(avg((target - pred_q50) * (target - pred_q50))), 9) AS rmse_q50"

CTES.update(fit_ctes("f_", ["horizon_days"]))
CTES.update(fit_ctes("g_", ["horizon_days"], cutoff="2000-12-31"))
CTES.update(fit_ctes("z_", ["horizon_days"], cutoff="2001-11-03"))
CTES.update(fit_ctes("s_", ["scope_id", "horizon_days"]))
CTES["swept"] = (["f_pred"], policy_select(f"SELECT * FROM f_pred CROSS JOIN {COST_ROWS}", "waiting_cost"))
CTES["s_swept"] = (["s_pred"], policy_select(f"SELECT * FROM s_pred CROSS JOIN {COST_ROWS}", "waiting_cost"))
CTES["calibration"] = (["swept"], (
    f"SELECT horizon_days, waiting_cost, rows_train, cutoff AS train_end_date, {POLICY}, {MEASURES}, count(*) AS rows_test "
    "FROM swept GROUP BY horizon_days, waiting_cost, rows_train, cutoff"
))
CTES["s_calibration"] = (["s_swept"], (
    f"SELECT scope_id, horizon_days, waiting_cost, rows_train, cutoff AS train_end_date, {POLICY}, {MEASURES}, count(*) AS rows_test "
    "FROM s_swept GROUP BY scope_id, horizon_days, waiting_cost, rows_train, cutoff"
))
H_ROWS = "(VALUES " + ", ".join(f"({h})" for h in H) + ") h(horizon_days)"


def index_folds_sql(min_train, window, step, max_folds):
    limit = f"AND (i - 1 - {min_train}) // {step} < {max_folds}" if max_folds else ""
    return (
        f"SELECT CAST((i - 1 - {min_train}) // {step} + 1 AS integer) AS fold_id, prev AS train_end, date AS test_start, "
        f"(SELECT max(e.date) FROM days e WHERE e.date >= o.date AND e.date <= o.date + {window - 1}) AS test_end FROM ("
        "SELECT date, lag(date) OVER (ORDER BY date) AS prev, row_number() OVER (ORDER BY date) AS i FROM days) o "
        f"WHERE i - 1 >= {min_train} AND (i - 1 - {min_train}) % {step} = 0 {limit}"
    )


def fold_regimes(prefix):
    """Regimes of every row as of the end of every fold: each fold's series ends with the fold."""
    own = ST.replace("station_id", "fold_id, station_id", 1)

    def within(n):
        return f"({own} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    c = {}
    c[f"{prefix}scales"] = (["deltas", f"{prefix}folds"], (
        f"SELECT a.*, f.fold_id, list_sort(list(abs(delta_1)) FILTER (WHERE delta_1 IS NOT NULL) OVER {within(60)}) AS recent, "
        "median(abs(delta_1)) OVER (PARTITION BY fold_id, station_id) AS whole "
        f"FROM deltas a JOIN {prefix}folds f ON a.date <= f.test_end"
    ))
    c[f"{prefix}flagged"] = ([f"{prefix}scales"], (
        "SELECT *, CASE WHEN robust_scale IS NOT NULL AND delta_1 >= greatest(0.015e0, 3e0 * robust_scale) THEN 1 ELSE 0 END AS cycle_reset_flag, "
        "CASE WHEN robust_scale IS NOT NULL THEN greatest(0.025e0, 4e0 * robust_scale) END AS shock FROM ("
        "SELECT * EXCLUDE (recent, whole), CASE WHEN len(recent) >= 10 THEN (recent[(len(recent) + 1) // 2] + recent[len(recent) // 2 + 1]) / 2 "
        f"ELSE whole END AS robust_scale FROM {prefix}scales) s"
    ))
    c[f"{prefix}regimes"] = ([f"{prefix}flagged"], (
        "SELECT fold_id, station_id, date, CASE WHEN delta_3 >= shock THEN 'shock_up' WHEN delta_3 <= -shock THEN 'shock_down' "
        "WHEN resets >= 2 THEN 'cyclical' ELSE 'stable' END AS regime FROM ("
        f"SELECT *, sum(cycle_reset_flag) OVER {within(90)} AS resets FROM {prefix}flagged) r"
    ))
    return c


def backtest_ctes(prefix, folds_sql, folds_deps, own_horizons, truncate):
    on = "a.horizon_days = b.horizon_days" if own_horizons else "true"
    seen = "least(a.horizon_days, date_diff('day', a.date, b.test_end))" if truncate else "a.horizon_days"
    label = f"CASE WHEN {seen} > 0 THEN list_aggregate(a.ahead[1:{seen}], 'min') END"
    c = {f"{prefix}folds": (folds_deps, folds_sql)}
    regime, look_up, needs = "a.regime", "", []
    if truncate:
        c.update(fold_regimes(prefix))
        needs = [f"{prefix}regimes"]
        regime = "g.regime"
        look_up = f" JOIN {prefix}regimes g ON g.fold_id = b.fold_id AND g.station_id = a.station_id AND g.date = a.date"
    c[f"{prefix}all"] = (["lrows", f"{prefix}folds", *needs], (
        f"SELECT a.date, a.station_id, a.horizon_days, a.price, {regime} AS regime, b.fold_id, a.date <= b.train_end AS is_train, {label} AS target "
        f"FROM lrows a JOIN {prefix}folds b ON {on} AND (a.date <= b.train_end OR a.date BETWEEN b.test_start AND b.test_end){look_up}"
    ))
    keys = ["horizon_days", "fold_id"]
    c[f"{prefix}rows"] = ([f"{prefix}all"], f"SELECT * FROM {prefix}all WHERE target IS NOT NULL")
    c.update(model_ctes(prefix, keys, f"{prefix}rows", "is_train"))
    c[f"{prefix}pred"] = ([f"{prefix}rows", f"{prefix}eff"], pred_sql(prefix, keys, f"{prefix}rows", "NOT is_train"))
    hk = "m.horizon_days = f.horizon_days AND " if own_horizons else ""
    c[f"{prefix}metrics"] = ([f"{prefix}pred", f"{prefix}folds"], (
        f"SELECT m.*, f.train_end AS cutoff_date, f.test_end AS test_end_date FROM (SELECT horizon_days, fold_id, rows_train, "
        f"count(*) AS rows_test, {MEASURES} FROM {prefix}pred GROUP BY horizon_days, fold_id, rows_train) m "
        f"JOIN {prefix}folds f ON {hk} m.fold_id = f.fold_id"
    ))
    c[f"{prefix}policy"] = ([f"{prefix}pred"], (
        f"SELECT horizon_days, fold_id, waiting_cost, {POLICY} FROM ("
        + policy_select(f"SELECT * FROM {prefix}pred CROSS JOIN {COST_ROWS}", "waiting_cost")
        + ") p GROUP BY horizon_days, fold_id, waiting_cost"
    ))
    raw_measures = MEASURES.replace("round(", "(").replace(", 9)", ")")
    raw_policy = POLICY.replace("round(", "(").replace(", 9)", ")")
    c[f"{prefix}summary"] = ([f"{prefix}pred"], (
        "SELECT p.*, mae_q20, mae_q50, mae_q80, rmse_q50, rows_train_mean, rows_test_mean FROM ("
        "SELECT horizon_days, waiting_cost, count(DISTINCT fold_id) AS folds, "
        "round(avg(avg_policy_realized_saving), 9) AS avg_policy_realized_saving, "
        "round(median(avg_policy_realized_saving), 9) AS median_policy_realized_saving, "
        "round(avg(decision_accuracy_vs_oracle), 9) AS decision_accuracy_vs_oracle, round(avg(share_wait), 9) AS share_wait, "
        "round(avg(avg_realized_wait_gain), 9) AS avg_realized_wait_gain FROM ("
        f"SELECT horizon_days, fold_id, waiting_cost, {raw_policy} FROM ("
        + policy_select(f"SELECT * FROM {prefix}pred CROSS JOIN {COST_ROWS}", "waiting_cost")
        + ") q GROUP BY horizon_days, fold_id, waiting_cost) r GROUP BY horizon_days, waiting_cost) p LEFT JOIN ("
        "SELECT horizon_days, round(avg(mae_q20), 9) AS mae_q20, round(avg(mae_q50), 9) AS mae_q50, round(avg(mae_q80), 9) AS mae_q80, "
        "round(avg(rmse_q50), 9) AS rmse_q50, round(avg(rows_train), 9) AS rows_train_mean, round(avg(rows_test), 9) AS rows_test_mean FROM ("
        f"SELECT horizon_days, fold_id, rows_train, count(*) AS rows_test, {raw_measures} FROM {prefix}pred "
        "GROUP BY horizon_days, fold_id, rows_train) t GROUP BY horizon_days) m ON p.horizon_days = m.horizon_days"
    ))
    return c


CALENDAR_FOLDS = (
    "SELECT horizon_days, CAST(row_number() OVER (PARTITION BY horizon_days ORDER BY cutoff) AS integer) AS fold_id, "
    "cutoff AS train_end, cutoff + 1 AS test_start, cutoff + 30 AS test_end FROM ("
    "SELECT *, row_number() OVER (PARTITION BY horizon_days ORDER BY cutoff DESC) AS back FROM ("
    "SELECT horizon_days, CAST(unnest(generate_series(CAST(lo + 730 AS timestamp), CAST(hi - 30 AS timestamp), INTERVAL 30 DAY)) AS date) AS cutoff "
    "FROM (SELECT horizon_days, min(date) AS lo, max(date) AS hi FROM erows GROUP BY horizon_days) s) t) u WHERE back <= 12"
)
CTES.update(backtest_ctes("i_", index_folds_sql(730, 30, 30, 12), ["days"], False, True))
CTES.update(backtest_ctes("n_", index_folds_sql(730, 5, 150, None), ["days"], False, True))
CTES.update(backtest_ctes("e_", index_folds_sql(2490, 2, 2, None), ["days"], False, True))
CTES.update(backtest_ctes("c_", CALENDAR_FOLDS, ["erows"], True, False))

RANK = "{} DESC NULLS LAST, decision_accuracy_vs_oracle DESC NULLS LAST, mae_q50 ASC NULLS LAST, horizon_days, waiting_cost"
CTES["production"] = (["stations"], (
    f"SELECT DISTINCT scope_id, '{FUEL}' AS fuel_col, 3 AS horizon_days, 0.001e0 AS waiting_cost, DATE '2001-01-01' AS selected_on, "
    "'manual' AS selection_method, 'v' || CAST(CAST('0x' || substr(md5(scope_id), 1, 2) AS integer) % 5 + 1 AS varchar) AS version FROM stations"
))
CTES["candidates"] = (["s_calibration", "production"], (
    "SELECT c.scope_id, p.fuel_col, c.horizon_days, c.waiting_cost, DATE '2001-11-04' AS selected_on, "
    "'temporal_split' AS selection_method, 'run-1' AS based_on_run, p.version AS current_version, share_wait, "
    "avg_policy_realized_saving, decision_accuracy_vs_oracle FROM (SELECT *, row_number() OVER (PARTITION BY scope_id ORDER BY "
    + RANK.format("avg_policy_realized_saving") + ") AS position FROM s_calibration) c JOIN production p ON c.scope_id = p.scope_id WHERE position = 1"
))
CTES["daily"] = (["s_eff", "seen", "stations", "prices"], (
    policy_select(
        "SELECT * EXCLUDE (p), p[1] AS pred_q20, p[2] AS pred_q50, p[3] AS pred_q80 FROM (SELECT a.scope_id, "
        f"'{FUEL}' AS fuel_col, a.date, a.station_id, a.price, a.regime, a.t3 AS target, "
        "list_sort([a.price + diff_q20, a.price + diff_q50, a.price + diff_q80]) AS p FROM seen a "
        "JOIN (SELECT scope_id, max(date) AS date FROM prices JOIN stations USING (station_id) GROUP BY scope_id) l "
        "ON a.scope_id = l.scope_id AND a.date = l.date "
        "JOIN s_eff b ON a.scope_id = b.scope_id AND b.horizon_days = 3 AND b.regime = a.regime) z", "0.001e0")
))
CTES["daily_summary"] = (["daily"], (
    f"SELECT scope_id, '{FUEL}' AS fuel_col, CASE WHEN count(*) FILTER (WHERE decision = 'buy_now') > 0 THEN 'buy_now' ELSE 'wait' END AS recommendation, "
    "count(*) AS n_stations, count(*) FILTER (WHERE decision = 'buy_now') AS n_buy_now, count(*) FILTER (WHERE decision = 'wait') AS n_wait, "
    "(list(station_id ORDER BY (CASE WHEN decision = 'buy_now' THEN 0 ELSE 1 END), price, station_id))[1] AS selected_station_id, "
    "(list(price ORDER BY (CASE WHEN decision = 'buy_now' THEN 0 ELSE 1 END), price, station_id))[1] AS selected_station_price, "
    "(list(station_id ORDER BY price, station_id))[1] AS cheapest_station_id, min(price) AS cheapest_station_price FROM daily GROUP BY scope_id"
))


def of_fuel(prefix, fuel, horizon, cost):
    """The chain up to the daily run for another fuel: the same SQL under names of its own."""
    chain = ["dense", "filled", "deltas", "scales", "scaled", "flagged", "regimes", "futures", "seen", "mrows", "lrows", "erows", "s_cut",
             "s_split", "s_sorted", "s_models", "s_eff", "daily", "daily_summary"]
    ours = re.compile(r"\b(" + "|".join(chain) + r")\b")

    def renamed(text):
        return ours.sub(lambda m: prefix + m.group(1), text)

    for name in chain:
        deps, text = CTES[name]
        text = renamed(text)
        if name == "dense":
            text = text.replace(f"prices.{FUEL} AS price", f"prices.{fuel} AS price")
        text = text.replace(f"'{FUEL}'", f"'{fuel}'")
        if name == "daily":
            text = text.replace("a.t3", f"a.t{horizon}").replace("b.horizon_days = 3", f"b.horizon_days = {horizon}").replace("0.001e0", cost)
        CTES[prefix + name] = ([prefix + x if x in chain else x for x in deps], text)


of_fuel("x_", METRICS[3], 7, "0.002e0")


def build(final: str, *names: str) -> str:
    """The final SELECT behind the WITH list of everything it builds on."""
    order: list[str] = []

    def visit(name):
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for name in names:
        visit(name)
    listed = ", ".join(f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in order)
    # The shift keeps exact ties off the rounding edge, as in the catalog.
    return f"WITH {listed} {final}".replace(", 9)", " + 1e-12, 9)")


def summary_aggs(source="prices"):
    parts = []
    for m in METRICS:
        parts += [
            f"min({m}) AS {m}_min", f"round(avg({m}), 9) AS {m}_mean", f"max({m}) AS {m}_max",
            f"round(stddev_samp({m}), 9) AS {m}_std", f"count({m}) AS {m}_stations",
        ]
    return ", ".join(parts)


def least_of(cols):
    return f"least({', '.join(cols)})"


def label_of(cols):
    return "CASE " + " ".join(
        f"WHEN {c} = {least_of(cols)} THEN '{LABELS[METRICS.index(c)]}'" for c in cols
    ) + " END"


def latest_sql(cols):
    return (
        f"SELECT station_name, address, schedule, {', '.join(cols)}, p.date, {least_of(cols)} AS mejor_precio, {label_of(cols)} AS mejor_tipo "
        "FROM prices p JOIN stations s ON p.station_id = s.station_id WHERE p.date = (SELECT max(date) FROM prices) "
        f"AND coalesce({', '.join(cols)}) IS NOT NULL"
    )


LOG_COLUMNS = "date, status, records_count, inserted_rows, error_type, error_message, created_at, updated_at"
LATER = "TIMESTAMP '2002-02-01 00:00:00'"


def bootstrap_entries(overwrite):
    return (
        f"SELECT d.date, CASE WHEN n > 0 THEN 'fetched' ELSE 'empty' END AS status, n AS records_count, k.date IS NOT NULL AS known, k.created_at AS first "
        f"FROM (SELECT w.date, count(p.station_id) AS n FROM ({days_sql(chr(39) + '1998-01-01' + chr(39), chr(39) + '2001-12-31' + chr(39))}) w "
        "LEFT JOIN prices p ON p.date = w.date GROUP BY w.date) d LEFT JOIN patchy k ON k.date = d.date"
        + ("" if overwrite else " WHERE k.date IS NULL")
    )


def bootstrap_sql(overwrite):
    e = bootstrap_entries(overwrite)
    return (
        f"SELECT date, status, records_count, records_count AS inserted_rows, CAST(NULL AS varchar) AS error_type, CAST(NULL AS varchar) AS error_message, "
        f"coalesce(first, {LATER}) AS created_at, {LATER} AS updated_at FROM ({e}) e UNION ALL "
        f"SELECT {LOG_COLUMNS} FROM patchy WHERE date NOT IN (SELECT date FROM ({e}) e2)"
    )


def bootstrap_count_sql(overwrite):
    return (
        "SELECT count(*) FILTER (WHERE NOT known) AS created, count(*) FILTER (WHERE known) AS updated, "
        f"min(date) AS range_start, max(date) AS range_end FROM ({bootstrap_entries(overwrite)}) e"
    )


def collected_sql(force, allow_empty):
    done = "false" if force else "k.status IN ('fetched', 'empty')"
    none = "'empty'" if allow_empty else "'failed'"
    return (
        "SELECT date, status, CASE WHEN status = 'fetched' THEN n ELSE 0 END AS records, CASE WHEN status = 'fetched' THEN n ELSE 0 END AS inserted_rows, "
        "CASE WHEN status = 'failed' THEN CASE WHEN broken THEN 'IOError' ELSE 'RuntimeError' END END AS error_type, "
        "CASE WHEN status = 'failed' THEN CASE WHEN broken THEN 'broken file' ELSE 'no records' END END AS error_message FROM ("
        f"SELECT d.date, n, broken, CASE WHEN coalesce({done}, false) THEN 'skipped' WHEN broken THEN 'failed' WHEN n > 0 THEN 'fetched' ELSE {none} END AS status FROM ("
        f"SELECT w.date, count(p.station_id) FILTER (WHERE dayofweek(w.date) > 0) AS n, count(p.station_id) > 0 AND day(w.date) = 13 AS broken "
        f"FROM ({days_sql(chr(39) + '2000-06-01' + chr(39), chr(39) + '2001-12-31' + chr(39))}) w LEFT JOIN prices p ON p.date = w.date GROUP BY w.date) d "
        "LEFT JOIN patchy k ON k.date = d.date) x"
    )


def plain(*cols):
    return ", ".join(cols)


NUM_TRAIN = (
    "SELECT r.date, r.station_id, regime, r.price, r.x AS price_ffill, market_min, round(market_mean, 9) AS market_mean, "
    "round(market_median, 9) AS market_median, round(market_std, 9) AS market_std, delta_1, delta_3, delta_7, "
    "round(rolling_std_14, 9) AS rolling_std_14, round(rolling_mean_14, 9) AS rolling_mean_14, days_since_reset, recent_resets_90, "
    "lag_1, lag_2, lag_3, lag_7, lag_14, lag_30, r.x - lag_1 AS change_1, r.x - lag_3 AS change_3, r.x - lag_7 AS change_7, r.x - lag_14 AS change_14, "
    "round(roll_mean_7, 9) AS roll_mean_7, round(roll_std_7, 9) AS roll_std_7, round(roll_mean_30, 9) AS roll_mean_30, round(roll_std_30, 9) AS roll_std_30, "
    "round(CASE WHEN hi365 - lo365 > 0 THEN (r.x - lo365) / (hi365 - lo365) END, 9) AS price_position_365, "
    "round(r.x - market_median, 9) AS spread_to_market_median, r.x - market_min AS spread_to_market_min, "
    "round(price_rank_pct, 9) AS price_rank_pct, n_cheaper AS n_cheaper_stations, isodow(r.date) - 1 AS day_of_week, month(r.date) AS month, "
    "round(sin(2 * pi() * (isodow(r.date) - 1) / 7.0e0), 9) AS dow_sin, round(cos(2 * pi() * (isodow(r.date) - 1) / 7.0e0), 9) AS dow_cos, "
    "round(sin(2 * pi() * month(r.date) / 12.0e0), 9) AS month_sin, round(cos(2 * pi() * month(r.date) / 12.0e0), 9) AS month_cos, "
    "is_observed_price, t7 AS target_min_7d, CASE WHEN t7 IS NOT NULL THEN 1 ELSE 0 END AS target_available_7d "
    "FROM (SELECT *, " + ", ".join(f"lag(x, {k}) OVER ({ST}) AS lag_{k}" for k in (1, 2, 3, 7, 14, 30)) + ", "
    + ", ".join(
        f"{guarded(fn, 'x', n, g)} AS {name}_{n}" for n, g, pre in ((7, 3, "roll"), (30, 10, "roll"), (14, 5, "rolling"))
        for fn, name in (("avg", f"{pre}_mean"), ("stddev_samp", f"{pre}_std"))
    )
    + f", {guarded('min', 'x', 365, 30)} AS lo365, {guarded('max', 'x', 365, 30)} AS hi365 FROM regimes) r "
    "LEFT JOIN market m ON r.date = m.date JOIN futures f ON r.date = f.date AND r.station_id = f.station_id "
    "JOIN ranks k ON r.date = k.date AND r.station_id = k.station_id"
)

CTES["trained"] = (["regimes", "market", "futures", "ranks"], f"SELECT * FROM ({NUM_TRAIN}) t WHERE target_available_7d = 1")
NUMERIC = [  # the numeric features
    "price", "price_ffill", "market_min", "market_mean", "market_median", "market_std", "delta_1", "delta_3", "delta_7",
    "rolling_std_14", "rolling_mean_14", "days_since_reset", "recent_resets_90", "lag_1", "lag_2", "lag_3", "lag_7", "lag_14", "lag_30",
    "change_1", "change_3", "change_7", "change_14", "roll_mean_7", "roll_std_7", "roll_mean_30", "roll_std_30", "price_position_365",
    "spread_to_market_median", "spread_to_market_min", "price_rank_pct", "n_cheaper_stations", "day_of_week", "month",
    "dow_sin", "dow_cos", "month_sin", "month_cos", "is_observed_price",
]

LINES = "l_orderkey, l_linenumber"
CENTS = "CAST(round(l_extendedprice * 100) AS bigint)"
QUOTED = "'"


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    panel = "FROM prices p JOIN stations s ON p.station_id = s.station_id"
    observed = "1 AS is_observed_price"
    o["station_panel"] = build(
        f"SELECT p.date, p.station_id, station_name, municipality, province, {ALL}, {observed}, l.status AS fetch_status {panel} "
        f"LEFT JOIN fetch_log l ON l.date = p.date WHERE coalesce({ALL}) IS NOT NULL", "prices", "stations", "fetch_log")
    o["panel_date_range"] = build(
        f"SELECT p.date, p.station_id, {ALL}, {observed} {panel} WHERE p.date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' "
        f"AND coalesce({ALL}) IS NOT NULL", "prices", "stations")
    o["panel_drop_all_null"] = build(
        f"SELECT p.date, p.station_id, {', '.join(GASOLINA)}, {observed} {panel} WHERE coalesce({', '.join(GASOLINA)}) IS NOT NULL", "prices", "stations")
    o["panel_full_calendar"] = build(f"SELECT date, station_id, {ALL}, is_observed_price FROM dense", "dense")
    o["panel_calendar_arguments"] = build(
        f"SELECT d.date, s.station_id, p.{FUEL}, CASE WHEN coalesce({', '.join('p.' + m for m in METRICS)}) IS NOT NULL THEN 1 ELSE 0 END AS is_observed_price "
        f"FROM ({days_sql(QUOTED + '2001-06-01' + QUOTED, QUOTED + '2002-03-31' + QUOTED)}) d CROSS JOIN stations s LEFT JOIN prices p "
        "ON p.date = d.date AND p.station_id = s.station_id", "prices", "stations")
    o["model_panel"] = build(
        f"SELECT d.date, d.station_id, municipality, province, {FUEL}, is_observed_price, l.status AS fetch_status FROM dense d "
        "LEFT JOIN fetch_log l ON l.date = d.date", "dense", "fetch_log")
    o["panel_fetch_status"] = build(
        f"SELECT p.date, p.station_id, {FUEL}, l.status AS fetch_status FROM prices p LEFT JOIN patchy l ON l.date = p.date", "prices", "patchy")
    o["daily_summary"] = build(
        f"SELECT s.*, l.status AS fetch_status FROM (SELECT date, {summary_aggs()} FROM prices GROUP BY date) s "
        "LEFT JOIN fetch_log l ON l.date = s.date", "prices", "fetch_log")
    o["daily_summary_full_calendar"] = build(
        f"SELECT s.*, l.status AS fetch_status FROM (SELECT d.date, {summary_aggs()} FROM "
        f"({days_sql(QUOTED + '1994-12-01' + QUOTED, QUOTED + '2001-12-31' + QUOTED)}) d LEFT JOIN prices p ON p.date = d.date GROUP BY d.date) s "
        "LEFT JOIN fetch_log l ON l.date = s.date", "prices", "fetch_log")
    o["records_per_date"] = build(
        "SELECT date, count(*) AS records_count FROM prices WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' GROUP BY date", "prices")
    o["date_bounds"] = build("SELECT min(date) AS first_date, max(date) AS last_date FROM prices", "prices")
    since = "date >= DATE '2001-11-04' - {}"
    o["price_history_min"] = build(f"SELECT date, min({FUEL}) AS price FROM prices WHERE {since.format(180)} AND {FUEL} IS NOT NULL GROUP BY date", "prices")
    o["price_history_mean"] = build(
        f"SELECT date, round(avg({METRICS[1]}), 9) AS price FROM prices WHERE {since.format(720)} AND {METRICS[1]} IS NOT NULL GROUP BY date", "prices")
    o["price_history_max"] = build(
        f"SELECT date, max({METRICS[3]}) AS price FROM prices WHERE {since.format(3600)} AND {METRICS[3]} IS NOT NULL GROUP BY date", "prices")
    o["station_history"] = build(
        f"SELECT date, {METRICS[2]} AS price FROM prices WHERE {since.format(3600)} AND station_id = '7' AND {METRICS[2]} IS NOT NULL", "prices")
    o["table_counts"] = build(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("prices", "stations", "fetch_log")), "prices", "stations", "fetch_log")
    o["latest_best_price_diesel"] = build(latest_sql(DIESEL), "prices", "stations")
    o["latest_best_price_gasolina"] = build(latest_sql(GASOLINA), "prices", "stations")
    o["best_price_in_group"] = build(
        f"SELECT date, station_id, {least_of(DIESEL)} AS best_diesel, {label_of(DIESEL)} AS label_diesel, "
        f"{least_of(GASOLINA)} AS best_gasolina, {label_of(GASOLINA)} AS label_gasolina FROM prices", "prices")
    o["flat_export"] = build(f"SELECT p.date, station_name, address, p.station_id, {ALL} {panel}", "prices", "stations")
    o["flat_export_columns"] = build(f"SELECT p.date, station_name, address, {FUEL}, {METRICS[4]} {panel}", "prices", "stations")
    o["panel_profile"] = build(
        "SELECT count(*) AS n_rows, min(date) AS date_min, max(date) AS date_max, count(DISTINCT date) AS n_dates, "
        "count(DISTINCT station_id) AS n_stations, count(price) AS observed_prices, count(*) - count(price) AS missing_prices, "
        "round((count(*) - count(price)) / count(*), 9) AS share_missing_prices FROM dense", "dense")
    o["distinct_date_status"] = build(
        "SELECT DISTINCT p.date, l.status AS fetch_status FROM prices p LEFT JOIN patchy l ON l.date = p.date", "prices", "patchy")

    o["ffill_limit3"] = build("SELECT date, station_id, price, x AS price_ffill FROM filled", "filled")
    o["observed_cum_count"] = build(
        f"SELECT date, station_id, is_observed_price, CAST(sum(is_observed_price) OVER ({ST} ROWS UNBOUNDED PRECEDING) AS bigint) AS days_since_observed FROM dense", "dense")
    lags = ", ".join(f"lag(x, {k}) OVER w AS lag_{k}" for k in (1, 2, 3, 7, 14, 30))
    changes = ", ".join(f"x - lag(x, {k}) OVER w AS change_{k}" for k in (1, 3, 7, 14))
    o["lags_changes"] = build(f"SELECT date, station_id, {lags}, {changes} FROM filled WINDOW w AS ({ST})", "filled")
    o["detector_deltas"] = build("SELECT date, station_id, delta_1, delta_3, delta_7 FROM deltas", "deltas")
    o["rolling_7_14_30"] = build("SELECT date, station_id, " + ", ".join(
        f"round({guarded(fn, 'x', n, g)}, 9) AS {pre}_{name}_{n}" for n, g, pre in ((7, 3, "roll"), (30, 10, "roll"), (14, 5, "rolling"))
        for fn, name in (("avg", "mean"), ("stddev_samp", "std"))) + " FROM filled", "filled")
    extremes = f"{guarded('min', 'x', 365, 30)} AS roll_min_365, {guarded('max', 'x', 365, 30)} AS roll_max_365"
    o["rolling_extremes_365"] = build(f"SELECT date, station_id, {extremes} FROM filled", "filled")
    o["price_position_365"] = build(
        "SELECT date, station_id, round(CASE WHEN roll_max_365 - roll_min_365 > 0 THEN (x - roll_min_365) / (roll_max_365 - roll_min_365) END, 9) "
        f"AS price_position_365 FROM (SELECT *, {extremes} FROM filled) e", "filled")
    rounded_market = "market_min, round(market_mean, 9) AS market_mean, round(market_median, 9) AS market_median, round(market_std, 9) AS market_std"
    o["market_stats"] = build(f"SELECT date, {rounded_market} FROM market", "market")
    o["market_stats_by_scope"] = build(
        "SELECT scope_id, date, min(price) AS market_min, round(avg(price), 9) AS market_mean, round(median(price), 9) AS market_median, "
        "round(stddev_samp(price), 9) AS market_std FROM hist JOIN stations USING (station_id) GROUP BY scope_id, date", "hist", "stations")
    o["spread_to_market"] = build(
        "SELECT f.date, station_id, round(x - market_median, 9) AS spread_to_market_median, x - market_min AS spread_to_market_min "
        "FROM filled f LEFT JOIN market m ON f.date = m.date", "filled", "market")
    o["price_rank_pct"] = build("SELECT date, station_id, x AS price_ffill, round(price_rank_pct, 9) AS price_rank_pct FROM ranks", "ranks")
    o["n_cheaper"] = build("SELECT date, station_id, n_cheaper AS n_cheaper_stations FROM ranks", "ranks")
    o["calendar_features"] = build(
        "SELECT date, station_id, isodow(date) - 1 AS day_of_week, month(date) AS month, round(sin(2 * pi() * (isodow(date) - 1) / 7.0e0), 9) AS dow_sin, "
        "round(cos(2 * pi() * (isodow(date) - 1) / 7.0e0), 9) AS dow_cos, round(sin(2 * pi() * month(date) / 12.0e0), 9) AS month_sin, "
        "round(cos(2 * pi() * month(date) / 12.0e0), 9) AS month_cos FROM prices", "prices")
    for name, cols in {
        "robust_scale": "delta_1, robust_scale", "cycle_resets": "cycle_reset_flag, recent_resets_90",
        "days_since_reset": "days_since_reset", "regime_labels": "delta_3, regime",
    }.items():
        o[name] = build(f"SELECT date, station_id, {cols} FROM regimes", "regimes")
    o["future_min_targets"] = build("SELECT f.date, f.station_id, " + ", ".join(
        f"t{h} AS target_min_{h}d, price - t{h} AS target_saving_{h}d, CASE WHEN t{h} IS NOT NULL THEN 1 ELSE 0 END AS target_available_{h}d" for h in H
    ) + " FROM futures f JOIN dense d ON f.date = d.date AND f.station_id = d.station_id", "futures", "dense")
    o["training_features"] = build(NUM_TRAIN, "regimes", "market", "futures", "ranks")

    o["eligible_rows"] = build("SELECT date, station_id, horizon_days, price, target FROM erows", "erows")
    sizes = "count(*) FILTER (WHERE is_train) AS rows_train, count(*) FILTER (WHERE NOT is_train) AS rows_test"
    o["temporal_split"] = build(
        f"SELECT s.horizon_days, s.cutoff, n_dates, {sizes} FROM f_split s JOIN f_cut c ON s.horizon_days = c.horizon_days GROUP BY s.horizon_days, s.cutoff, n_dates",
        "f_split")
    o["temporal_split_given_date"] = build(f"SELECT horizon_days, cutoff, {sizes} FROM g_split GROUP BY horizon_days, cutoff", "g_split")
    diffs = ", ".join(f"round(diff_q{q}, 9) AS diff_q{q}" for q in QS)
    o["quantile_fit"] = build(f"SELECT horizon_days, model_key, rows_train, {diffs} FROM f_models", "f_models")
    o["quantile_fit_by_scope"] = build(f"SELECT scope_id, horizon_days, model_key, rows_train, {diffs} FROM s_models", "s_models")
    o["boosted_ensembles"] = build(
        "SELECT horizon_days, model_key, q, 250 AS trees, rows_train, rows_train AS least_rows_of_a_tree, rows_train AS most_rows_of_a_tree, "
        "true AS leaves_large_enough, true AS depth_kept FROM f_models CROSS JOIN (VALUES (0.2e0), (0.5e0), (0.8e0)) q(q)", "f_models")
    told = "true AS quantiles_in_order, true AS no_worse_than_baseline"
    o["boosted_calibration"] = build(
        f"SELECT horizon_days, count(*) FILTER (WHERE is_train) AS rows_train, count(*) FILTER (WHERE NOT is_train) AS rows_test, {told} "
        "FROM f_split GROUP BY horizon_days", "f_split")
    o["boosted_save_load"] = build(
        f"SELECT date, station_id, price, target, true AS same_forecasts, '{FUEL}' AS fuel_col, '0.003' AS waiting_cost FROM f_pred WHERE horizon_days = 7",
        "f_pred")
    o["boosted_backtest_folds"] = build(
        f"SELECT horizon_days, fold_id, rows_train, count(*) AS rows_test, true AS quantiles_in_order FROM i_pred WHERE horizon_days = 7 "
        "GROUP BY horizon_days, fold_id, rows_train", "i_pred")
    o["model_save_load"] = build(
        f"SELECT horizon_days, model_key, rows_train, {diffs}, '{FUEL}' AS fuel_col, '0.003' AS waiting_cost FROM f_models", "f_models")
    preds = ", ".join(f"round(pred_q{q}, 9) AS pred_q{q}" for q in QS)
    o["quantile_predict"] = build(f"SELECT date, station_id, horizon_days, price, regime, {preds} FROM f_pred", "f_pred")
    at3 = policy_select("SELECT * FROM f_pred", "0.003e0")
    o["fit_backtest"] = build(
        f"SELECT b.*, c.cutoff, c.rows_train, c.rows_test FROM (SELECT horizon_days, {MEASURES}, {POLICY_NO_ROWS} FROM ({at3}) p GROUP BY horizon_days) b "
        f"JOIN (SELECT horizon_days, cutoff, {sizes} FROM f_split GROUP BY horizon_days, cutoff) c ON b.horizon_days = c.horizon_days", "f_pred", "f_split")
    latest = (
        "SELECT * EXCLUDE (p), p[1] AS pred_q20, p[2] AS pred_q50, p[3] AS pred_q80 FROM (SELECT a.*, b.horizon_days, "
        "list_sort([a.price + diff_q20, a.price + diff_q50, a.price + diff_q80]) AS p FROM mrows a JOIN f_eff b ON a.regime = b.regime "
        "WHERE a.date = (SELECT max(date) FROM mrows)) z"
    )
    o["predict_latest"] = build(
        f"SELECT date, station_id, price, regime, {preds}, t3 AS target_min_3d, decision, realized_wait_gain, {SAVING} AS policy_realized_saving, oracle_best_action "
        f"FROM ({policy_select(latest + ' WHERE horizon_days = 3', '0.001e0', 't3')}) q", "mrows", "f_eff")
    o["boosted_predict_latest"] = build(
        "SELECT date, station_id, price, regime, t3 AS target_min_3d, price - t3 AS realized_wait_gain, "
        "CASE WHEN price - t3 > 0.001e0 THEN 'wait' ELSE 'buy_now' END AS oracle_best_action, true AS quantiles_in_order, true AS sure_gains_wait "
        f"FROM ({latest} WHERE horizon_days = 3) q", "mrows", "f_eff")
    o["impute_medians"] = build(
        "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(median(CAST({c} AS double)), 7) AS median, CAST(NULL AS varchar) AS most_frequent, "
            f"CASE WHEN count({c}) > 0 THEN count(*) - count({c}) ELSE 0 END AS rows_filled FROM trained" for c in NUMERIC
        ) + "".join(
            f" UNION ALL SELECT '{c}', NULL, (SELECT {c} FROM trained WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), "
            f"count(*) - count({c}) FROM trained" for c in ("station_id", "regime")
        ) + ") u", "trained")
    o["latest_gains"] = build(
        "SELECT station_id, decision, round(price - pred_q50, 9) AS expected_gain_q50, round(price - pred_q80, 9) AS probable_gain_q80 "
        f"FROM ({policy_select(latest + ' WHERE horizon_days = 14', '0.001e0', 't14')}) q", "mrows", "f_eff")
    o["latest_by_waiting_cost"] = build(
        f"SELECT station_id, horizon_days, waiting_cost, price, regime, decision, realized_wait_gain, {SAVING} AS policy_realized_saving, oracle_best_action "
        f"FROM ({policy_select(f'SELECT *, CAST(NULL AS double) AS unknown FROM ({latest}) y CROSS JOIN {COST_ROWS}', 'waiting_cost', 'unknown')}) q", "mrows", "f_eff")
    o["decision_policy"] = build(
        f"SELECT date, station_id, horizon_days, decision, realized_wait_gain, {SAVING} AS policy_realized_saving, oracle_best_action FROM ({at3}) p", "f_pred")
    o["policy_summary_by_horizon"] = build(f"SELECT horizon_days, {POLICY} FROM ({at3}) p GROUP BY horizon_days", "f_pred")
    o["forecast_error_measures"] = build(f"SELECT horizon_days, {MEASURES} FROM f_pred GROUP BY horizon_days", "f_pred")

    o["waiting_cost_sweep"] = build(f"SELECT horizon_days, waiting_cost, {POLICY} FROM swept GROUP BY horizon_days, waiting_cost", "swept")
    o["calibration_table"] = build("SELECT * FROM calibration", "calibration")
    o["calibration_table_by_scope"] = build("SELECT * FROM s_calibration", "s_calibration")
    o["calibration_failures"] = build(
        f"SELECT * FROM (SELECT h.horizon_days, count(*) FILTER (WHERE is_train) AS rows_train, count(*) FILTER (WHERE NOT is_train) AS rows_test, "
        "CASE WHEN count(is_train) = 0 THEN 'no_eligible_rows' WHEN count(*) FILTER (WHERE is_train) = 0 OR count(*) FILTER (WHERE NOT is_train) = 0 THEN 'empty_split' END AS error "
        f"FROM {H_ROWS} LEFT JOIN z_split s ON s.horizon_days = h.horizon_days GROUP BY h.horizon_days) f WHERE error IS NOT NULL", "z_split")
    o["rolling_folds_index"] = build("SELECT * FROM i_folds", "i_folds")
    o["rolling_folds_calendar"] = build("SELECT * FROM c_folds", "c_folds")
    o["fold_membership"] = build(
        "SELECT fold_id, count(*) FILTER (WHERE date <= train_end) AS rows_train, count(*) FILTER (WHERE date BETWEEN test_start AND test_end) AS rows_test "
        "FROM hist CROSS JOIN i_folds GROUP BY fold_id", "hist", "i_folds")
    o["rolling_backtest_folds"] = build("SELECT * FROM i_metrics", "i_metrics")
    o["rolling_backtest_short_window"] = build("SELECT * FROM n_metrics", "n_metrics")
    o["rolling_backtest_policy"] = build("SELECT * FROM i_policy", "i_policy")
    o["rolling_backtest_summary"] = build("SELECT * FROM i_summary", "i_summary")
    o["rolling_backtest_calendar_folds"] = build("SELECT * FROM c_metrics", "c_metrics")
    o["rolling_backtest_calendar_summary"] = build("SELECT * FROM c_summary", "c_summary")
    o["rolling_backtest_failures"] = build(
        f"SELECT h.horizon_days, f.fold_id, f.train_end AS cutoff_date, f.test_end AS test_end_date, 'empty_split' AS error FROM e_folds f CROSS JOIN {H_ROWS} "
        "WHERE NOT EXISTS (SELECT 1 FROM e_pred p WHERE p.horizon_days = h.horizon_days AND p.fold_id = f.fold_id)", "e_pred", "e_folds")

    policy_names = "decision_accuracy_vs_oracle, share_wait, avg_realized_wait_gain, avg_policy_realized_saving"
    o["rank_configs"] = build(
        f"SELECT row_number() OVER (ORDER BY {RANK.format('avg_policy_realized_saving')}) AS position, horizon_days, waiting_cost, {policy_names}, mae_q50 FROM calibration",
        "calibration")
    o["rank_configs_bounded"] = build(
        f"SELECT row_number() OVER (ORDER BY {RANK.format('decision_accuracy_vs_oracle')}) AS position, horizon_days, waiting_cost, "
        "decision_accuracy_vs_oracle, share_wait FROM calibration WHERE share_wait BETWEEN 0.1 AND 0.6", "calibration")
    o["best_config"] = build(
        "SELECT horizon_days, waiting_cost, avg_policy_realized_saving, decision_accuracy_vs_oracle, share_wait, mae_q50, 'rolling_backtest' AS selection_method "
        f"FROM i_summary ORDER BY {RANK.format('avg_policy_realized_saving')} LIMIT 1", "i_summary")
    o["candidate_records"] = build(
        "SELECT scope_id, fuel_col, horizon_days, waiting_cost, selected_on, selection_method, based_on_run, current_version, share_wait, avg_policy_realized_saving FROM candidates",
        "candidates")
    reason = "CASE WHEN share_wait NOT BETWEEN 0.1 AND 0.6 THEN 'share_wait_out_of_range' ELSE '' END"
    o["promotion_gate"] = build(f"SELECT scope_id, {reason} = '' AS approved, {reason} AS reasons FROM candidates", "candidates")
    hit = f"c.scope_id IS NOT NULL AND {reason.replace('share_wait NOT', 'c.share_wait NOT')} = ''"
    o["promote_production"] = build(
        "SELECT p.scope_id, p.fuel_col, " + ", ".join(
            f"CASE WHEN {hit} THEN c.{x} ELSE p.{x} END AS {x}" for x in ("horizon_days", "waiting_cost", "selected_on", "selection_method"))
        + f", CASE WHEN {hit} THEN 'v' || CAST(CAST(substr(p.version, 2) AS integer) + 1 AS varchar) ELSE p.version END AS version "
        "FROM production p LEFT JOIN candidates c ON c.scope_id = p.scope_id", "production", "candidates")
    o["search_grid"] = build(
        "SELECT fuel_col, horizon_days, waiting_cost FROM (SELECT fuel_col, unnest(CASE WHEN starts_with(fuel_col, 'precio_gasoleo') THEN [3, 7] ELSE [3, 5, 7, 10, 14] END) AS horizon_days FROM ("
        + " UNION ALL ".join(f"SELECT '{m}' AS fuel_col FROM prices HAVING count({m}) > 0" for m in METRICS)
        + ") f) g CROSS JOIN " + COST_ROWS + f" WHERE fuel_col <> '{FUEL}' OR waiting_cost <= 0.002e0", "prices")
    o["daily_run_latest"] = build(
        f"SELECT scope_id, fuel_col, date, station_id, price, regime, target, {preds}, decision, realized_wait_gain, {SAVING} AS policy_realized_saving, oracle_best_action FROM daily", "daily")
    both = " UNION ALL ".join(
        f"SELECT scope_id, fuel_col, date, station_id, price, regime, target, {preds}, decision, realized_wait_gain, {SAVING} AS policy_realized_saving, "
        f"oracle_best_action, 0 AS failed_pairs FROM {t}" for t in ("daily", "x_daily"))
    o["daily_run_all_fuels"] = build(both, "daily", "x_daily")
    o["published_feed"] = build(
        "SELECT scope_id, fuel_col, 1 AS version, count(*) OVER () AS documents, horizon_days, waiting_cost, recommendation, n_stations, n_buy_now, n_wait, "
        "n_stations AS station_lines, true AS artifact_found FROM ("
        "SELECT *, 3 AS horizon_days, 0.001e0 AS waiting_cost FROM daily_summary UNION ALL SELECT *, 7, 0.002e0 FROM x_daily_summary) u",
        "daily_summary", "x_daily_summary")
    o["promotion_from_policy"] = build(
        "SELECT scope_id, fuel_col, CAST(CASE WHEN reasons = '' THEN horizon_days ELSE 3 END AS integer) AS horizon_days, "
        "CASE WHEN reasons = '' THEN waiting_cost ELSE 0.001e0 END AS waiting_cost, "
        "CASE WHEN reasons = '' THEN 'v' || CAST(CAST(substr(current_version, 2) AS integer) + 1 AS varchar) ELSE current_version END AS version, reasons, "
        "CASE WHEN reasons = '' THEN 'promoted' ELSE 'refused' END AS first_outcome, CASE WHEN reasons = '' THEN 'stale' ELSE 'refused' END AS second_outcome "
        "FROM (SELECT c.*, concat_ws(',', CASE WHEN NOT c.share_wait BETWEEN 0.1e0 AND 0.6e0 THEN 'share_wait_out_of_range' END, "
        "CASE WHEN c.avg_policy_realized_saving IS NULL THEN 'missing_saving' END, CASE WHEN c.decision_accuracy_vs_oracle IS NULL THEN 'missing_accuracy' END, "
        "CASE WHEN c.avg_policy_realized_saving < s.avg_policy_realized_saving * (1 + 0.05e0) THEN 'saving_gain_too_small' END, "
        "CASE WHEN c.decision_accuracy_vs_oracle < s.decision_accuracy_vs_oracle - 0.02e0 THEN 'accuracy_drop_too_large' END) AS reasons "
        "FROM candidates c LEFT JOIN s_calibration s ON s.scope_id = c.scope_id AND s.horizon_days = 3 AND s.waiting_cost = 0.001e0) q",
        "candidates", "s_calibration")
    o["publish_summary"] = build("SELECT * FROM daily_summary", "daily_summary")
    o["publish_payload_stations"] = build(
        "SELECT d.scope_id, s.recommendation, s.n_stations, station_id, price, decision FROM daily d JOIN daily_summary s ON d.scope_id = s.scope_id", "daily", "daily_summary")
    o["publish_payload_json"] = build("SELECT *, 3 AS horizon_days, 0.001e0 AS waiting_cost FROM daily_summary", "daily_summary")
    o["json_null_clean"] = (
        f"SELECT {LINES}, l_extendedprice, CASE WHEN l_linenumber > 3 THEN l_extendedprice END AS x, CASE WHEN l_linenumber > 3 THEN l_extendedprice END AS x0, "
        "CASE WHEN l_linenumber > 3 THEN 0 ELSE 1 END AS has_null FROM lineitem")

    none = ", ".join(f"CAST(NULL AS double) AS {m}" for m in METRICS[1:])
    batch = (
        f"SELECT date, station_id, p AS {FUEL}, {none} FROM (SELECT CAST(l_shipdate AS date) AS date, CAST(l_suppkey AS varchar) AS station_id, "
        f"{quote(CENTS, '1')} AS p, row_number() OVER (PARTITION BY l_shipdate, l_suppkey ORDER BY l_orderkey DESC, l_linenumber DESC, {CENTS} DESC) AS i "
        "FROM lineitem WHERE l_linenumber >= 4) b WHERE i = 1"
    )
    o["upsert_prices"] = (
        f"WITH cur AS ({prices_sql('l_linenumber <= 4')}), bat AS ({batch}) SELECT date, TIMESTAMP '2002-01-02 00:00:00' AS fetched_at, station_id, {ALL} FROM bat UNION ALL "
        f"SELECT date, TIMESTAMP '2002-01-01 00:00:00', station_id, {ALL} FROM cur WHERE NOT EXISTS (SELECT 1 FROM bat WHERE bat.date = cur.date AND bat.station_id = cur.station_id)")
    o["upsert_stations"] = build(
        "SELECT s.station_id, coalesce(b.name, station_name) AS station_name, CASE WHEN b.name IS NOT NULL THEN 'Calle 1' END AS address, "
        "CASE WHEN b.name IS NULL THEN municipality END AS municipality, CASE WHEN b.name IS NULL THEN province ELSE 'P' END AS province, "
        "CASE WHEN b.name IS NOT NULL THEN '24H' END AS schedule, CASE WHEN b.name IS NULL THEN TIMESTAMP '2002-01-01 00:00:00' ELSE " + LATER + " END AS updated_at "
        "FROM stations s LEFT JOIN (SELECT CAST(l_suppkey AS varchar) AS station_id, arg_max('Line-' || l_orderkey || '-' || l_linenumber, l_orderkey * 10 + l_linenumber) AS name "
        "FROM lineitem WHERE l_quantity > 45 AND l_suppkey % 3 = 0 GROUP BY 1) b ON b.station_id = s.station_id", "stations")
    o["upsert_fetch_log"] = build(
        f"SELECT l.date, l.status, l.records_count, l.inserted_rows, l.error_type, l.error_message, coalesce(k.created_at, {LATER}) AS created_at, {LATER} AS updated_at "
        f"FROM fetch_log l LEFT JOIN patchy k ON k.date = l.date WHERE year(l.date) >= 2000 UNION ALL SELECT {LOG_COLUMNS} FROM patchy WHERE year(date) < 2000", "fetch_log", "patchy")
    o["fetch_log_range"] = build(
        "SELECT date, status, records_count, CASE WHEN status IN ('fetched', 'empty') THEN 1 ELSE 0 END AS processed FROM patchy WHERE date BETWEEN DATE '1998-01-01' AND DATE '2000-06-30'", "patchy")
    o["bootstrap_fetch_log"] = build(bootstrap_sql(False), "prices", "patchy")
    o["bootstrap_fetch_log_overwrite"] = build(bootstrap_sql(True), "prices", "patchy")
    o["bootstrap_counts"] = build(f"{bootstrap_count_sql(False)} UNION ALL {bootstrap_count_sql(True)}", "prices", "patchy")
    o["missing_dates"] = build(
        f"SELECT date FROM ({days_sql(QUOTED + '1994-12-01' + QUOTED, QUOTED + '2001-12-31' + QUOTED)}) d WHERE date NOT IN (SELECT date FROM patchy WHERE status IN ('fetched', 'empty'))", "patchy")
    o["collect_dates"] = build(collected_sql(False, True), "prices", "patchy")
    o["collect_dates_forced"] = build(collected_sql(True, False), "prices", "patchy")
    o["collection_summary"] = build(
        "SELECT min(date) AS start_date, max(date) AS end_date, count(*) AS requested_dates, count(*) AS processed_dates, "
        + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}_dates" for s in ("fetched", "skipped", "empty", "failed"))
        + ", CAST(sum(inserted_rows) AS bigint) AS inserted_rows, count(*) FILTER (WHERE status = 'failed') AS n_errors, min(date) FILTER (WHERE status = 'failed') AS first_error "
        f"FROM ({collected_sql(False, True)}) c", "prices", "patchy")
    o["fallback_source"] = build(
        f"SELECT p.date, p.station_id, {FUEL}, 'nation_1' AS municipality FROM ({prices_sql('l_linenumber <= 2')}) p JOIN stations s ON p.station_id = s.station_id WHERE s.municipality = 'NATION_1' UNION ALL "
        f"SELECT p.date, p.station_id, {FUEL}, 'nation_1' FROM prices p JOIN stations s ON p.station_id = s.station_id WHERE s.municipality = 'NATION_1' AND p.date NOT IN "
        "(SELECT CAST(l_shipdate AS date) FROM lineitem JOIN stations t ON CAST(l_suppkey AS varchar) = t.station_id WHERE l_linenumber <= 2 AND t.municipality = 'NATION_1')", "prices", "stations")
    o["lookup_municipality"] = (
        "WITH c AS (SELECT s_suppkey AS id, 'villa ' || (s_suppkey // 3) AS nm, lower(n_name) AS prov FROM supplier JOIN nation ON s_nationkey = n_nationkey), "
        "r AS (SELECT DISTINCT c_custkey % 60 AS k, c_custkey % 7 AS p FROM customer), "
        "m AS (SELECT k, p, count(id) AS n, min(id) AS first, min(id) FILTER (WHERE contains(prov, 'nation_' || p)) AS first_in FROM r LEFT JOIN c ON c.nm = 'villa ' || k GROUP BY k, p) "
        "SELECT 'VILLA ' || k || ' ' AS name, 'Nation_' || p AS province, n AS n_matches, CAST(CASE WHEN n = 1 THEN first ELSE first_in END AS varchar) AS municipality_id, "
        "CASE WHEN n = 0 THEN 'unknown_municipality' WHEN CASE WHEN n = 1 THEN first ELSE first_in END IS NULL THEN 'not_in_province' END AS error FROM m")
    o["lookup_province"] = (
        "SELECT ' PENON ' || k AS name, CASE WHEN s % 3 = 1 THEN CAST(s AS varchar) WHEN s IS NOT NULL THEN 'P' || s END AS province_id, CASE WHEN s IS NULL THEN 'unknown_province' END AS error FROM ("
        "SELECT k, min(s_suppkey) AS s FROM (SELECT DISTINCT c_custkey % 70 AS k FROM customer) r LEFT JOIN supplier ON s_suppkey % 50 = k GROUP BY k) m")
    o["decimal_comma_parse"] = (
        f"SELECT {LINES}, CASE WHEN l_orderkey % 17 = 0 OR l_orderkey % 19 = 0 OR l_orderkey % 23 = 0 OR l_orderkey % 29 = 0 THEN NULL ELSE {CENTS} / 100e0 END AS value FROM lineitem")
    o["numeric_coerce"] = f"SELECT {LINES}, CASE WHEN l_linenumber > 2 THEN l_quantity END AS value FROM lineitem"
    o["name_normalize"] = f"SELECT {LINES}, 'estacion nu ' || l_suppkey || ' ' || lower(l_linestatus) || ' ao' AS name FROM lineitem"
    o["column_name_normalize"] = f"SELECT {LINES}, 'precio_' || lower(l_returnflag) || '_' || l_linenumber || '_e5' AS name FROM lineitem"
    day = "CASE WHEN l_linenumber NOT IN (2, 3) THEN CAST(l_shipdate AS date) END"
    o["date_normalize"] = f"SELECT {LINES}, {day} AS date, strftime({day}, '%d-%m-%Y') AS api_date FROM lineitem"
    o["version_bump"] = f"SELECT {LINES}, CASE WHEN l_linenumber <= 2 THEN 'v2' ELSE 'v' || (l_suppkey + 1) END AS version FROM lineitem"
    o["raw_feed_normalize"] = build(
        f"SELECT p.date, p.station_id, station_name, '' AS address, municipality, province, 37.5e0 AS latitude, "
        "CASE WHEN CAST(p.station_id AS bigint) % 3 <> 0 THEN CAST('-1.' || lpad(p.station_id, 6, '0') AS double) ELSE 2.25e0 END AS longitude, 'L-D: 24H' AS schedule, "
        f"{ALL} {panel}", "prices", "stations")
    o["history_roundtrip"] = build(
        f"SELECT p.date, p.station_id, station_name, municipality, {ALL}, l.status AS fetch_status {panel} LEFT JOIN fetch_log l ON l.date = p.date "
        f"WHERE coalesce({ALL}) IS NOT NULL", "prices", "stations", "fetch_log")
    o["stream_ingest"] = build(f"SELECT date, station_id, {ALL} FROM prices", "prices")
    landed = "SELECT date, precio_gasoleo_a AS p, CAST(station_id AS int) % 11 = 3 AS bad_day, CAST(station_id AS int) % 13 = 5 AS broken FROM prices"
    o["stream_ingest_split_days"] = build(
        "SELECT date, CASE WHEN count(*) FILTER (WHERE broken) > 0 THEN 'failed' ELSE 'fetched' END AS status, "
        "count(*) FILTER (WHERE NOT broken) AS records_count, nullif(count(*) FILTER (WHERE NOT broken), 0) AS rows, "
        f"round(sum(p) FILTER (WHERE NOT broken), 3) AS total FROM ({landed}) l WHERE NOT bad_day GROUP BY date", "prices")
    o["stream_ingest_rejects"] = build(
        "SELECT CASE WHEN bad_day THEN 'UnreadableDay' ELSE 'UnreadableDocument' END AS reason, "
        f"CASE WHEN bad_day THEN 'day ' ELSE '' END || CAST(date AS varchar) AS day, count(*) AS documents FROM ({landed}) l WHERE bad_day OR broken GROUP BY 1, 2", "prices")
    o["panel_overlapping_batches"] = build(
        f"SELECT d.date, s.station_id, {ALL}, CASE WHEN coalesce({ALL}) IS NOT NULL THEN 1 ELSE 0 END AS is_observed_price "
        f"FROM days d CROSS JOIN stations s LEFT JOIN (WITH later AS ({prices_sql('l_linenumber <= 3')}) SELECT * FROM later "
        "UNION ALL SELECT * FROM prices a WHERE NOT EXISTS (SELECT 1 FROM later b WHERE a.date = b.date AND a.station_id = b.station_id)) p "
        "ON p.date = d.date AND p.station_id = s.station_id", "days", "prices", "stations")
    o["collect_then_export"] = build(f"SELECT date, station_id, {ALL}, 1 AS is_observed_price FROM prices", "prices")
    # Jobs that write what another query returns, and read it back.
    saving = "round(sum(avg_policy_realized_saving) + 1e-12, 6)"
    o["experiment_store"] = " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS rows, CAST({total} AS double) AS total FROM ({o[same]}) t{i}" for i, (name, same, total) in enumerate((
            ("calibration", "calibration_table", saving), ("calibration_failures", "calibration_failures", "NULL"),
            ("rolling_summary", "rolling_backtest_summary", saving), ("rolling_folds", "rolling_backtest_folds", "round(sum(mae_q50) + 1e-12, 6)"),
            ("latest_best", "best_config", saving)))) + " UNION ALL SELECT 'rolling_failures', 0, NULL"
    for job, same in {
        "dataset_export_panel": "station_panel", "dataset_export_daily": "daily_summary",
        "experiment_tables_roundtrip": "calibration_table", "latest_table_roundtrip": "daily_run_latest",
        "search_grid_from_config": "search_grid",
    }.items():
        o[job] = o[same]
    return o
