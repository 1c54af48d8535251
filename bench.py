"""Headline queries, wall time each: prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads, ``BENCH_QUERIES`` (optional,
comma separated) the queries.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from quotegrid import catalog

HEADLINE = [
    "station_panel", "panel_full_calendar", "daily_summary", "latest_best_price_diesel", "ffill_limit3",
    "rolling_7_14_30", "price_position_365", "market_stats", "price_rank_pct", "regime_labels",
    "future_min_targets", "training_features", "calibration_table", "rolling_backtest_summary",
    "daily_run_latest", "upsert_prices", "raw_feed_normalize", "boosted_save_load",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("quotegrid-bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus) if cpus.isdigit() else 16))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.ROUNDING = False
    catalog.QUERIES["date_bounds"](spark, folder).collect()  # starts the executor threads
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
