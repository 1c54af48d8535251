"""A cross-section of the catalog against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import table

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "station_panel", "panel_full_calendar", "daily_summary_full_calendar", "latest_best_price_diesel", "panel_profile",
    "price_rank_pct", "regime_labels", "calibration_table", "rolling_backtest_short_window", "best_config",
    "promotion_gate", "publish_summary", "upsert_prices", "collect_dates", "lookup_municipality", "raw_feed_normalize",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = entry.queries()[name](spark, FOLDER)
    cur = con.execute(entry.oracle_sql()[name])
    want = table([c[0] for c in cur.description], cur.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == want


def test_entry(spark):
    assert entry.entry(spark).count() == 25
