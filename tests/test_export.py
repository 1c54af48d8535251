"""Dataset dispatch and the calendar over overlapping batches."""

import datetime as dt

import pytest

from quotegrid.operators.panel import expand_calendar
from quotegrid.plans.export import DATASETS, dataset


def test_unknown_dataset_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown dataset"):
        dataset(spark.range(1), spark.range(1), kind="weekly")
    assert set(DATASETS.values()) == {"panel", "daily"}


def test_latest_fetch_fills_a_day(spark):
    day = [dt.date(2024, 1, i) for i in range(1, 5)]
    at = [dt.datetime(2024, 2, i) for i in range(1, 4)]
    rows = [
        ("a", day[0], at[0], 1.0), ("a", day[0], at[2], 3.0), ("a", day[0], at[1], 2.0),
        ("a", day[3], at[1], 5.0), ("a", day[3], at[1], 6.0), ("a", day[3], at[0], 9.0),
    ]
    prices = spark.createDataFrame(rows, "station_id string, date date, fetched_at timestamp, price double")
    stations = spark.createDataFrame([("a",), ("b",)], "station_id string")
    got = expand_calendar(prices, stations, metrics=["price"]).collect()
    assert len(got) == 8
    assert {r["date"]: r["price"] for r in got if r["station_id"] == "a"} == {day[0]: 3.0, day[1]: None, day[2]: None, day[3]: 6.0}
