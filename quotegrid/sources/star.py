"""Base tables derived from a star schema (``lineitem``, ``supplier``, ``nation``, ``region``).

A supplier is a station, its nation the municipality, its region the province. The price of a day is
a fixed function of the mean line price, in whole thousandths; each further metric covers a part of
the lines. Sums are over whole cents, so they do not depend on the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from quotegrid.functions.text import column_name
from quotegrid.operators.upsert import log_from_prices
from quotegrid.schema import METRICS

CONDITIONS = dict(zip(METRICS, [
    "true", "l_returnflag = 'A'", "l_returnflag = 'R'",
    "l_linenumber = 1", "l_linenumber = 2", "l_linenumber = 3", "l_linenumber = 4", "l_linenumber = 5",
]))
FETCHED_AT = "timestamp '2002-01-01 00:00:00'"


_SCHEMAS: dict[str, T.StructType] = {}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One table; its schema is inferred once per path."""
    path = f"{folder}/{table}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def quote(cents: Column, lines: Column) -> Column:
    return F.floor((1.2 + cents / (F.nullif(lines, F.lit(0)) * 1e7)) * 1000 + 0.5) / 1e3


def prices(spark: SparkSession, folder: str, where: str = "true") -> DataFrame:
    """The price table; ``where`` picks the lines, for batches that overlap."""
    # Grouped by day and the supplier's number: its text is made once per quote, not once per line.
    lines = read(spark, folder, "lineitem").where(where).select(
        F.col("l_shipdate").cast("date").alias("date"), "l_suppkey", "l_returnflag", "l_linenumber",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("_cents"))
    aggs = []
    for metric, cond in CONDITIONS.items():
        on = F.expr(cond)
        aggs += [F.sum(F.when(on, F.col("_cents"))).alias(f"_s_{metric}"), F.count_if(on).alias(f"_n_{metric}")]
    grouped = lines.groupBy("date", "l_suppkey").agg(*aggs)
    return grouped.select(
        "date", F.expr(FETCHED_AT).alias("fetched_at"), F.col("l_suppkey").cast("string").alias("station_id"),
        *[quote(F.col(f"_s_{m}"), F.col(f"_n_{m}")).alias(m) for m in METRICS],
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    """The station table with ``scope_id``, the municipality's market."""
    nation, region = read(spark, folder, "nation"), read(spark, folder, "region")
    # Two fixed lists (25 and 5 rows) become one map, so that the size estimate of the station table
    # is that of the supplier table and not a product of joins.
    place = F.struct(F.col("n_name").alias("municipality"), F.col("r_name").alias("province"))
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).agg(
        F.map_from_entries(F.collect_list(F.struct("n_nationkey", place))).alias("m")
    )
    none = F.lit(None)
    placed = read(spark, folder, "supplier").withColumn("_p", places.select("m").scalar()[F.col("s_nationkey")])
    return placed.where("_p is not null").select(
        F.col("s_suppkey").cast("string").alias("station_id"),
        F.col("s_name").alias("station_name"),
        none.cast("string").alias("address"),
        F.col("_p.municipality").alias("municipality"),
        F.col("_p.province").alias("province"),
        none.cast("double").alias("latitude"),
        none.cast("double").alias("longitude"),
        none.cast("string").alias("schedule"),
        F.expr(FETCHED_AT).alias("updated_at"),
        column_name(F.concat_ws("_", "_p.municipality", "_p.province")).alias("scope_id"),
    )


def fetch_log(spark: SparkSession, folder: str) -> DataFrame:
    """A log as the backfill writes it: every day between the first and last price."""
    days = log_from_prices(prices(spark, folder))
    stamp = F.expr(FETCHED_AT)
    return days.select(
        "date", "status", F.col("records_count").cast("bigint").alias("records_count"),
        F.col("records_count").cast("bigint").alias("inserted_rows"),
        F.lit(None).cast("string").alias("error_type"), F.lit(None).cast("string").alias("error_message"),
        stamp.alias("created_at"), stamp.alias("updated_at"),
    )
