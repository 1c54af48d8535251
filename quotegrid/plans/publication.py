"""Recommendation summaries per scope and the published payload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from quotegrid.functions.text import finite
from quotegrid.schema import BUY_NOW, NO_DATA, WAIT

SCOPE = ("scope_id", "fuel_col")


def publish_summary(latest: DataFrame, keys: Sequence[str] = SCOPE, scopes: DataFrame | None = None) -> DataFrame:
    """Per scope: counts of decisions, the cheapest station, and the station to go to.

    That is the cheapest one with ``buy_now``, else the cheapest of all; stations without a price come last. Scopes of ``scopes``
    without a station get the recommendation ``no_data``.
    """
    keys = list(keys)
    station = F.struct(F.col("price").isNull().alias("no_price"), "price", "station_id")
    buy = F.col("decision") == BUY_NOW
    grouped = latest.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_stations"),
        F.count_if(buy).alias("n_buy_now"),
        F.count_if(F.col("decision") == WAIT).alias("n_wait"),
        F.min(station).alias("_cheapest"),
        F.min(F.when(buy, station)).alias("_buy"),
    )
    if scopes is not None:
        grouped = scopes.select(*keys).join(grouped, keys, "left").fillna(0, ["n_stations", "n_buy_now", "n_wait"])
    chosen = F.coalesce("_buy", "_cheapest")
    recommendation = (
        F.when(F.col("n_stations") == 0, NO_DATA).when(F.col("n_buy_now") > 0, BUY_NOW).otherwise(WAIT)
    )
    return grouped.select(
        *keys, recommendation.alias("recommendation"), "n_stations", "n_buy_now", "n_wait",
        chosen["station_id"].alias("selected_station_id"), chosen["price"].alias("selected_station_price"),
        F.col("_cheapest.station_id").alias("cheapest_station_id"),
        F.col("_cheapest.price").alias("cheapest_station_price"),
    )


def json_ready(df: DataFrame) -> DataFrame:
    """NaN and infinities to NULL in every floating-point column, nested ones included."""

    def clean(c, dtype):
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            return finite(c)
        if isinstance(dtype, T.ArrayType):
            return F.transform(c, lambda x: clean(x, dtype.elementType))
        if isinstance(dtype, T.StructType):
            cleaned = F.struct(*[clean(c[f.name], f.dataType).alias(f.name) for f in dtype.fields])
            return F.when(c.isNotNull(), cleaned)
        return c

    return df.select(*[clean(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def payloads(latest: DataFrame, scopes: DataFrame, models: DataFrame, generated_at) -> DataFrame:
    """``scope_id, fuel_col, payload``: the JSON summary document of each scope and fuel.

    ``scopes``: scope_id, municipality, province. ``models``: production rows (scope_id, fuel_col,
    horizon_days, waiting_cost, selected_on, selection_method, version). The stations are lines of their own
    (:func:`station_lines`), whatever their number; ``artifacts`` names the folder of the scope's lines.
    """
    keys = list(SCOPE)
    heads = models.select(*keys, "horizon_days", "waiting_cost", "selected_on", "selection_method", "version").join(
        scopes.select("scope_id", "municipality", "province"), "scope_id"
    )
    full = heads.join(publish_summary(json_ready(latest), keys, heads), keys)
    known = F.struct("recommendation", "n_stations", "n_buy_now", "n_wait", "selected_station_id",
                     "selected_station_price", "cheapest_station_id", "cheapest_station_price")
    lines = F.concat(F.lit("stations/scope_id="), F.col("scope_id"), F.lit("/fuel_col="), F.col("fuel_col"))
    document = F.struct(
        "scope_id", "municipality", "province", "fuel_col",
        F.struct("horizon_days", "waiting_cost", "selected_on", "selection_method", "version").alias("model"),
        F.lit(generated_at).alias("generated_at"), known.alias("summary"), F.struct(lines.alias("stations")).alias("artifacts"),
    )
    return full.select(*keys, F.to_json(document, {"ignoreNullFields": "false"}).alias("payload"))


def station_lines(latest: DataFrame) -> DataFrame:
    """``scope_id, fuel_col, station_id, line``: one JSON line per station of the latest recommendations."""
    fields = [c for c in latest.columns if c not in SCOPE]
    return json_ready(latest).select(*SCOPE, "station_id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("line"))


# Versions on files ---------------------------------------------------------------------------

MANIFEST = "version long, folder string, documents long, stations long, generated_at string"


def write_version(documents: DataFrame, stations: DataFrame, folder: str, version: int) -> str:
    """The files of one version: a JSON document per scope and fuel, the stations' lines, and the feed of all documents.

    No reader sees them before :func:`commit_version` names them. A run taken up again writes the same folder anew.
    """
    target = f"{folder}/v{version}"
    for name, df, value in (("documents", documents, "payload"), ("stations", stations, "line")):
        df.select(*SCOPE, F.col(value).alias("value")).write.mode("overwrite").partitionBy(*SCOPE).text(f"{target}/{name}")
    feed = documents.select(*SCOPE, "payload").repartitionByRange(*SCOPE).sortWithinPartitions(*SCOPE)
    feed.write.json(f"{target}/feed", mode="overwrite")
    return target


def commit_version(spark: SparkSession, folder: str, version: int, generated_at: str | None = None) -> int:
    """Name the version in the manifest, after its files are complete; readers follow the manifest from then on."""
    newest = published_version(spark, folder)
    if newest is not None and newest["version"] >= version:
        raise ValueError(f"version {version} is not newer than the published {newest['version']}")
    target = f"{folder}/v{version}"
    counts = [spark.read.text(f"{target}/{name}").count() for name in ("documents", "stations")]
    spark.createDataFrame([(version, target, *counts, generated_at)], MANIFEST).coalesce(1).write.mode("append").json(f"{folder}/manifest")
    return version


def published_version(spark: SparkSession, folder: str):
    """The newest manifest row, or None where nothing has been published."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{folder}/manifest")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.orderBy(F.desc("version")).first()  # one row per version


def read_published(spark: SparkSession, folder: str, part: str) -> DataFrame:
    """``feed`` (scope_id, fuel_col, payload), ``documents`` or ``stations`` (scope_id, fuel_col, value) of the published version."""
    newest = published_version(spark, folder)
    if newest is None:
        raise ValueError(f"nothing published in {folder}")
    path = f"{newest['folder']}/{part}"
    if part == "feed":
        return spark.read.schema("scope_id string, fuel_col string, payload string").json(path)
    return spark.read.schema("value string, scope_id string, fuel_col string").text(path)
