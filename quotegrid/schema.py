"""Table schemas and fixed names of the price-panel data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Feed field names, their groups and display labels.
FUEL_FIELDS = {
    "diesel": [
        "Precio Gasoleo A",
        "Precio Gasoleo B",
        "Precio Gasoleo Premium",
    ],
    "gasolina": [
        "Precio Gasolina 95 E5",
        "Precio Gasolina 95 E10",
        "Precio Gasolina 95 E5 Premium",
        "Precio Gasolina 98 E5",
        "Precio Gasolina 98 E10",
    ],
}
FUEL_LABELS = {
    "Precio Gasoleo A": "Diésel A",
    "Precio Gasoleo B": "Diésel B",
    "Precio Gasoleo Premium": "Diésel Premium",
    "Precio Gasolina 95 E5": "Gasolina 95",
    "Precio Gasolina 95 E10": "Gasolina 95 E10",
    "Precio Gasolina 95 E5 Premium": "Gasolina 95 Premium",
    "Precio Gasolina 98 E5": "Gasolina 98",
    "Precio Gasolina 98 E10": "Gasolina 98 E10",
}


def column_name(field: str) -> str:
    """Column name of a feed field: lower case, every run of other characters an underscore."""
    kept = "".join(ch if ch.isascii() and ch.isalnum() else " " for ch in field.lower())
    return "_".join(kept.split())


METRIC_GROUPS = {group: [column_name(f) for f in fields] for group, fields in FUEL_FIELDS.items()}
METRICS = [m for group in METRIC_GROUPS.values() for m in group]
METRIC_LABELS = {column_name(f): label for f, label in FUEL_LABELS.items()}

STATION_ATTRIBUTES = [
    "station_name", "address", "municipality", "province", "latitude", "longitude", "schedule",
]

STATIONS = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("station_name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("municipality", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("schedule", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
])

PRICES = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("station_id", T.StringType()),
    ]
    + [T.StructField(m, T.DoubleType()) for m in METRICS]
)

FETCH_LOG = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("status", T.StringType()),
    T.StructField("records_count", T.LongType()),
    T.StructField("inserted_rows", T.LongType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

TABLES = {"stations": STATIONS, "prices": PRICES, "fetch_log": FETCH_LOG}

# Regime and decision labels, model defaults.
REGIMES = ["shock_up", "shock_down", "cyclical", "stable"]
DEFAULT_REGIME = "stable"
GLOBAL_MODEL = "__global__"
WAIT, BUY_NOW, NO_DATA = "wait", "buy_now", "no_data"
QUANTILES = (0.2, 0.5, 0.8)
MIN_ROWS_PER_REGIME = 150

# The features of the boosted model, in its order.
CATEGORICAL_FEATURES = ["station_id", "regime"]
NUMERIC_FEATURES = [
    "price", "price_ffill",
    "market_min", "market_mean", "market_median", "market_std",
    "delta_1", "delta_3", "delta_7",
    "rolling_std_14", "rolling_mean_14",
    "days_since_reset", "recent_resets_90",
    "lag_1", "lag_2", "lag_3", "lag_7", "lag_14", "lag_30",
    "change_1", "change_3", "change_7", "change_14",
    "roll_mean_7", "roll_std_7", "roll_mean_30", "roll_std_30",
    "price_position_365",
    "spread_to_market_median", "spread_to_market_min",
    "price_rank_pct", "n_cheaper_stations",
    "day_of_week", "month", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "is_observed_price",
]


def quantile_column(q: float) -> str:
    """``0.2`` -> ``pred_q20``."""
    return f"pred_q{round(q * 100):02d}"
