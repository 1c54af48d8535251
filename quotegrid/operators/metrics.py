"""Forecast error measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quotegrid.schema import QUANTILES, quantile_column


def metric_aggregates(target: str, quantiles: Sequence[float] = QUANTILES) -> list[Column]:
    """MAE and pinball loss per quantile and RMSE of the median; NULL errors are left out."""
    out = []
    for q in quantiles:
        suffix = quantile_column(q).removeprefix("pred_")
        error = F.col(target) - F.col(quantile_column(q))
        out.append(F.avg(F.abs(error)).alias(f"mae_{suffix}"))
        out.append(F.avg(F.when(error >= 0, q * error).otherwise((q - 1.0) * error)).alias(f"pinball_{suffix}"))
        if abs(q - 0.5) < 1e-9:
            out.append(F.sqrt(F.avg(error * error)).alias(f"rmse_{suffix}"))
    return out


def forecast_metrics(df: DataFrame, target: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*metric_aggregates(target))
