"""Wait-or-buy decision from forecast quantiles, and its evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quotegrid.schema import BUY_NOW, WAIT

DEFAULT_WAITING_COST = 0.003  # fixed value


def decision(cost: Column) -> Column:
    """``wait`` or ``buy_now``; a missing forecast fails its comparison and falls through."""
    probable_gain = F.col("price") - F.coalesce("pred_q80", "pred_q50")
    expected_gain = F.col("price") - F.coalesce("pred_q50", "pred_q20")
    return (
        F.when(probable_gain > cost, WAIT)
        .when(expected_gain <= cost, BUY_NOW)
        .when((F.col("regime") == "cyclical") & (expected_gain > cost / 2), WAIT)
        .otherwise(BUY_NOW)
    )


def with_policy(df: DataFrame, target: str, cost: float | Column = DEFAULT_WAITING_COST) -> DataFrame:
    """Decision, gain of waiting, saving of the policy and the action hindsight would take.

    The saving of a wait with an unknown future stays NULL.
    """
    cost = F.lit(float(cost)) if not isinstance(cost, Column) else cost
    gain = F.col("price") - F.col(target)
    saving = F.when(
        F.col("decision") == WAIT,
        F.when(gain.isNotNull(), F.greatest(gain - cost, F.lit(0.0))),
    ).otherwise(0.0)
    return df.withColumn("decision", decision(cost)).withColumns({
        "realized_wait_gain": gain,
        "policy_realized_saving": saving,
        "oracle_best_action": F.when(gain > cost, WAIT).otherwise(BUY_NOW),
    })


def with_waiting_costs(df: DataFrame, costs: Sequence[float]) -> DataFrame:
    """Every row once per waiting cost. Rows multiply inside the task only, ahead of an aggregate."""
    return df.withColumn("waiting_cost", F.explode(F.array(*[F.lit(float(c)) for c in costs])))


def policy_aggregates() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        F.avg((F.col("decision") == F.col("oracle_best_action")).cast("double")).alias("decision_accuracy_vs_oracle"),
        F.avg((F.col("decision") == WAIT).cast("double")).alias("share_wait"),
        F.avg("realized_wait_gain").alias("avg_realized_wait_gain"),
        F.avg("policy_realized_saving").alias("avg_policy_realized_saving"),
    ]


def policy_summary(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Summary of rows that went through :func:`with_policy`."""
    return df.groupBy(*keys).agg(*policy_aggregates())


def with_gains(df: DataFrame) -> DataFrame:
    """Gains a recommendation rests on."""
    return df.withColumns({
        "expected_gain_q50": F.col("price") - F.col("pred_q50"),
        "probable_gain_q80": F.col("price") - F.col("pred_q80"),
    })
