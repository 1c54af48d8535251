"""Ranking of configurations, candidates and promotion to production."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quotegrid.functions.text import next_version
from quotegrid.session import stage

PRIMARY_METRIC = "avg_policy_realized_saving"


def rank_order(columns: Sequence[str], primary: str = PRIMARY_METRIC) -> list[Column]:
    """Saving and accuracy from the top, error from the bottom; columns a table lacks are left out."""
    order = []
    for name in (primary, "decision_accuracy_vs_oracle", "mae_q50"):
        if name in columns:
            order.append(F.asc_nulls_last(name) if name == "mae_q50" else F.desc_nulls_last(name))
    return order + [F.asc(c) for c in ("horizon_days", "waiting_cost") if c in columns]


def rank_configs(
    results: DataFrame,
    primary: str = PRIMARY_METRIC,
    min_share_wait: float | None = None,
    max_share_wait: float | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Configurations from best to worst with their ``position`` per key, optionally bounded in
    the share of waits. A key holds one row per horizon and cost."""
    if min_share_wait is not None:
        results = results.where(F.col("share_wait") >= min_share_wait)
    if max_share_wait is not None:
        results = results.where(F.col("share_wait") <= max_share_wait)
    w = Window.partitionBy(*(keys or [F.lit(1)])).orderBy(*rank_order(results.columns, primary))
    return results.withColumn("position", F.row_number().over(w)).orderBy(*keys, "position")


def best_configs(calibration: DataFrame, rolling: DataFrame | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """The top row per key: of the rolling summary where it has one, else of the calibration."""
    metrics = ["horizon_days", "waiting_cost", PRIMARY_METRIC, "decision_accuracy_vs_oracle", "share_wait", "mae_q50"]

    def top(df, method, preference):
        ranked = rank_configs(df, keys=keys).where(F.col("position") == 1)
        return ranked.select(*keys, *metrics, F.lit(method).alias("selection_method"), F.lit(preference).alias("_p"))

    tops = top(calibration, "temporal_split", 2)
    if rolling is not None:
        tops = tops.unionByName(top(rolling, "rolling_backtest", 1))
    names = [*metrics, "selection_method"]
    best = F.min_by(F.struct(*names), "_p").alias("_best")
    grouped = tops.groupBy(*keys).agg(best) if keys else tops.agg(best)
    return grouped.where(F.col("_best").isNotNull()).select(*keys, *[F.col(f"_best.{n}").alias(n) for n in names])


def candidates(best: DataFrame, production: DataFrame, selected_on, run_id: str) -> DataFrame:
    """Candidate record per (scope, fuel) that has a production model: best parameters with their
    metrics, and the current production row."""
    current = production.select(
        "scope_id", "fuel_col", F.struct(*[c for c in production.columns]).alias("current_production")
    )
    return best.join(current, ["scope_id", "fuel_col"]).select(
        "scope_id", "fuel_col", F.col("horizon_days").cast("int"), "waiting_cost",
        F.lit(selected_on).cast("date").alias("selected_on"), "selection_method",
        F.lit(run_id).alias("based_on_run"), "current_production",
        F.struct(PRIMARY_METRIC, "decision_accuracy_vs_oracle", "share_wait", "mae_q50").alias("metrics"),
    )


def promotion_gate(
    candidate: DataFrame,
    share_wait_between: tuple[float, float] = (0.0, 1.0),
    min_relative_gain: float | None = None,
    max_accuracy_drop: float | None = None,
    current: DataFrame | None = None,
) -> DataFrame:
    """Candidates with ``reasons`` against promotion and ``approved`` where there is none.

    Checks that the share of waits lies in range and that saving and accuracy are there. With
    ``current`` (scope_id, fuel_col, current_saving, current_accuracy: the metrics of the model in production, one row each) also the gain
    in saving and the drop in accuracy; a scope without a row there passes these two.
    """
    columns = candidate.columns
    if current is not None:
        candidate = candidate.join(
            current.select("scope_id", "fuel_col", "current_saving", "current_accuracy"), ["scope_id", "fuel_col"], "left")
    saving, accuracy = F.col(f"metrics.{PRIMARY_METRIC}"), F.col("metrics.decision_accuracy_vs_oracle")
    share = F.col("metrics.share_wait")
    low, high = share_wait_between
    checks = [
        F.when(~share.between(low, high), "share_wait_out_of_range"),
        F.when(saving.isNull(), "missing_saving"),
        F.when(accuracy.isNull(), "missing_accuracy"),
    ]
    if current is not None:
        if min_relative_gain is not None:
            gain_needed = F.col("current_saving") * (1 + min_relative_gain)
            checks.append(F.when(saving < gain_needed, "saving_gain_too_small"))
        if max_accuracy_drop is not None:
            checks.append(F.when(accuracy < F.col("current_accuracy") - max_accuracy_drop, "accuracy_drop_too_large"))
    return candidate.withColumn("reasons", F.array_compact(F.array(*checks))).select(
        *columns, "reasons", (F.size("reasons") == 0).alias("approved")
    )


def promote(production: DataFrame, gated: DataFrame) -> DataFrame:
    """The production table with approved candidates written in and their version raised."""
    fields = ["horizon_days", "waiting_cost", "selected_on", "selection_method"]
    approved = gated.where("approved").select("scope_id", "fuel_col", F.struct(*fields).alias("_new"))
    joined = production.join(approved, ["scope_id", "fuel_col"], "left")
    hit = F.col("_new").isNotNull()
    changed = {f: F.when(hit, F.col(f"_new.{f}").cast(production.schema[f].dataType)).otherwise(F.col(f)) for f in fields}
    changed["version"] = F.when(hit, next_version("version")).otherwise(F.col("version"))
    return joined.withColumns(changed).select(*production.columns)


def search_grid(search_space: DataFrame, defaults: DataFrame, fuels: DataFrame) -> DataFrame:
    """``fuel_col, horizon_days, waiting_cost``: the fuel's own candidates, else the defaults.

    ``search_space``: fuel_col, horizon_candidates, waiting_cost_candidates. ``defaults``: one row.
    """
    default = defaults.select(
        F.col("horizon_candidates").alias("_h"), F.col("waiting_cost_candidates").alias("_c")
    )
    return (
        fuels.join(search_space, "fuel_col", "left")
        .withColumns({
            "_hs": F.coalesce("horizon_candidates", default.select("_h").scalar()),
            "_cs": F.coalesce("waiting_cost_candidates", default.select("_c").scalar()),
        })
        .withColumn("horizon_days", F.explode("_hs"))
        .withColumn("waiting_cost", F.explode("_cs"))
        .select("fuel_col", "horizon_days", "waiting_cost")
    )


# Production as a table of versions -----------------------------------------------------------

def append_production(rows: DataFrame, folder: str) -> None:
    """Append production rows; a row's version must be one above the one it was made from (see :func:`promote`)."""
    rows.withColumn("committed_at", F.current_timestamp()).write.mode("append").parquet(folder)


def current_production(spark: SparkSession, folder: str) -> DataFrame | None:
    """The row of the highest version per scope and fuel, or None where there is no table.

    Of two rows of one version (two writers that did not see each other) the one committed first holds for all readers.
    """
    try:
        history = spark.read.parquet(folder)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    names = [c for c in history.columns if c != "committed_at"]
    number = F.regexp_extract("version", r"(\d+)", 1).cast("int")
    rank = F.struct((-number).alias("v"), "committed_at", F.to_json(F.struct(*names)))
    best = history.groupBy("scope_id", "fuel_col").agg(F.min_by(F.struct(*names), rank).alias("_r"))
    return best.select(*[F.col(f"_r.{c}").alias(c) for c in names])


def promote_if_current(spark: SparkSession, folder: str, gated: DataFrame) -> DataFrame:
    """Append the next version of every approved candidate that was compared with the version still in production.

    ``gated`` must be a table of its own (see :func:`quotegrid.session.stage`): a frame that still reads production would be
    computed anew and always be current. Returns ``scope_id, fuel_col, outcome`` (promoted, refused by the gate, or stale: production has moved on since).
    """
    now = current_production(spark, folder)
    seen = gated.select("scope_id", "fuel_col", "approved", F.col("current_production.version").alias("_seen"))
    judged = seen.join(now.select("scope_id", "fuel_col", "version"), ["scope_id", "fuel_col"], "left").select(
        "scope_id", "fuel_col", F.when(~F.col("approved"), "refused").when(
            F.col("version").eqNullSafe(F.col("_seen")), "promoted").otherwise("stale").alias("outcome"))
    judged = stage(judged, "promotion")
    due = judged.where("outcome = 'promoted'").select("scope_id", "fuel_col")
    changed = promote(now.join(due, ["scope_id", "fuel_col"], "left_semi"), gated)
    append_production(changed, folder)
    return judged
