"""Quantile forecast of the future minimum, per regime with a global fallback.

The model of a key is the distribution of ``target - price`` over its training rows; a forecast is
the current price plus a quantile of it. Models of all keys are fitted together: the differences are
counted per distinct value before anything is shuffled, and regime models, global models and (in a
backtest) overlapping training windows all come from those counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from quotegrid.operators.histogram import quantiles as value_quantiles
from quotegrid.operators.histogram import running_counts
from quotegrid.operators.timeseries import lowest_ahead
from quotegrid.schema import DEFAULT_REGIME, GLOBAL_MODEL, MIN_ROWS_PER_REGIME, QUANTILES, REGIMES, quantile_column
from quotegrid.session import stage


GRID_KEYS = {"horizon_days", "fold_id"}


def grid_side(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Broadcast a table keyed by the search grid only: its rows are horizons x folds x regimes.

    With scopes among the keys the size depends on the data, and Spark chooses the join by size.
    """
    return F.broadcast(df) if set(keys) <= GRID_KEYS else df


def horizon_rows(
    frame: DataFrame, horizons: Sequence[int], keys: Sequence[str] = (), columns: Sequence[str] = ()
) -> DataFrame:
    """Observed rows, once per horizon: the prices ``ahead``, the horizon's ``target``, and further ``columns`` (features).

    Observed means that any metric has a value, so the price itself may be missing.
    """
    taken = dict.fromkeys([*keys, "date", "station_id", "price", "regime", "ahead", *columns])
    return (
        frame.where(F.col("is_observed_price") == 1)
        .select(*taken, F.explode(F.array(*[
            F.struct(F.lit(int(h)).alias("horizon_days"), lowest_ahead(int(h)).alias("target")) for h in horizons])).alias("_h"))
        .select(*taken, "_h.horizon_days", "_h.target")
    )


def eligible(rows: DataFrame) -> DataFrame:
    """Rows a model may learn from or be tested on: price and target are known."""
    return rows.where(F.col("price").isNotNull() & F.col("target").isNotNull())


def difference_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, regime, diff, n`` of training rows."""
    return (
        rows.withColumn("diff", F.col("target") - F.col("price"))
        .groupBy(*keys, "regime", "diff").agg(F.count(F.lit(1)).alias("n"))
    )


def fit_counts(
    counts: DataFrame,
    keys: Sequence[str],
    quantiles: Sequence[float] = QUANTILES,
    min_rows: int = MIN_ROWS_PER_REGIME,
) -> DataFrame:
    """``keys, model_key, rows_train, diff_qNN...`` from :func:`difference_counts`, which several branches read: give them as a table.

    ``model_key`` is a regime with at least ``min_rows`` rows, or the global model.
    """
    keys = list(keys)
    named = counts.where(F.col("regime").isNotNull()).select(*keys, F.col("regime").alias("model_key"), "diff", "n")
    # Global counts are sums of the regime counts, not a second pass over the rows.
    overall = counts.groupBy(*keys, "diff").agg(F.sum("n").alias("n")).select(
        *keys, F.lit(GLOBAL_MODEL).alias("model_key"), "diff", "n"
    )
    model_keys = [*keys, "model_key"]
    ranked = running_counts(named.unionByName(overall), model_keys, "diff")
    names = {quantile_column(q).replace("pred_", "diff_"): q for q in quantiles}
    fitted = value_quantiles(ranked, model_keys, "diff", names)
    return fitted.where((F.col("model_key") == GLOBAL_MODEL) | (F.col("total") >= min_rows)).withColumnRenamed(
        "total", "rows_train"
    )


def fit(rows: DataFrame, keys: Sequence[str], quantiles=QUANTILES, min_rows: int = MIN_ROWS_PER_REGIME) -> DataFrame:
    return fit_counts(stage(difference_counts(rows, keys), "difference-counts"), keys, quantiles, min_rows)


def effective_models(models: DataFrame, keys: Sequence[str], quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """One row per key and regime: the regime's model where it was trained, else the global one."""
    keys = list(keys)
    names = [quantile_column(q).replace("pred_", "diff_") for q in quantiles]
    regimes = F.array(*[F.lit(r) for r in REGIMES])
    base = models.where(F.col("model_key") == GLOBAL_MODEL).select(
        *keys, "rows_train", F.explode(regimes).alias("regime"), *[F.col(n).alias(f"_g_{n}") for n in names]
    )
    own = models.where(F.col("model_key") != GLOBAL_MODEL).select(
        *keys, F.col("model_key").alias("regime"), *names
    )
    return base.join(own, [*keys, "regime"], "left").select(
        *keys, "regime", "rows_train", *[F.coalesce(n, f"_g_{n}").alias(n) for n in names]
    )


def predict(
    rows: DataFrame, models: DataFrame, keys: Sequence[str], quantiles: Sequence[float] = QUANTILES
) -> DataFrame:
    """Add ``pred_qNN``, in ascending order per row, and the ``rows_train`` of the key.

    A missing regime counts as stable. Rows of a key without a model drop out.
    """
    keys = list(keys)
    names = [quantile_column(q).replace("pred_", "diff_") for q in quantiles]
    side = effective_models(models, keys, quantiles).withColumnRenamed("regime", "_regime")
    joined = rows.withColumn("_regime", F.coalesce("regime", F.lit(DEFAULT_REGIME))).join(
        grid_side(side, keys), [*keys, "_regime"]
    )
    ordered = F.array_sort(F.array(*[F.col("price") + F.col(n) for n in names]))
    return (
        joined.withColumn("_pred", ordered)
        .withColumns({quantile_column(q): F.get("_pred", F.lit(i)) for i, q in enumerate(quantiles)})
        .drop("_pred", "_regime", *names)
    )


class DifferenceForecaster:
    """The forecaster of this module: no features, one small table of quantiles per key and regime.

    A forecaster names the feature ``columns`` it needs besides price and regime, and has ``fit`` and ``predict``; the plans take any.
    """

    columns: tuple[str, ...] = ()

    def fit(self, rows: DataFrame, keys: Sequence[str], min_rows: int = MIN_ROWS_PER_REGIME) -> DataFrame:
        """Models of rows that are copied per key, or carry ``fold_lo, fold_hi``: then they count in each of these folds."""
        if "fold_lo" not in rows.columns:
            return fit(rows, keys, min_rows=min_rows)
        counts = difference_counts(rows, [*keys, "fold_lo", "fold_hi"])
        per_fold = (
            counts.withColumn("fold_id", F.explode(F.sequence("fold_lo", "fold_hi")))
            .groupBy(*keys, "fold_id", "regime", "diff").agg(F.sum("n").alias("n"))
        )
        return fit_counts(stage(per_fold, "difference-counts"), [*keys, "fold_id"], min_rows=min_rows)

    def predict(self, rows: DataFrame, models: DataFrame, keys: Sequence[str]) -> DataFrame:
        return predict(rows, models, keys)


def distinct_dates(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, _dates``: sorted distinct dates, one array per key, at most as long as the calendar.

    Days are made distinct by a plain aggregate first, so that the arrays meet each day of a key once, not each row.
    """
    return rows.select(*keys, "date").distinct().groupBy(*keys).agg(F.sort_array(F.collect_list("date")).alias("_dates"))


def split_dates(rows: DataFrame, keys: Sequence[str], train_end=None, share: float = 0.8) -> DataFrame:
    """``keys, n_dates, cutoff``: the given date, or the date at ``share`` of the distinct dates."""
    dates = distinct_dates(rows, keys)
    at = F.floor(F.size("_dates") * F.lit(float(share))).cast("int")
    cutoff = F.lit(train_end).cast("date") if train_end is not None else F.get("_dates", at)
    return dates.select(*keys, F.size("_dates").alias("n_dates"), cutoff.alias("cutoff"))


def with_split(rows: DataFrame, cutoffs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach ``cutoff`` and ``is_train`` (date on or before it)."""
    return rows.join(grid_side(cutoffs.select(*keys, "cutoff"), keys), list(keys)).withColumn(
        "is_train", F.col("date") <= F.col("cutoff")
    )
