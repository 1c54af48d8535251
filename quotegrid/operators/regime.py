"""Rule-based market regime of each station and day."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from quotegrid.functions.frames import STATION, median_of, recent_values, rolling, series, so_far


@dataclass(frozen=True)
class RegimeRules:
    """Thresholds; the defaults are fixed values."""

    min_reset_jump: float = 0.015
    shock_abs_threshold: float = 0.025
    cyclical_resets_window: int = 90
    min_resets_for_cyclical: int = 2
    scale_fallback: str = "series"  # "none": no scale where the rolling one is missing


def regime_of(change: Column, shock_at: Column, resets: Column, rules: RegimeRules) -> Column:
    return (
        F.when(change >= shock_at, "shock_up")
        .when(change <= -shock_at, "shock_down")
        .when(resets >= rules.min_resets_for_cyclical, "cyclical")
        .otherwise("stable")
    )


def with_regimes(
    df: DataFrame,
    price: str = "price_ffill",
    rules: RegimeRules = RegimeRules(),
    keys: Sequence[str] = STATION,
    alongside: Sequence[dict[str, Column]] = ({}, {}, {}),
    ends: Sequence[date] = (),
) -> DataFrame:
    """Deltas, 14-day rolling statistics, reset flags and counts, and the regime.

    All windows share one partitioning and order: one exchange and one sort. The rolling sum of
    reset flags is the difference of two running counts. Where fewer than ten deltas lie in the last
    60 rows the scale is the median over the whole series, so it also knows later rows.

    ``alongside`` adds window columns of the same series to the first, second and last window pass;
    those of a pass may use the columns of the passes before it.

    ``ends`` adds ``by_end``: per end the row's regime, days since a reset and recent resets as they are when the series ends
    on that day, so that no row knows later ones. Only the median of the whole series depends on its end: it is taken once per end, and
    flags, counts and regimes follow from it in the same passes.
    """
    first, second, last_pass = alongside
    w = series(keys)
    with_deltas = df.withColumns({
        **{f"delta_{k}": F.col(price) - F.lag(price, k).over(w) for k in (1, 3, 7)},
        "rolling_std_14": rolling(F.stddev_samp, price, 14, 5, keys),
        "rolling_mean_14": rolling(F.avg, price, 14, 5, keys),
        **first,
    }).withColumn("_abs_delta", F.abs("delta_1"))

    # Held prices do not change: nearly all values are zeros, which stand before the others and are counted, not sorted.
    moved = F.when(F.col("_abs_delta") != 0, F.col("_abs_delta"))
    scaled = with_deltas.withColumn("_moved", moved).withColumns({
        "_values": recent_values("_moved", 60, keys), "_zero": F.count_if(F.col("_abs_delta") == 0).over(so_far(keys)), **second})
    scaled = scaled.withColumn("_zero", (F.col("_zero") - F.coalesce(F.lag("_zero", 60).over(w), F.lit(0))).cast("int"))
    scaled = scaled.withColumn("_recent", median_of("_values", 10, "_zero")).drop("_values", "_moved", "_zero")
    keeps = rules.scale_fallback == "series"
    # Of the series up to each end, and of the whole series at last.
    cut = [F.when(F.col("date") <= F.lit(e), F.col("_abs_delta")) for e in ends] + [F.col("_abs_delta")]
    whole = [F.percentile(c, F.lit(0.5)).over(Window.partitionBy(*keys)) if keeps else F.lit(None).cast("double") for c in cut]
    scaled = scaled.withColumn("_scales", F.array(*[F.coalesce("_recent", m) for m in whole]))
    scale = [F.get("_scales", F.lit(i)) for i in range(len(cut))]

    def at_least(least: float, times: float) -> list[Column]:
        """A missing scale makes the thresholds missing too; greatest() alone would skip it."""
        return [F.when(m.isNotNull(), F.greatest(F.lit(least), times * m)) for m in scale]

    reset_at = at_least(rules.min_reset_jump, 3.0)
    flagged = scaled.withColumn("_flags", F.array(*[F.when(F.col("delta_1") >= r, 1).otherwise(0) for r in reset_at]))
    flag = [F.get("_flags", F.lit(i)) for i in range(len(cut))]
    counted = flagged.withColumns({
        "_resets": F.array(*[F.sum(f).over(so_far(keys)) for f in flag]),
        "_last_reset": F.array(*[
            F.last(F.when(f == 1, F.col("date")), ignorenulls=True).over(so_far(keys)) for f in flag]),
    })
    recent = counted.withColumns({
        "_earlier": F.lag("_resets", rules.cyclical_resets_window).over(w), **last_pass,
    })
    states = []
    for i, shock_at in enumerate(at_least(rules.shock_abs_threshold, 4.0)):
        resets = F.get("_resets", F.lit(i)) - F.coalesce(F.get("_earlier", F.lit(i)), F.lit(0))
        regime = regime_of(F.col("delta_3"), shock_at, resets, rules)
        since = F.coalesce(F.datediff("date", F.get("_last_reset", F.lit(i))), F.lit(999))
        states.append(F.struct(regime.alias("regime"), since.alias("days_since_reset"), resets.alias("recent_resets_90")))
    last = len(ends)
    out = recent.withColumns({
        "robust_scale": scale[last], "cycle_reset_flag": flag[last], "_state": states[last],
        **({"by_end": F.array(*states[:last])} if ends else {}),
    })
    return out.withColumns({c: F.col(f"_state.{c}") for c in ("recent_resets_90", "days_since_reset", "regime")}).drop(
        "_abs_delta", "_recent", "_scales", "_flags", "_resets", "_earlier", "_last_reset", "_state")


def quoted_regimes(
    placed: DataFrame, price: str, furthest: int, fill_limit: int = 3, rules: RegimeRules = RegimeRules(), ends: Sequence[date] = ()
) -> DataFrame:
    """The regime (``by_end`` with ``ends``) and the ``ahead`` prices of quote rows alone, as :func:`with_regimes` gives them on the expanded calendar.

    ``placed`` comes from :func:`quotegrid.operators.panel.placed_quotes`, each station in it once. A price holds on its day and on up to
    ``fill_limit`` days after it that have none; on those held days the price does not change, so between two quotes only their number
    counts: it is how many zeros stand before the sorted changes of a median. Frames are ranges of days. A day without a quote must not be a reset,
    so ``min_reset_jump`` has to be positive.
    """
    if rules.min_reset_jump <= 0:
        raise ValueError("min_reset_jump must be positive")
    w = Window.partitionBy(*STATION).orderBy("_number")
    past = w.rowsBetween(Window.unboundedPreceding, 0)
    upto = lambda days: w.rangeBetween(Window.unboundedPreceding, -days)
    known = placed.where("_attr is not null and (date is null or _prev is null or _prev < date)")
    here = F.when(F.col(price).isNotNull() & F.col("date").isNotNull(), F.struct("date", F.col(price).alias("price")))
    rows = known.withColumn("_here", here).withColumns({
        **{f"_at_{k}": F.last("_here", ignorenulls=True).over(upto(k)) for k in (0, 1, 3)},
        "_soon": F.first("_here.date", ignorenulls=True).over(w.rangeBetween(1, fill_limit)) if fill_limit else F.lit(None).cast("date"),
        "_later": F.collect_list("_here").over(w.rangeBetween(1, furthest)),
    })

    def held_price(days: int) -> Column:
        at = F.col(f"_at_{days}")
        return F.when(F.datediff("date", at["date"]) <= days + fill_limit, at["price"])

    quoted = F.col("_here").isNotNull()
    by_day = F.map_from_entries("_later")
    rows = rows.withColumns({
        "delta_1": held_price(0) - held_price(1), "delta_3": held_price(0) - held_price(3),
        "ahead": F.array(*[F.try_element_at(by_day, F.date_add("date", k)) for k in range(1, furthest + 1)]),
        "_held": F.when(quoted, F.coalesce(
            F.datediff("_soon", "date") - 1, F.least(F.lit(fill_limit), F.datediff("_hi", "date")))),
    }).drop("_at_1", "_at_3", "_soon", "_later").withColumn("_change", F.when(quoted, F.abs("delta_1")))

    # Zeros of the held days: of the last 60 days by running sums, up to each end by sums over the station.
    whole = [*ends, None]
    keeps = rules.scale_fallback == "series"
    station = Window.partitionBy(*STATION)

    def zeros_of(end) -> Column:
        if end is None:
            return F.sum("_held").over(station)
        left = F.datediff(F.lit(end), "date")
        return F.sum(F.when(left >= 0, F.least("_held", left))).over(station)

    rows = rows.withColumns({
        "_sum": F.sum("_held").over(past),
        "_changes": F.sort_array(F.collect_list("_change").over(w.rangeBetween(-59, 0))),
        **({"_zeros": F.array(*[F.coalesce(zeros_of(e), F.lit(0)) for e in whole])} if keeps else {}),
    }).withColumn("_run", F.when(quoted, F.struct("date", F.col("_sum").alias("sum"), F.col("_held").alias("held"))))

    def change_until(end, i: int) -> Column:
        """Median of all changes up to an end; the station's row stands for the zeros."""
        value = F.when(F.col("date").isNull(), F.lit(0.0)).when(F.lit(True) if end is None else F.col("date") <= F.lit(end), F.col("_change"))
        often = F.when(F.col("date").isNull(), F.get("_zeros", F.lit(i))).otherwise(F.lit(1).cast("bigint"))
        return F.percentile(value, F.lit(0.5), often).over(station)

    rows = rows.withColumns({
        "_last": F.last("_run", ignorenulls=True).over(past),
        "_before": F.last("_run", ignorenulls=True).over(upto(60)),
        "_whole": F.array(*[change_until(e, i) if keeps else F.lit(None).cast("double") for i, e in enumerate(whole)]),
    })

    def zeros_to(run: str, days: int) -> Column:
        r = F.col(run)
        since = F.datediff(F.date_sub("date", days), r["date"])
        return F.coalesce(r["sum"] - r["held"] + F.least(r["held"], since), F.lit(0))

    rows = rows.withColumn("_zero", (zeros_to("_last", 0) - zeros_to("_before", 60)).cast("int"))
    size = F.size("_changes") + F.col("_zero")
    nth = lambda i: F.when(i < F.col("_zero"), F.lit(0.0)).otherwise(F.get("_changes", i - F.col("_zero")))
    median = (nth(F.floor((size - 1) / 2).cast("int")) + nth(F.floor(size / 2).cast("int"))) / 2
    # Below the least jump and shock the scale decides nothing.
    needed = (F.col("delta_1") >= rules.min_reset_jump) | (F.abs("delta_3") >= rules.shock_abs_threshold)
    rows = rows.withColumn("_recent", F.when(needed & (size >= 10), median)).drop("_changes", "_zeros", "_sum", "_run", "_last", "_before")
    scale = [F.coalesce("_recent", F.get("_whole", F.lit(i))) for i in range(len(whole))]
    at_least = lambda least, times: [F.when(m.isNotNull(), F.greatest(F.lit(least), times * m)) for m in scale]

    flags = [F.when(F.col("delta_1") >= r, 1).otherwise(0) for r in at_least(rules.min_reset_jump, 3.0)]
    rows = rows.withColumn("_flags", F.array(*flags))
    flag = [F.get("_flags", F.lit(i)) for i in range(len(whole))]
    rows = rows.withColumns({
        "_resets": F.array(*[F.sum(f).over(past) for f in flag]),
        "_last_reset": F.array(*[F.last(F.when(f == 1, F.col("date")), ignorenulls=True).over(past) for f in flag]),
    }).withColumn("_earlier", F.last("_resets").over(upto(rules.cyclical_resets_window)))
    states = []
    for i, shock_at in enumerate(at_least(rules.shock_abs_threshold, 4.0)):
        resets = F.get("_resets", F.lit(i)) - F.coalesce(F.get("_earlier", F.lit(i)), F.lit(0))
        since = F.coalesce(F.datediff("date", F.get("_last_reset", F.lit(i))), F.lit(999))
        states.append(F.struct(
            regime_of(F.col("delta_3"), shock_at, resets, rules).alias("regime"), since.alias("days_since_reset"),
            resets.alias("recent_resets_90")))
    return rows.where(F.col("date").isNotNull()).withColumns({
        "regime": states[-1]["regime"], **({"by_end": F.array(*states[:-1])} if ends else {})})
