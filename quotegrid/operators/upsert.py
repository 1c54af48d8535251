"""Latest-wins tables, the fetch log, and what is left to collect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quotegrid.operators.panel import in_range, parse_day, records_per_date

PROCESSED = ("fetched", "empty")  # fixed values: a failed date is collected again


def latest_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest ``order`` per key, all its columns, NULLs included.

    An aggregate, so copies of one key are reduced before the shuffle; a key that holds a third of
    all rows moves one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return top.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def upsert(current: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``current`` with the rows of ``batch`` written over it, the last row of a key in the batch.

    ``order`` names batch columns that give its sequence; they are not kept.
    """
    columns = current.columns
    none = {c: F.lit(None).cast(batch.schema[c].dataType) for c in order if c not in columns}
    both = current.withColumns({**none, "_new": F.lit(0)}).unionByName(
        batch.select(*columns, *[c for c in order if c not in columns]).withColumn("_new", F.lit(1))
    )
    return latest_wins(both, keys, ["_new", *order]).select(*columns)


def upsert_stations(current: DataFrame, batch: DataFrame, order: Sequence[str], now: Column | None = None) -> DataFrame:
    """Replace all attributes of the stations in the batch; ``updated_at`` becomes ``now``."""
    stamped = batch.withColumn("updated_at", F.current_timestamp() if now is None else now)
    return upsert(current, stamped, ["station_id"], order)


def upsert_prices(current: DataFrame, batch: DataFrame, order: Sequence[str]) -> DataFrame:
    return upsert(current, batch, ["date", "station_id"], order)


def upsert_fetch_log(current: DataFrame, batch: DataFrame, order: Sequence[str] = ("updated_at",)) -> DataFrame:
    """Replace the entries of the batch's dates; ``created_at`` keeps its first value."""
    columns = current.columns
    extra = [c for c in order if c not in columns]
    none = {c: F.lit(None).cast(batch.schema[c].dataType) for c in extra}
    both = current.withColumns({**none, "_new": F.lit(0)}).unionByName(
        batch.select(*columns, *extra).withColumn("_new", F.lit(1))
    )
    rest = [c for c in columns if c not in ("date", "created_at")]
    grouped = both.groupBy("date").agg(
        F.max_by(F.struct(*rest), F.struct("_new", *order)).alias("_row"),
        F.min_by("created_at", F.struct("_new", *order)).alias("created_at"),
    )
    return grouped.select(
        *[F.col(c) if c in ("date", "created_at") else F.col(f"_row.{c}").alias(c) for c in columns]
    )


def fetch_log_range(log: DataFrame, start=None, end=None) -> DataFrame:
    return in_range(log, start, end).orderBy("date")


def fetch_status(log: DataFrame, day) -> str | None:
    """Status of one date, or None."""
    rows = log.where(F.col("date") == F.lit(parse_day(day))).select("status").head(1)
    return rows[0][0] if rows else None


def already_processed(log: DataFrame, day) -> bool:
    return fetch_status(log, day) in PROCESSED


def missing_dates(days: DataFrame, log: DataFrame) -> DataFrame:
    """Days the log has neither as fetched nor as empty."""
    done = log.where(F.col("status").isin(*PROCESSED)).select("date")
    return days.join(F.broadcast(done), "date", "left_anti")  # one row per calendar day


def requested_days(df: DataFrame, start, end) -> DataFrame:
    """The days from ``start`` to ``end`` as rows; any frame gives the session."""
    start, end = parse_day(start), parse_day(end)
    if start > end:
        raise ValueError("start must not be after end")
    return df.sparkSession.sql(
        f"select explode(sequence(date '{start}', date '{end}')) as date"
    )


def log_from_prices(prices: DataFrame, start=None, end=None) -> DataFrame:
    """``date, status, records_count`` of every day in range: fetched where there are prices, else empty."""
    start, end = parse_day(start), parse_day(end)
    counts = records_per_date(prices, start, end)
    bounds = prices.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).where("lo is not null")
    days = bounds.select(F.explode(F.sequence(
        F.lit(start) if start else F.col("lo"), F.lit(end) if end else F.col("hi")
    )).alias("date"))
    n = F.coalesce("records_count", F.lit(0))
    return days.join(counts, "date", "left").select(
        "date", F.when(n > 0, "fetched").otherwise("empty").alias("status"), n.alias("records_count")
    )


def bootstrap_fetch_log(
    prices: DataFrame, log: DataFrame, now: Column, start=None, end=None, overwrite: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The log completed from the prices, and one row with the numbers ``created`` and ``updated``."""
    wanted = log_from_prices(prices, start, end)
    known = log.select("date", F.lit(True).alias("_known"))
    marked = wanted.join(known, "date", "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    entries = marked if overwrite else marked.where(~F.col("_known"))
    batch = entries.select(
        "date", "status", F.col("records_count").cast("bigint"), F.col("records_count").cast("bigint").alias("inserted_rows"),
        F.lit(None).cast("string").alias("error_type"), F.lit(None).cast("string").alias("error_message"),
        now.alias("created_at"), now.alias("updated_at"),
    )
    counts = entries.agg(
        F.count_if(~F.col("_known")).alias("created"), F.count_if("_known").alias("updated"),
        F.min("date").alias("range_start"), F.max("date").alias("range_end"),
    )
    return upsert_fetch_log(log, batch), counts


def collection_results(days: DataFrame, log: DataFrame, records: DataFrame, failures: DataFrame | None = None,
                       force: bool = False, allow_empty: bool = True) -> DataFrame:
    """One row per requested day: ``date, status, records, inserted_rows, error_type, error_message``.

    ``records``: the parsed records, at least ``date``. ``failures``: date, error_type, error_message.
    A processed day is skipped unless forced; a day without records is empty, or failed where empty
    days are not allowed.
    """
    done = log.where(F.col("status").isin(*PROCESSED)).select("date", F.lit(True).alias("_done"))
    if force:
        done = done.where(F.lit(False))
    counts = records.groupBy("date").agg(F.count(F.lit(1)).alias("_n"))
    joined = days.join(F.broadcast(done), "date", "left").join(counts, "date", "left")
    if failures is None:
        joined = joined.withColumns({"_type": F.lit(None).cast("string"), "_text": F.lit(None).cast("string")})
    else:
        joined = joined.join(
            failures.groupBy("date").agg(F.min(F.struct("error_type", "error_message")).alias("_e")), "date", "left"
        ).withColumns({"_type": F.col("_e.error_type"), "_text": F.col("_e.error_message")})
    n = F.coalesce("_n", F.lit(0))
    fetched = (n > 0) & F.col("_type").isNull()
    status = (
        F.when(F.col("_done").isNotNull(), "skipped")
        .when(F.col("_type").isNotNull(), "failed")
        .when(n > 0, "fetched")
        .otherwise("empty" if allow_empty else "failed")
    )
    stored = F.when(F.col("_done").isNull() & fetched, n).otherwise(0)
    no_records = F.col("status") == "failed"
    return joined.select(
        "date", status.alias("status"), stored.alias("records"), stored.alias("inserted_rows"), "_type", "_text"
    ).select(
        "date", "status", "records", "inserted_rows",
        F.when(no_records, F.coalesce("_type", F.lit("RuntimeError"))).alias("error_type"),
        F.when(no_records, F.coalesce("_text", F.lit("no records"))).alias("error_message"),
    )


def collection_summary(results: DataFrame) -> DataFrame:
    """One row over all requested days, with the errors as an array (at most one per day)."""
    status = F.col("status")
    return results.agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        F.count(F.lit(1)).alias("requested_dates"), F.count(F.lit(1)).alias("processed_dates"),
        *[F.count_if(status == s).alias(f"{s}_dates") for s in ("fetched", "skipped", "empty", "failed")],
        F.sum("inserted_rows").alias("inserted_rows"),
        F.sort_array(F.collect_list(F.when(status == "failed", F.struct(
            "date", F.col("error_message").alias("error"), F.col("error_type").alias("type")
        )))).alias("errors"),
    )


def log_entries(results: DataFrame, now: Column) -> DataFrame:
    """Fetch-log rows of a collection; skipped days leave no entry."""
    return results.where(F.col("status") != "skipped").select(
        "date", "status", F.col("records").cast("bigint").alias("records_count"),
        F.col("inserted_rows").cast("bigint"), "error_type", "error_message",
        now.alias("created_at"), now.alias("updated_at"),
    )
