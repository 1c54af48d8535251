"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Each text gives a vector of transformed statistics. Per (language, source) the minimum covariance
determinant estimate of centre and scatter is found by concentration steps: rank the rows by Mahalanobis distance,
take the closest share ``H``, estimate anew. Rows are ranked by distance classes of fixed width, so one
aggregate by (group, class), reduced before the shuffle, holds all that a step needs: no row list, no sampling, and the
same result however many rows a group has. Small groups fall back on their language, then on all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField, StructType

from quotegrid.llm.common import Cache, slices, windows, word_hash, worker_cache
from quotegrid.session import stage

SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
#: The vector: log mean word length, log(1 + symbols per 100 characters of words), share of repeated lines, share of
#: repeated words, share of capitals, exclamation marks per word.
DIMENSIONS = 6
#: Least spread of each statistic: what differs by less is no outlier, also where most texts agree exactly.
FLOORS = (0.12, 0.35, 0.15, 0.04, 0.06, 0.06)
H = 0.75
STEPS = 4
#: Squared distance beyond which a row is rejected; the 0.9999 quantile of chi square for six dimensions is 27.9.
CUTOFF = 36.0
#: The scatter of the closest 75 % is smaller than that of all rows of a normal population by about this.
CONSISTENCY = 1.4
#: Rows below which the estimate of a source or language isn't used; that of all rows always is.
LEAST_ROWS = 200
CLASSES_PER_OCTAVE = 8
MOST_CLASS = 64 * CLASSES_PER_OCTAVE
PAIRS = [(i, j) for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]
STATS = StructType([
    *(StructField(c, LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    StructField("base_failed", BooleanType()), StructField("x", ArrayType(DoubleType())),
])


def repeated_words(hashes: np.ndarray, k: int = 5) -> int:
    """Words that lie in a k-word window found twice or more (64-bit hashes of words and windows)."""
    if len(hashes) <= k:
        return 0
    grams = windows(hashes, k)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(grams), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(hashes) + 1, dtype=np.int32)
    np.add.at(edge, np.flatnonzero(again), 1)
    np.add.at(edge, np.flatnonzero(again) + k, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_statistics(body: bytes, cache: Cache) -> tuple:
    words = body.split()
    n = len(words)
    raw = np.frombuffer(body, dtype=np.uint8)
    chars = int(((raw & 0xC0) != 0x80).sum()) - (len(body) - len(body.translate(None, SPACES)))
    symbols = len(body) - len(body.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    lines = dup = 0
    for line in body.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeat = repeated_words(np.fromiter(map(cache.__getitem__, words), np.uint64, n))
    failed = n < 10 or 100 * repeat > 20 * n
    capitals = len(body) - len(body.translate(None, UPPER))
    x = [math.log(max(chars, 1) / max(n, 1)), math.log1p(100 * symbols / max(chars, 1)), dup / max(lines, 1), repeat / max(n, 1),
         capitals / max(chars, 1), min(body.count(b"!") / max(n, 1), 5.0)]
    return n, chars, symbols, dup, repeat, failed, x


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``stats``; a NULL text has no words. Names can't clash, as both are structs."""
    schema = StructType([StructField("row", docs.schema), StructField("stats", STATS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache(word_hash)
        kind = pa.struct([*((c.name, pa.int64()) for c in STATS.fields[:5]), ("base_failed", pa.bool_()), ("x", pa.list_(pa.float64()))])
        for part in slices(batches, "body"):
            cache.trim()
            rows = [text_statistics(b, cache) for b in part.column("body").to_pylist()]
            names = [c.name for c in STATS.fields]
            stats = pa.array([dict(zip(names, r, strict=True)) for r in rows], type=kind)
            yield pa.RecordBatch.from_arrays([part.column("row"), stats], names=["row", "stats"])

    body = F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body")
    return docs.select(F.struct(*docs.columns).alias("row"), body).mapInArrow(run, schema)


ESTIMATE = "level int, lang string, source string, n long, center array<double>, precision array<double>"


def _estimate(frame: pd.DataFrame) -> pd.DataFrame:
    """Centre and precision of the closest rows of one group, from its sums by distance class (or the starting ones)."""
    frame = frame.sort_values("cls")
    n = int(frame["n"].sum())
    need = math.ceil(H * n)
    use = frame.iloc[: int(np.searchsorted(np.cumsum(frame["n"].to_numpy()), need)) + 1]
    m = use["n"].sum()
    center = np.array([use[f"s{i}"].sum() / m for i in range(DIMENSIONS)])
    cov = np.zeros((DIMENSIONS, DIMENSIONS))
    for i, j in PAIRS:
        cov[i, j] = cov[j, i] = use[f"p{i}_{j}"].sum() / m - center[i] * center[j]
    precision = np.linalg.inv(cov * CONSISTENCY + np.diag(np.square(FLOORS)))
    key = frame.iloc[0]
    return pd.DataFrame([[key["level"], key["lang"], key["source"], n, center, precision.ravel()]],
                        columns=["level", "lang", "source", "n", "center", "precision"])


def distance(x: Column, center: Column, precision: Column) -> Column:
    """Squared Mahalanobis distance."""
    d = [x[i] - center[i] for i in range(DIMENSIONS)]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + F.lit(1.0 if i == j else 2.0) * precision[i * DIMENSIONS + j] * d[i] * d[j]
    return total


def _sums(rows: DataFrame) -> DataFrame:
    """Per group and distance class: rows, sums and sums of products, rounded so that their order doesn't show."""
    x = [F.col("x")[i] for i in range(DIMENSIONS)]
    return rows.groupBy("level", "lang", "source", "cls").agg(
        F.count("*").alias("n"), *[F.round(F.sum(x[i]), 6).alias(f"s{i}") for i in range(DIMENSIONS)],
        *[F.round(F.sum(x[i] * x[j]), 6).alias(f"p{i}_{j}") for i, j in PAIRS])


def estimates(stats: DataFrame, steps: int = STEPS) -> DataFrame:
    """Robust centre and precision per (lang, source) [level 0], per lang [1] and of all rows [2].

    ``stats`` has lang, source and x. The start ranks rows by the sum of their statistics other than word length, where the
    clean texts are low; each step ranks by the distance under the estimate before.
    """
    levels = stats.select("x", F.explode(F.array(
        F.struct(F.lit(0).alias("level"), F.col("lang"), F.col("source")),
        F.struct(F.lit(1).alias("level"), F.col("lang"), F.lit("").alias("source")),
        F.struct(F.lit(2).alias("level"), F.lit("").alias("lang"), F.lit("").alias("source")))).alias("k")).select("x", "k.*")
    scaled = sum((F.col("x")[i] / FLOORS[i] for i in range(1, DIMENSIONS)), F.lit(0.0))

    def cls(d: Column) -> Column:
        return F.least(F.floor(F.log2(1.0 + F.greatest(d, F.lit(0.0))) * CLASSES_PER_OCTAVE), F.lit(MOST_CLASS)).cast("int")

    def closest(rows: DataFrame, d: Column) -> DataFrame:
        got = _sums(rows.withColumn("cls", cls(d))).groupBy("level", "lang", "source").applyInPandas(_estimate, ESTIMATE)
        return stage(got, "mcd")

    now = closest(levels, scaled)
    for _ in range(steps):
        joined = levels.join(now, ["level", "lang", "source"])
        now = closest(joined, distance(F.col("x"), F.col("center"), F.col("precision")))
    return now


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``row``, ``stats`` and ``kept`` of every row of ``docs``.

    Two passes over the texts: one for the estimates (over rows that pass the base rules), one for the
    verdicts, so that no text is shuffled. Rows without language or source form a group of their own.
    """
    keys = [F.coalesce(F.col(f"row.{c}").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]
    narrow = with_statistics(docs.select(*dict.fromkeys([lang, source, text])), text).where("not stats.base_failed")
    fitted = estimates(stage(narrow.select(*keys, F.col("stats.x").alias("x")), "quality-stats"))
    usable = fitted.where((F.col("n") >= LEAST_ROWS) | (F.col("level") == 2)).select("level", "lang", "source", F.struct("center", "precision").alias("e"))
    own = usable.where("level = 0").select("lang", "source", F.col("e").alias("e0"))
    by_lang = usable.where("level = 1").select("lang", F.col("e").alias("e1"))
    every = usable.where("level = 2").select(F.lit(2).alias("level"), F.col("e").alias("e2"))
    rows = with_statistics(docs, text).select("row", "stats", *keys, F.lit(2).alias("level"))
    rows = rows.join(own, ["lang", "source"], "left").join(by_lang, "lang", "left").join(every, "level", "left")
    best = F.coalesce("e0", "e1", "e2")
    inside = F.coalesce(distance(F.col("stats.x"), best["center"], best["precision"]) <= CUTOFF, F.lit(True))
    return rows.select("row", "stats", (~F.col("stats.base_failed") & inside).alias("kept"))


def quality_report(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """doc_id, the base statistics, base_failed and kept."""
    return judged(docs).select(F.col(f"row.{key}").alias("doc_id"), *[f"stats.{c.name}" for c in STATS.fields[:6]], "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, columns as they are."""
    return judged(docs).where("kept").select("row.*")
