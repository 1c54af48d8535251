"""Quality classifier: Naive Bayes support vectors.

A text is the set of its word n-grams and of n-grams of word shapes, hashed into a fixed number of
indicators. Each indicator is scaled by the log ratio of its class counts; on the scaled, normed rows a
linear hinge-loss model is fitted by dual coordinate descent.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quotegrid.llm.common import Cache, list_array, mixed, slices, word_hash, worker_cache

BITS = 18  # 2^18 indicators
#: The model is fitted on at most so many labelled rows: those whose ids hash lowest.
SAMPLE_ROWS = 6_000
EPOCHS = 12
COST = 1.0
SMOOTHING = 1.0
SLOPE = 4.0  # of the logistic that turns a margin into a score
SHAPE_BITS = 12
SHAPE = np.uint64((1 << SHAPE_BITS) - 1)


def word_code(word: bytes) -> int:
    """Hash of the word with its shape in the low bits: case, length class, kind of the last and next to last character."""
    def kind(c: int) -> int:
        if c >= 128 or 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122:
            return 0
        return {46: 1, 44: 2, 33: 3, 63: 4}.get(c, 5)

    upper, lower = word.isupper(), word.islower()
    case = 0 if lower else 1 if upper else 2 if word[:1].isupper() else 3
    length = min(3, len(word) // 4)
    shape = case | length << 2 | kind(word[-1]) << 4 | (kind(word[-2]) if len(word) > 1 else 6) << 7
    return word_hash(word) & ~0xFFF | shape


@lru_cache(maxsize=1)
def scratch() -> np.ndarray:
    return np.zeros(1 << BITS, dtype=np.int64)


def indicators(body: bytes, cache: Cache) -> np.ndarray:
    """The distinct indicators of a text, in no order."""
    words = body.split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.int32)
    code = np.fromiter(map(cache.__getitem__, words), np.uint64, n)
    again = np.zeros(n, dtype=np.uint64)
    again[1:] = code[1:] == code[:-1]
    shape = (code & SHAPE) | again << np.uint64(SHAPE_BITS)
    code = code | SHAPE
    kinds = [code, shape * np.uint64(3) + np.uint64(1)]
    for k in (2, 3):
        if n >= k:
            part = shape[: n - k + 1]
            for i in range(1, k):
                part = part * np.uint64(1 << 16) + shape[i:n - k + 1 + i]
            kinds.append(part * np.uint64(3) + np.uint64(2))
    if n >= 2:
        kinds.append(mixed(code[:-1]) + code[1:])
    at = (mixed(np.concatenate(kinds)) >> np.uint64(64 - BITS)).astype(np.int64)
    table = scratch()
    order = np.arange(len(at))
    table[at] = order  # of equal indicators the last writer stays
    return at[table[at] == order].astype(np.int32)


def fold(key: Column) -> Column:
    """crc32 of the id as text, modulo 3; rows without an id are in fold 0."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    counts = np.full((2, 1 << BITS), SMOOTHING)
    for idx, label in zip(rows, y, strict=True):
        counts[int(label > 0), idx] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, epochs: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge loss, one dual variable at a time in a fixed random order."""
    w, bias, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(y))
    norm = np.array([float(v @ v) + 1.0 for v in values])
    random = np.random.default_rng(7)
    for _ in range(epochs):
        for i in random.permutation(len(y)):
            idx, v = rows[i], values[i]
            gradient = y[i] * (float(w[idx] @ v) + bias) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[idx] += step * v
                bias += step
                alpha[i] = new
    return w, bias


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", key: str = "doc_id", text: str = "text",
        sample_rows: int = SAMPLE_ROWS, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """(ratios, weights, bias) from labelled rows of folds 0 and 2.

    At most ``sample_rows`` labelled ids are used (a fixed bound, so they are broadcast and gathered); their whole texts count.
    Without rows of both classes all weights are 0. Where an id has several labels the largest holds.
    """
    chosen = labels.where(F.col(target).isin(0, 1) & (fold(F.col(key)) != 1)).groupBy(F.col(key).alias("k")).agg(F.max(target).alias("y"))
    chosen = chosen.orderBy(F.xxhash64("k"), "k").limit(sample_rows)
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body")).join(F.broadcast(chosen), "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache(word_code)
        for part in slices(batches, "body"):
            cache.trim()
            sets = [indicators(b, cache) for b in part.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("k"), part.column("y"), list_array(sets, pa.int32())], names=["k", "y", "idx"])

    got = rows.select("k", F.col("y").cast("int").alias("y"), "body").mapInArrow(run, "k long, y int, idx array<int>").toArrow()
    got = got.combine_chunks().sort_by("k")
    y = np.array(got["y"].to_pylist(), dtype=float) * 2 - 1
    # All sets lie in two long arrays, which are given back whole: thousands of short ones would stay with the driver's process.
    lists = got["idx"].combine_chunks()
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.int64)
    sets = [flat[a:b] for a, b in zip(ends, ends[1:])]
    if not len(y) or abs(y.sum()) == len(y):
        return np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0
    ratio = log_count_ratios(sets, y)
    weighed = ratio[flat]
    values = [weighed[a:b] for a, b in zip(ends, ends[1:])]
    for v in values:
        v /= max(np.linalg.norm(v), 1e-9)
    share = np.array([(y < 0).mean(), (y > 0).mean()])
    cost = COST * 0.5 / share[(y > 0).astype(int)]  # both classes weigh the same
    w, bias = dual_descent(sets, values, y, cost, epochs)
    return ratio, w, bias


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``score`` (0 to 1) for every whole text; NULL and empty texts have the bias's score."""
    ratio, weights, bias = model
    shared = docs.sparkSession.sparkContext.broadcast((ratio.astype(np.float32), (ratio * weights).astype(np.float32), bias))  # 2 MB, fixed
    schema = StructType([StructField("row", docs.schema), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache(word_code)
        ratio, product, bias = shared.value
        for part in slices(batches, "body"):
            cache.trim()
            margins = []
            for body in part.column("body").to_pylist():
                idx = indicators(body, cache)
                size = float(np.linalg.norm(ratio[idx])) if len(idx) else 0.0
                margins.append(bias + (float(product[idx].sum(dtype=np.float64)) / size if size else 0.0))
            score = 1.0 / (1.0 + np.exp(-SLOPE * np.array(margins, dtype=float)))
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(score)], names=["row", "score"])

    body = F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body")
    return docs.select(F.struct(*docs.columns).alias("row"), body).mapInArrow(run, schema)


def score_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    narrow = docs.select("doc_id", "text")
    rows = scored(narrow, fit(narrow, labels))
    return rows.select(
        F.col("row.doc_id").alias("doc_id"), (fold(F.col("row.doc_id")) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, training: DataFrame) -> DataFrame:
    """The rows of ``docs`` predicted good, columns as they are.

    The model is fitted on the labelled rows of ``training``, the whole table, as an earlier filter may have left ``docs``
    without bad texts.
    """
    return scored(docs, fit(training.select("doc_id", "text"), labels)).where("score >= 0.5").select("row.*")
