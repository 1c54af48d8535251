"""Token counts by a two-tier look-up on the map side.

Tier one: a compact table of frequent pre-token chunks and their token counts, broadcast (bounded in
entries and key length, so in bytes). Tier two: a bounded cache in each worker for all others, filled by
the tokenizers library in batches. No pre-token is ever shuffled. The table is read off a bounded sample
and only saves work: a chunk's count is the same from either tier.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quotegrid.llm.byte_bpe import CHUNK, KEPT_CHARS, SLICE
from quotegrid.llm.common import slices

#: Entries of the broadcast table; with keys of at most 64 characters it stays below 16 MB.
FREQUENT = 1 << 15
#: Texts the frequent chunks are read off, at most.
SAMPLE_TEXTS = 2_000
#: Entries of a worker's cache; emptied beyond that.
KEPT_CHUNKS = 400_000


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_padding()
    made.no_truncation()
    return made


@lru_cache(maxsize=2)
def added_strings(path: str) -> tuple[str, ...] | None:
    """Added tokens' strings if texts may be cut at them and between words; None: whole texts only.

    Chunks may be counted apart if the file pre-tokenizes at the byte level by the usual pattern, adds no prefix and
    normalizes nothing, and no added token takes in its neighbourhood.
    """
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    before = made.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
    added = made.get("added_tokens") or []
    flags = any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
    spaced = any(any(c.isspace() for c in t["content"]) for t in added)
    if not plain or made.get("normalizer") or flags or spaced:
        return None
    return tuple(t["content"] for t in added)


@lru_cache(maxsize=2)
def worker_cache(path: str) -> dict[str, int]:
    """Chunk -> tokens, kept by a Python worker from task to task."""
    return {}


def counts_of(path: str, chunks: list[str]) -> list[int]:
    made, out = tokenizer(path), []
    for i in range(0, len(chunks), 4096):
        out += [len(e) for e in made.encode_batch_fast(chunks[i:i + 4096], add_special_tokens=False)]
    return out


def whole_counts(path: str, texts: list[str]) -> list[int]:
    """Counts of whole texts, by the library that the file's name says."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(x) for x in model.encode(texts, num_threads=1)]
    return counts_of(path, texts)


def frequent_table(docs: DataFrame, path: str, text: str = "text", most: int = FREQUENT, sample: int = SAMPLE_TEXTS) -> dict[str, int]:
    """chunk -> tokens for the chunks most frequent in at most ``sample`` texts (counted by chunks of one text)."""
    seen: Counter[str] = Counter()
    for row in docs.select(F.col(text).alias("t")).where("t is not null").take(sample):
        seen.update(c for c in CHUNK.findall(row["t"]) if len(c) <= KEPT_CHARS)
    keys = [c for c, n in seen.most_common(most) if n > 1]
    return dict(zip(keys, counts_of(path, keys), strict=True))


def token_counts(docs: DataFrame, path: str, limit: int = 1024, key: str = "doc_id", text: str = "text",
                 frequent: int = FREQUENT, sample: int = SAMPLE_TEXTS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, n_misses of every whole text.

    ``n_misses`` are the chunks the broadcast table lacked. NULL texts count as empty; repeated rows are all kept; other columns are
    not read. Files whose pre-tokens can't be told apart beforehand (other pre-tokenizers, normalizers, .model files) are counted by whole texts.
    """
    special = None if path.endswith(".model") else added_strings(path)
    table = docs.sparkSession.sparkContext.broadcast(
        frequent_table(docs, path, text, frequent, sample) if special is not None else {})

    def count(texts: list[str], known: dict[str, int], cache: dict[str, int]) -> tuple[list[int], list[int]]:
        if special is None:
            return whole_counts(path, texts), [0] * len(texts)
        pieces = []
        for t in texts:
            cut, extra = [t], 0
            for s in special:
                if s in t:
                    cut = [p for q in cut for p in q.split(s)]
            if len(cut) > 1:
                extra = len(cut) - 1
            pieces.append((extra, [c for p in cut for c in CHUNK.findall(p)]))
        if len(cache) > KEPT_CHUNKS:
            cache.clear()
        missing = list({c for _, chunks in pieces for c in chunks if c not in known and c not in cache})
        cache.update(zip(missing, counts_of(path, missing), strict=True))
        total, missed = [], []
        for extra, chunks in pieces:
            got = [known.get(c) for c in chunks]
            late = [c for c, n in zip(chunks, got, strict=True) if n is None]
            total.append(extra + sum(n for n in got if n is not None) + sum(map(cache.__getitem__, late)))
            missed.append(len(late))
        for c in missing:
            if len(c) > KEPT_CHARS:
                del cache[c]
        return total, missed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cache = table.value, worker_cache(path)
        for part in slices(batches, "body", SLICE):
            texts = part.column("body").to_pylist()
            total, missed = count(texts, known, cache)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n_bytes"), pa.array(total, type=pa.int64()),
                 pa.array([n > limit for n in total], type=pa.bool_()), pa.array(missed, type=pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_misses"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    rows = rows.withColumn("n_bytes", F.octet_length("body").cast("long"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_misses long")
