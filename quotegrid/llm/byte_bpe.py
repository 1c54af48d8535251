"""Byte-level BPE over Arrow batches: texts to ids with byte and character offsets, and ids back to bytes.

The vocabulary is a file of ranks (base64 token, blank, rank). Bytes stand for characters by the usual
table: printable Latin-1 characters for themselves, the other bytes for U+0100 and up. The tokenizers library encodes; a
worker looks up whole space-separated chunks it has met before, so each is encoded once. Decoding
maps ids to token bytes, so a character split over tokens comes back whole; ``decode_text`` shows bytes
that are no whole character as U+FFFD.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quotegrid.llm.common import list_array, slices

#: Unicode white space, as the libraries' \s.
SPACE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: A text falls into chunks that no pre-token crosses: one space with the word after it, or the spaces before that one.
CHUNK = re.compile(f"[{SPACE}]?[^{SPACE}]+|[{SPACE}]+(?=[{SPACE}][^{SPACE}])|[{SPACE}]+")
#: Longer chunks are encoded each time, not kept.
KEPT_CHARS = 64
#: Chunks a worker keeps; emptied beyond that.
KEPT_CHUNKS = 200_000
#: Text bytes worked off at a time.
SLICE = 1 << 20


def byte_characters() -> list[str]:
    """The character for each byte."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str):
    """A tokenizer of the ranks. Any two tokens whose join is a token may merge, the lowest rank first;
    a pre-token that is a token is taken whole."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, table = read_ranks(path), byte_characters()
    shown = {t: "".join(table[b] for b in t) for t in ranks}
    merges = [(shown[t[:i]], shown[t[i:]]) for t in sorted(ranks, key=ranks.get)
              for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    made = Tokenizer(models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made


@lru_cache(maxsize=2)
def token_table(path: str) -> tuple[list[bytes], np.ndarray]:
    """Bytes of each id, through the characters and the reversed table, and their lengths."""
    ranks, table = read_ranks(path), byte_characters()
    back = {c: b for b, c in enumerate(table)}
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = bytes(back[c] for c in "".join(table[b] for b in token))
    return out, np.array([len(t) for t in out], dtype=np.int64)


@lru_cache(maxsize=2)
def worker_cache(path: str) -> dict[str, bytes]:
    """Chunk -> ids, kept by a Python worker from task to task."""
    return {}


def chunk_ids(made, texts: list[list[str]], cache: dict[str, bytes]) -> None:
    """Fill the cache for all chunks of a slice that it lacks, encoded together."""
    missing = list({c for chunks in texts for c in chunks if c not in cache})
    for i in range(0, len(missing), 4096):
        part = missing[i:i + 4096]
        for chunk, got in zip(part, made.encode_batch_fast(part, add_special_tokens=False), strict=True):
            cache[chunk] = np.array(got.ids, dtype=np.int32).tobytes()


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids, byte_ends, char_starts of every whole text.

    ``byte_ends`` are the tokens' ends in the UTF-8 bytes; ``char_starts`` the index of the character
    each token begins in (a token inside a character names that character). A NULL text is empty: empty lists. Repeated rows
    and ids are all kept; other columns are not read.
    """
    kind = "doc_id long, ids array<int>, byte_ends array<int>, char_starts array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, lengths, cache = tokenizer(path, pattern), token_table(path)[1], worker_cache(path)
        for part in slices(batches, "body", SLICE):
            texts = part.column("body").to_pylist()
            chunked = [CHUNK.findall(t) for t in texts]
            if len(cache) > KEPT_CHUNKS:
                cache.clear()
            chunk_ids(made, chunked, cache)
            ids = [np.frombuffer(b"".join([cache[c] for c in chunks]), dtype=np.int32) for chunks in chunked]
            for chunks in chunked:
                for c in chunks:
                    if len(c) > KEPT_CHARS:
                        cache.pop(c, None)
            ends, starts = [], []
            for t, x in zip(texts, ids, strict=True):
                end = np.cumsum(lengths[x])
                raw = np.frombuffer(t.encode(), dtype=np.uint8)
                char = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
                ends.append(end)
                starts.append(char[np.concatenate([[0], end[:-1]]).astype(np.int64)] if len(x) else end)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(list_array(x, pa.int32()) for x in (ids, ends, starts))],
                names=["doc_id", "ids", "byte_ends", "char_starts"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    return rows.mapInArrow(run, kind)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The columns of ``encoded`` without ``ids``, and ``decoded`` (binary): the tokens' bytes joined.

    NULL ids give NULL. An id outside the vocabulary is an error.
    """
    rest = [c for c in encoded.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(path)[0]
        for batch in batches:
            column = batch.column(ids)
            flat, at = column.values.to_numpy(), column.offsets.to_pylist()
            # one row's ids at a time as Python numbers: a batch may hold millions
            out = [b"".join([table[i] for i in flat[a:b].tolist()]) for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest),
                 pa.array([v if ok else None for v, ok in zip(out, column.is_valid().to_pylist(), strict=True)], type=pa.binary())],
                names=[*rest, "decoded"])

    from pyspark.sql.types import BinaryType, StructField, StructType

    schema = StructType([*(encoded.schema[c] for c in rest), StructField("decoded", BinaryType())])
    return encoded.mapInArrow(run, schema)


def decode_text(decoded: bytes) -> str:
    """Bytes as text; what is cut out of a character becomes U+FFFD."""
    return decoded.decode("utf-8", errors="replace")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode, digest the ids, decode, digest the bytes; the last byte offset is the text's length."""
    coded = encode(docs, path, pattern).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.when(
            F.size("byte_ends") > 0, F.element_at("byte_ends", -1)).otherwise(0).cast("long").alias("n_bytes"),
    )
    return decode(coded, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), "n_bytes")
