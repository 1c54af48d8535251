"""Document fingerprints by winnowing, in DataFrame functions only.

A text is cut into units: words, long words in runs of ``UNIT`` code points. Every k consecutive
units are hashed; of each window of w consecutive hashes the smallest is chosen, the rightmost one on
a tie, and kept with its position. Two texts that share w + k - 1 consecutive units share a chosen hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quotegrid.session import stage

UNIT = 6  # code points of a unit at most
K = 3  # units hashed together
W = 4  # hashes in a window
#: Positions take the low bits of a packed value: 2^24 units, beyond which ties go by the remainder.
POSITION_BITS = 24
LOW = (1 << POSITION_BITS) - 1
#: Documents whose ids share all but so many low bits are neighbours in one window partition.
BUCKET_BITS = 10


#: More than any array holds; a slice of this length runs to the end.
REST = 1 << 30


def _sliding(df: DataFrame, name: str, size: int, join) -> DataFrame:
    """``join`` over each run of ``size`` neighbours of array ``name``, by doubling: about log2(size) passes.

    Each pass is a projection of its own, as an array named twice in one expression is computed twice.
    Entries whose run would pass the end are cut off; arrays shorter than ``size`` become empty.
    """
    have = 1
    while have < size:
        step = min(have, size - have)
        df = df.withColumn(name, F.zip_with(name, F.slice(name, step + 1, REST), join))
        have += step
    return df.withColumn(name, F.slice(name, F.lit(1), F.greatest(F.size(name) - (size - 1), F.lit(0))))


def units(text: Column, unit: int = UNIT) -> Column:
    return F.regexp_extract_all(text, F.lit("[^\\x20\\x09-\\x0D]{1,%d}" % unit), F.lit(0))


def with_fingerprint(df: DataFrame, text: Column, name: str, k: int = K, w: int = W) -> DataFrame:
    """Adds ``name``: the chosen values (hash and position packed in a long) in order of position.

    Rolling k-gram hashes are built by pairing, so the order of units counts. A text of fewer than k units is one gram, one of fewer than w grams one window; without a unit
    (NULL, empty, white space only) the fingerprint is empty.
    """
    u, g, all_g = f"__{name}_units", f"__{name}_grams", f"__{name}_all"
    df = df.withColumn(u, units(F.coalesce(text, F.lit(""))))
    df = df.withColumn(g, F.transform(u, lambda x: F.xxhash64(x)))
    df = df.withColumn(u, F.when(F.size(u).between(1, k - 1), F.array(F.xxhash64(F.array_join(u, " ")))))
    df = _sliding(df, g, k, lambda a, b: F.xxhash64(a, b))
    df = df.withColumn(g, F.transform(F.coalesce(u, g), lambda h, i: h.bitwiseAND(F.lit(~LOW)).bitwiseOR(
        F.lit(LOW) - i.bitwiseAND(F.lit(LOW)))))
    df = df.withColumn(all_g, F.when(F.size(g).between(1, w - 1), F.array(F.array_min(g))))
    df = _sliding(df, g, w, lambda a, b: F.least(a, b))
    return df.withColumn(name, F.array_distinct(F.coalesce(all_g, g))).drop(u, g, all_g)


def hashes(packed: Column) -> Column:
    """The distinct hashes of a fingerprint, without positions."""
    return F.array_distinct(F.transform(packed, lambda v: F.shiftright(v, POSITION_BITS)))


def likeness(a: Column, b: Column) -> Column:
    """Shared share of the distinct hashes, 0 to 1; two empty fingerprints are alike (1)."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def as_text(packed: Column) -> Column:
    """``hash:position`` in hex and decimal, blank between."""
    return F.array_join(F.transform(packed, lambda v: F.concat(
        F.lower(F.hex(F.shiftright(v, POSITION_BITS).bitwiseAND(F.lit((1 << (64 - POSITION_BITS)) - 1)))), F.lit(":"),
        (F.lit(LOW) - v.bitwiseAND(F.lit(LOW))).cast("string"))), " ")


def next_lower(keys: DataFrame, most: int = 4096, bits: int = BUCKET_BITS) -> DataFrame:
    """(key, lower) for distinct long keys: the next smaller key, NULL for the smallest.

    Windows over groups of neighbouring keys; the smallest of a group takes the largest of the next
    lower group, found the same way one level up, until at most ``most`` keys stand in one window.
    """
    keys = keys.select("key").distinct()
    order = Window.orderBy("key")
    if keys.limit(most + 1).count() <= most:
        return keys.select("key", F.lag("key").over(order).alias("lower"))
    grouped = stage(keys.withColumn("up", F.shiftright("key", bits)), "key-groups")
    tops = grouped.groupBy("up").agg(F.max("key").alias("top"))
    above = next_lower(tops.select(F.col("up").alias("key")), most, bits).select(F.col("key").alias("up"), "lower")
    above = above.join(tops.select(F.col("up").alias("lower"), "top"), "lower", "left").select("up", "top")
    inner = grouped.withColumn("lower", F.lag("key").over(Window.partitionBy("up").orderBy("key")))
    return inner.join(above, "up", "left").select("key", F.coalesce("lower", "top").alias("lower"))


def with_next(docs: DataFrame, derive, extra: list[str]) -> DataFrame:
    """Rows (doc_id, text, ``extra``) with the next row's text and extra columns, in descending doc_id.

    One shuffle of the texts, by groups of neighbouring ids. ``derive`` adds the ``extra`` columns after
    that shuffle. The last row of a group takes the first one of the next group, of which
    there is one row per group. After the last row comes the first. Rows without an id
    form a group at the end; equal ids are ordered by their text's hash.
    """
    group = F.coalesce(F.shiftright("doc_id", BUCKET_BITS), F.lit(-(1 << 62)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("group", group)
    first = rows.groupBy("group").agg(F.max_by("text", F.struct(
        F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))), -F.crc32(F.col("text").cast("binary")), F.xxhash64("text"))).alias("text"))
    heads = derive(stage(first, "group-heads"))
    chain = next_lower(heads.select(F.col("group").alias("key")))
    largest = heads.agg(F.max("group")).first()[0]
    chain = chain.select("key", F.coalesce("lower", F.lit(largest).cast("long")).alias("lower"))
    heads = chain.join(heads.withColumnRenamed("group", "lower"), "lower").select(
        F.col("key").alias("group"), *[F.col(c).alias(f"head_{c}") for c in ["text", *extra]])
    order = Window.partitionBy("group").orderBy(
        F.col("doc_id").desc_nulls_last(), F.crc32(F.col("text").cast("binary")), F.xxhash64("text").desc())
    rows = derive(rows.repartition("group"))
    rows = rows.withColumns({"is_last": F.lead(F.lit(1)).over(order).isNull()} | {
        f"next_{c}": F.lead(c).over(order) for c in ["text", *extra]})
    return rows.join(heads, "group").select(
        "doc_id", "text", *extra,
        *[F.when(F.col("is_last"), F.col(f"head_{c}")).otherwise(F.col(f"next_{c}")).alias(f"next_{c}") for c in ["text", *extra]])


def fingerprints(docs: DataFrame, k: int = K, w: int = W, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, fingerprint (packed longs) of every row; NULL texts count as empty."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return with_fingerprint(rows, F.col("text"), "fingerprint", k, w).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "fingerprint")


def edit_probe(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next document's are."""
    rows = with_next(docs.select("doc_id", "text"), lambda d: with_fingerprint(d, F.col("text"), "prints", k, w), ["prints"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(
        F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"),
        F.substring(F.col("next_text"), F.lit(1), half)))
    rows = with_fingerprint(rows.drop("next_text"), F.col("edited"), "edited_prints", k, w)
    rows = rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "prints", "edited_prints", hashes(F.col("prints")).alias("own"), hashes(F.col("edited_prints")).alias("other"),
        hashes(F.col("next_prints")).alias("following"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("prints")).alias("fingerprint"),
        as_text(F.col("edited_prints")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"))
