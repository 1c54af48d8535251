"""The trie of conversation prefixes, its subtree totals rolled up by depth bands.

A node is a distinct sequence of first turns; its key is its depth with 128 bits that fold in one hash of (turn, depth) per
turn, so a prefix's key is a running XOR and its parent's key is one XOR away. Running values are taken in two steps,
over chunks and inside a chunk, so a conversation of any length is spread over tasks.

Totals: depths are cut into bands of ``BAND``. A node adds its values to its ancestors inside its band only, from the
band's part of its smallest member's path. The roots of bands form a trie ``BAND`` times less high; the same roll-up gives their
completed totals, and each of these is added to the ancestors in the band above. A node is thus copied ``BAND`` times at
most, and a trie of height h takes about log h / log ``BAND`` rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quotegrid.session import stage

BAND = 16
#: Steps of a conversation whose running hash one task takes, and ids of one piece of a member list.
CHUNK = 1024
#: Conversations that share an opening, and turns shared at most.
FAMILY = 20
MOST_SHARED = 4
WORD = r"[^\x20\x09-\x0D]+"
VALUES = ("n_leaves", "saved_tokens")


def numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, digest, words``: the turns of each conversation from place 1 on.

    Order: turn (NULL first), then the digest of role and text, so that the result is the same for repeated turns and ties. NULL role or
    text is empty; rows without conv_id belong to no conversation and are left out. Numbers are counted inside ranges of
    the sorted rows and shifted by the counts of the ranges before, so no conversation is sorted in one task.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.md5(F.concat(F.md5(role.cast("binary")), F.md5(text.cast("binary")))).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    parts = stage(turns.repartitionByRange("conv_id", F.col("turn").asc_nulls_first(), "digest").withColumn(
        "_part", F.spark_partition_id()), "trie-turns")
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.groupBy("conv_id", "_part").agg(F.count("*").alias("_n")).select(
        "conv_id", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("conv_id", "_part").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return parts.withColumn("_i", F.row_number().over(inside)).join(shift, ["conv_id", "_part"]).select(
        "conv_id", (F.col("_i") + F.col("_before")).alias("place"), "digest", "words")


def shared_turns(conv_id: Column) -> Column:
    """How many opening turns a conversation takes from the first of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Steps ``conv_id, depth, digest, words`` of the rebuilt conversations, and ``conv_id, length`` of all.

    A conversation opens with the first turns of its family's first member (``c - c % FAMILY``, with the sign of ``c``), as many as
    there are of :func:`shared_turns`, and goes on with its own after as many. A conversation without any turn left has length 0.
    """
    h = shared_turns(F.col("conv_id"))
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    bases = sizes.where(base == F.col("conv_id")).select(F.col("conv_id").alias("_base"), F.col("n").alias("_has"))
    convs = stage(sizes.withColumn("_base", base).join(bases, "_base", "left").select(
        "conv_id", "_base", h.alias("_h"), F.least(h, F.coalesce("_has", F.lit(0))).alias("_k"), "n",
    ).withColumn("length", F.col("_k") + F.greatest(F.col("n") - F.col("_h"), F.lit(0))), "trie-conversations")
    own = turns.join(convs.select("conv_id", "_h", "_k"), "conv_id").where("place > _h").select(
        "conv_id", (F.col("place") - F.col("_h") + F.col("_k")).alias("depth"), "digest", "words")
    opening = turns.where(F.col("place") < MOST_SHARED).withColumnRenamed("conv_id", "_base")
    opening = convs.select("conv_id", "_base", "_k").join(opening, "_base").where("place <= _k").select(
        "conv_id", F.col("place").alias("depth"), "digest", "words")
    return own.union(opening), convs.select("conv_id", "length")


def paths(steps: DataFrame) -> DataFrame:
    """``conv_id, depth, p1, p2, q1, q2, words``: the key of every prefix (p) and of its parent (q)."""
    keyed = steps.withColumns({
        "g1": F.xxhash64("digest", "depth"), "g2": F.xxhash64("depth", "digest", F.lit(1)),
        "_chunk": F.floor((F.col("depth") - 1) / CHUNK),
    })
    running = Window.partitionBy("conv_id", "_chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = keyed.groupBy("conv_id", "_chunk").agg(F.bit_xor("g1").alias("c1"), F.bit_xor("g2").alias("c2")).select(
        "conv_id", "_chunk", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(c) for c in ("c1", "c2")])
    inside = keyed.withColumns({f"i{k}": F.bit_xor(f"g{k}").over(running) for k in (1, 2)})
    full = inside.join(chunks, ["conv_id", "_chunk"]).withColumns(
        {f"p{k}": F.col(f"i{k}").bitwiseXOR(F.col(f"c{k}")) for k in (1, 2)})
    return full.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "p1", "p2",
        *[F.col(f"p{k}").bitwiseXOR(F.col(f"g{k}")).alias(f"q{k}") for k in (1, 2)], "words")


def trie_nodes(rows: DataFrame) -> DataFrame:
    """``depth, p1, p2, node, n_convs, words, parent, n_children``; ``node``: the smallest member, with the depth a node's name."""
    key = ["depth", "p1", "p2"]
    nodes = stage(rows.groupBy(*key).agg(
        F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.min("q1").alias("q1"), F.min("q2").alias("q2")), "trie-keys")
    above = (F.col("depth") - 1).alias("depth")
    children = nodes.where("depth > 0").groupBy(above, F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("node").alias("parent"))
    return nodes.join(parents, ["depth", "q1", "q2"], "left").join(children, key, "left").select(
        *key, "node", "n_convs", "words", "parent", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"))


def rollup(rows: DataFrame, height: int, values: tuple[str, ...] = VALUES, band: int = BAND) -> DataFrame:
    """``depth, node`` and the sums of ``values`` over the node's subtree, itself included.

    ``rows``: ``conv_id, depth, node, *values`` for every conversation and depth of its path; a node's values count
    on the row of the conversation it is named after. ``height``: the largest depth.
    """
    named = lambda x: x["node"] == F.col("conv_id")
    parts = rows.withColumn("_band", F.floor(F.col("depth") / band)).groupBy("conv_id", "_band").agg(
        F.sort_array(F.collect_list(F.struct("depth", "node", *values))).alias("_items"))
    if height >= band:
        parts = stage(parts, "trie-bands")

    def below(a: Column, value: str) -> Column:
        own = F.filter("_items", lambda x: named(x) & (x["depth"] >= a["depth"]))
        return F.aggregate(own, F.lit(0).cast("long"), lambda s, x: s + x[value]).alias(value)

    adds = F.transform("_items", lambda a: F.struct(a["depth"].alias("depth"), a["node"].alias("node"), *[below(a, v) for v in values]))
    adds = parts.where(F.exists("_items", named)).select(F.explode(adds).alias("_a")).select("_a.*")
    sums = [F.sum(v).alias(v) for v in values]
    inside = adds.groupBy("depth", "node").agg(*sums)
    if height < band:
        return inside
    inside = stage(inside, "trie-inside")
    roots = rows.where(F.col("depth") % band == 0).select("conv_id", "depth", "node").join(inside, ["depth", "node"], "left")
    roots = roots.withColumn("depth", F.floor(F.col("depth") / band)).select("conv_id", "depth", "node", *values)
    completed = rollup(stage(roots, "trie-roots"), height // band, values, band).where("depth > 0")
    handed = completed.select(F.col("node").alias("conv_id"), (F.col("depth") - 1).alias("_band"), *values).join(
        parts.select("conv_id", "_band", F.transform("_items", lambda x: F.struct(x["depth"].alias("depth"), x["node"].alias("node"))).alias("_items")),
        ["conv_id", "_band"])
    handed = handed.select(F.explode("_items").alias("_a"), *values).select("_a.*", *values)
    return inside.unionByName(handed).groupBy("depth", "node").agg(*sums)


ENDS = "depth long, p1 long, p2 long, ends_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per run of equal keys; pieces come in order, and only one digest's state is held."""
    key, state = None, None
    for batch in batches:
        out = []
        for d, p1, p2, piece in zip(*(batch.column(c).to_pylist() for c in ("depth", "p1", "p2", "piece"))):
            if (d, p1, p2) != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (d, p1, p2), hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["depth", "p1", "p2", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, state.hexdigest())], names=["depth", "p1", "p2", "ends_sha256"])


def member_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ids of each key's rows ``depth, p1, p2, conv_id`` (distinct ids).

    Ids are joined in pieces of ``CHUNK`` neighbouring numbers; a digest is one chain, so the pieces of a key stream through one task.
    """
    pieces = ends.groupBy("depth", "p1", "p2", F.floor(F.col("conv_id") / CHUNK).alias("_chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("piece"))
    return pieces.repartition("depth", "p1", "p2").sortWithinPartitions("depth", "p1", "p2", "_chunk").select(
        "depth", "p1", "p2", "piece").mapInArrow(_digests, ENDS)


def prefix_trie(steps: DataFrame, lengths: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of the trie of ``steps`` (see :func:`rebuilt`); every conversation of ``lengths`` is a member of the root.

    ``conv_id`` is the smallest member, ``parent_conv_id`` the parent's (root: NULL). Without conversations there is no node.
    """
    zero = F.lit(0).cast("long")
    root = lengths.select("conv_id", *[zero.alias(c) for c in ("depth", "p1", "p2", "q1", "q2", "words")])
    rows = stage(paths(steps).unionByName(root), "trie-paths")
    key = ["depth", "p1", "p2"]
    nodes = stage(trie_nodes(rows).withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}), "trie-nodes")
    labelled = stage(rows.select("conv_id", *key).join(nodes.select(*key, "node", *VALUES), key).select(
        "conv_id", "depth", "node", *VALUES), "trie-labels")
    height = nodes.agg(F.max("depth")).first()[0] or 0
    totals = rollup(labelled, height, band=band)
    ends = rows.select("conv_id", *key).join(lengths, "conv_id").where("depth = length").select(*key, "conv_id")
    return nodes.drop(*VALUES).join(totals, ["depth", "node"]).join(member_digests(ends), key, "left").select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", *VALUES,
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def trie_report(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations. Columns other than conv_id, turn, role and text do not matter."""
    steps, lengths = rebuilt(stage(numbered(conversations), "trie-numbered"))
    return prefix_trie(steps, lengths)


ORACLE = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS digest, turn,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
  SELECT conv_id, digest, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS place FROM turns
), convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base,
         xor(list_reduce(
           list_prepend(4294967295::BIGINT, flatten(list_transform(split(conv_id::VARCHAR, ''),
             lambda c: [ascii(c)::BIGINT] || list_transform(range(8), lambda i: -1::BIGINT)))),
           lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END
         ), 4294967295) % 4 AS h
  FROM numbered GROUP BY conv_id
), steps AS (
  SELECT c.conv_id, t.place - c.h + least(c.h, coalesce(b.n, 0)) AS depth, t.digest, t.words
  FROM convs c JOIN numbered t USING (conv_id) LEFT JOIN convs b ON b.conv_id = c.base WHERE t.place > c.h
  UNION ALL
  SELECT c.conv_id, t.place, t.digest, t.words FROM convs c JOIN numbered t ON t.conv_id = c.base WHERE t.place <= c.h
), path AS (
  SELECT conv_id, depth, words, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth) AS prefix FROM steps
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), named AS (
  SELECT *, min(conv_id) OVER (PARTITION BY depth, prefix) AS node, max(depth) OVER (PARTITION BY conv_id) AS length FROM path
), nodes AS (
  SELECT depth, node, count(*) AS n_convs, max(words) AS words,
         coalesce(string_agg(CASE WHEN depth = length THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends
  FROM named GROUP BY depth, node
), linked AS (
  SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN named p ON p.conv_id = n.node AND p.depth = n.depth - 1
), counted AS (
  SELECT l.*, (SELECT count(*) FROM linked c WHERE c.parent = l.node AND c.depth = l.depth + 1) AS n_children FROM linked l
), totals AS (
  SELECT a.depth, a.node, sum(CASE WHEN d.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((d.n_convs - 1) * d.words) AS saved
  FROM counted d JOIN named a ON a.conv_id = d.node AND a.depth <= d.depth GROUP BY a.depth, a.node
)
SELECT c.node::BIGINT AS conv_id, c.depth::BIGINT AS depth, c.parent::BIGINT AS parent_conv_id, c.n_convs::BIGINT AS n_convs,
       c.n_children::BIGINT AS n_children, t.n_leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, sha256(c.ends) AS ends_sha256
FROM counted c JOIN totals t USING (depth, node)
"""
