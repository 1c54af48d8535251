"""N-gram Jaccard join over count vectors.

Every document is a set of hashed word n-grams. Tokens are hashed into groups, and the counts of the groups
make a point; the overlap of two sets is at most the sum of the coordinate minima of their points. The
index over the points has two levels:

* Leaves by equal blocks. Linked sets differ in at most tau tokens, so of more than tau blocks of groups one holds the
  same tokens in both. A leaf is one (size band, block, content of the block); each document lies in
  one leaf per block, and linked documents share a leaf. (A plain R-tree over the counts does not separate: hashed counts of unrelated texts of one size lie
  within a few standard deviations of each other in every coordinate, so its boxes meet nearly all others; see the README.)
* Boxes in a leaf. Points of a leaf are packed in boxes; box pairs, then point pairs, are dropped by the summed minima of
  their upper corners. Large leaves are cut into chunks, and pairs of chunks are the units of work.

Between point and set lies a sketch: the parities of the counts of many more groups, as bits. Each odd sum of two parities is a
token that only one of the two sets has, so they bound how far the sets are apart, and pairs that merely resemble each other, or share a leaf by
one token, are dropped before any set moves.

What survives is verified on the sets. Documents of equal sets are one class throughout, and classes already
in one component are not paired again, so a group of near copies costs a star, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quotegrid.llm.common import LOWER, Cache, bitmap, connected_components, in_bitmap, list_array, mixed, slices, windows, word_hash, worker_cache
from quotegrid.session import WorkingTables, stage

GROUPS = 128  # coordinates of a point
CHUNK_POINTS = 1024
BOX_POINTS = 32
CELL_BITS = 1 << 26
#: Parts in which leaves are counted, one after the other: the disk that their shuffle takes at a time.
RANGES = 4
#: The same for the units of work, whose points and sketches are shuffled.
UNIT_RANGES = 2
#: Pairs whose sketches are compared at a time.
SKETCHED = 1 << 14
DOC_BITS = 1 << 24


class Bands:
    """Size bands and, for each, the number of blocks; ``p / q`` is the least similarity."""

    def __init__(self, p: int, q: int, most: int = 1 << 31):
        self.p, self.q = p, q
        self.starts = [1]
        while self.starts[-1] < most:
            s = self.starts[-1]
            self.starts.append(max(s + 1, -(-s * q // p)))

    @lru_cache(maxsize=4096)  # noqa: B019
    def blocks(self, band: int) -> tuple[int, int]:
        """(blocks, empty blocks from which on they count as leaves too) for pairs whose larger set lies in the band.

        Of ``blocks`` at least that many agree, so a document with fewer empty ones has a non-empty one among
        them. (0, 0): only equal sets can be linked.
        """
        high = self.starts[band + 1] - 1
        low = -(-self.starts[band] * self.p // self.q)
        tau = (self.q - self.p) * 2 * high // (self.q + self.p)
        if tau == 0:
            return 0, 0
        spare = 1
        for _ in range(20):
            k = tau + spare
            empty = k * np.exp(-low / k)
            want = max(1, int(np.ceil(empty + 2 * np.sqrt(empty)))) if empty > 0.05 else 1
            if want <= spare:
                break
            spare = want
        return tau + spare, spare

    def of(self, n: int) -> Iterator[int]:
        """The bands in which a set of n tokens may be the larger or the smaller of a pair."""
        band = int(np.searchsorted(self.starts, n, side="right")) - 1
        yield band
        if self.starts[band + 1] <= n * self.q // self.p:
            yield band + 1


@lru_cache(maxsize=8)
def bands(p: int, q: int) -> Bands:
    return Bands(p, q)


def shingles(body: bytes, k: int, cache: Cache) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; fewer words are one shingle, no word none."""
    words = body.translate(LOWER).split()
    return np.unique(windows(np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)), k))


def class_of(tokens: np.ndarray) -> int:
    """The class of a set: a 64-bit hash of its sorted tokens, as a signed number."""
    return word_hash(tokens.tobytes()) - (1 << 63)


def leaves(tokens: np.ndarray, of: Bands) -> np.ndarray:
    """The leaf keys of a set."""
    out = []
    for band in of.of(len(tokens)):
        k, spare = of.blocks(band)
        if not k:
            continue
        block = (mixed(tokens + np.uint64(band * 0x9E37)) % np.uint64(k)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        block = block[order]
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        sums = np.add.reduceat(mixed(tokens * np.uint64(0xD6E8FEB86659FD93))[order], first)
        used = block[first]
        place = lambda b, band=band: b.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band << 40)
        out.append(mixed(mixed(place(used)) + sums))
        if k - len(used) >= spare:
            empty = np.setdiff1d(np.arange(k), used)
            out.append(mixed(mixed(place(empty)) + np.uint64(0x5851F42D4C957F2D)))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, dtype=np.int64)


def point(tokens: np.ndarray) -> bytes:
    """Counts of the token groups, as little-endian 32-bit numbers."""
    return np.bincount((mixed(tokens) >> np.uint64(57)).astype(np.int64), minlength=GROUPS).astype("<i4").tobytes()


def sketch(tokens: np.ndarray) -> bytes:
    """Parities of the counts of token groups, a bit each: a power of two of groups, more for larger sets.

    There are twice as many groups as tokens, or three quarters as many where that is over 2,048 (0.1 to 0.2 bytes a token): enough to
    tell sets somewhat below the least similarity from linked ones, of large sets unrelated ones.
    """
    n = len(tokens)
    bits = 1 << (max(256, min(2 * n, max(2048, n * 3 // 4))) - 1).bit_length()
    odd = np.bincount((mixed(tokens * np.uint64(0x9FB21C651E98DF25)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_apart(sketches: list[bytes], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For the index pairs, how many tokens at least are in one set only. Of two sizes the larger sketch is folded to the smaller."""
    out, small = np.zeros(len(x), dtype=np.int64), np.minimum(*(np.array([len(s) for s in sketches], dtype=np.int64)[i] for i in (x, y)))
    for size in np.unique(small):
        at = np.flatnonzero(small == size)
        rows, place = np.unique(np.concatenate([x[at], y[at]]), return_inverse=True)
        table = np.stack([np.bitwise_xor.reduce(np.frombuffer(sketches[r], dtype="<u8").reshape(-1, size // 8), axis=0) for r in rows])
        for a in range(0, len(at), SKETCHED):
            one, other = place[a:min(a + SKETCHED, len(at))], place[len(at) + a:len(at) + a + SKETCHED]
            out[at[a:a + SKETCHED]] = np.bitwise_count(table[one] ^ table[other]).sum(axis=1)
    return out


def may_link(sketches: list[bytes], n: np.ndarray, x: np.ndarray, y: np.ndarray, p: int, q: int) -> np.ndarray:
    """Which index pairs a link is possible for, by sizes and sketches."""
    total = n[x] + n[y]
    fits = p * np.maximum(n[x], n[y]) <= q * np.minimum(n[x], n[y])
    return fits & (least_apart(sketches, x, y) * (p + q) <= (q - p) * total)


def _bodies(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(*more, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"))


def sets_of(docs: DataFrame, k: int, p: int, q: int) -> DataFrame:
    """doc_id, copy (hash of the text), n, class and leaves of every row, in one pass over the texts.

    Equal sets of a slice have their leaves listed once. A row without a shingle is a class of its own and has none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, of = worker_cache(word_hash), bands(p, q)
        for part in slices(batches, "body"):
            cache.trim()
            n, node, at, seen = [], [], [], set()
            for body, alone in zip(part.column("body").to_pylist(), part.column("alone").to_pylist(), strict=True):
                tokens = shingles(body, k, cache)
                n.append(len(tokens))
                node.append(class_of(tokens) if len(tokens) else alone)
                at.append(leaves(tokens, of) if len(tokens) and node[-1] not in seen else np.zeros(0, dtype=np.int64))
                seen.add(node[-1])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("copy"), pa.array(n, type=pa.int64()), pa.array(node, type=pa.int64()), list_array(at, pa.int64())],
                names=["doc_id", "copy", "n", "node", "leaves"])

    key = F.col("doc_id").cast("long").alias("doc_id")
    alone = F.xxhash64(F.lit("empty"), F.col("doc_id").isNull(), F.col("doc_id")).alias("alone")
    rows = _bodies(docs, key, F.xxhash64("text").alias("copy"), alone)
    return rows.mapInArrow(run, "doc_id long, copy long, n long, node long, leaves array<long>")


def shared_leaves(rows: DataFrame, steps: WorkingTables) -> DataFrame:
    """The leaves that hold two classes or more, worked off by ranges of their hashes: one range at a time is shuffled."""
    found = []
    for i in range(RANGES):
        each = rows.select("node", F.explode("leaves").alias("leaf")).where(F.pmod("leaf", F.lit(RANGES)) == i)
        ends = each.groupBy("leaf").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
        found.append(steps.keep(ends.where("lo < hi").select("leaf"), "shared"))
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    return out


def leaf_rows(rows: DataFrame, only: np.ndarray) -> DataFrame:
    """(leaf, node) of every row of :func:`sets_of` and leaf (probably) in the bitmap."""
    shared = rows.sparkSession.sparkContext.broadcast(only)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(shared.value, batch.column("leaf").to_numpy())))

    # Lists are taken apart before they reach Python: a row may have several hundred leaves, and a batch counts rows.
    return rows.select(F.explode("leaves").alias("leaf"), "node").mapInArrow(run, "leaf long, node long")


def token_sets(docs: DataFrame, k: int, wanted: DataFrame) -> DataFrame:
    """node, n, tokens, point, sketch of the classes in ``wanted`` (node, doc_id: one document of each), each once."""
    named = wanted.where("doc_id is not null")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(named.select(F.xxhash64("doc_id").alias("h")), "h", DOC_BITS))  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, table = worker_cache(word_hash), shared.value
        for batch in batches:
            maybe = in_bitmap(table, batch.column("h").to_numpy(zero_copy_only=False)) | batch.column("unnamed").to_numpy(zero_copy_only=False)
            for part in slices(iter([batch.filter(pa.array(maybe))]), "body"):
                cache.trim()
                found = [t for t in (shingles(b, k, cache) for b in part.column("body").to_pylist()) if len(t)]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([class_of(t) for t in found], type=pa.int64()), pa.array([len(t) for t in found], type=pa.int64()),
                         list_array([t.view(np.int64) for t in found], pa.int64()), pa.array([point(t) for t in found], type=pa.binary()),
                         pa.array([sketch(t) for t in found], type=pa.binary())],
                        names=["node", "n", "tokens", "point", "sketch"])

    rows = _bodies(docs, F.xxhash64("doc_id").alias("h"), F.col("doc_id").isNull().alias("unnamed"))
    sets = rows.mapInArrow(run, "node long, n long, tokens array<long>, point binary, sketch binary")
    return sets.join(wanted.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame, p: int, q: int, steps: WorkingTables) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough: by sizes and sketches first, those left token by token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(iter([whole]), "sb"):
                m = batch.num_rows
                sketches = batch.column("sa").to_pylist() + batch.column("sb").to_pylist()
                n = np.concatenate([batch.column(c).to_numpy() for c in ("na", "nb")])
                keep = may_link(sketches, n, np.arange(m), np.arange(m, 2 * m), p, q)
                yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(keep))

    short = sets.select("node", "n", "sketch")
    near = steps.keep(pairs.join(short.toDF("a", "na", "sa"), "a").join(short.toDF("b", "nb", "sb"), "b").mapInArrow(
        run, "a long, b long, na long, nb long"), "near")
    # The sets are bucketed by node: those of a do not move to meet their pairs; of b only the few that are wanted do, so
    # that both sides of the last join are shuffled and a set that many pairs share can be split.
    others = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")).join(near.select("b").distinct(), "b", "left_semi")
    rows = near.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a").join(others.hint("shuffle_merge"), "b")
    rows = rows.withColumn("both", F.size(F.array_intersect("ta", "tb")))
    return rows.where(F.lit(q) * F.col("both") >= F.lit(p) * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def star_pairs(members: DataFrame) -> DataFrame:
    """One pair per class: with the hub it shares most leaves with. A leaf's hub is its class that meets most others in all leaves."""
    size = members.groupBy("leaf").agg(F.count("*").alias("m"))
    weight = members.join(size, "leaf").groupBy("node").agg(F.sum("m").alias("w"))
    hub = members.join(weight, "node").groupBy("leaf").agg(F.max_by("node", F.struct("w", "node")).alias("b"))
    met = members.join(hub, "leaf").where("node <> b").groupBy(F.col("node").alias("a"), "b").agg(F.count("*").alias("c"))
    return met.groupBy("a").agg(F.max_by("b", F.struct("c", "b")).alias("b"))


def surviving(points: np.ndarray, n: np.ndarray, comp: np.ndarray, side: np.ndarray, p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose bound on the overlap allows a link, of different components; with two sides, across them only.

    Boxes of neighbouring points (by component and size) are compared by their upper corners first.
    """
    order = np.lexsort((n, comp, side))
    boxes = [order[i:i + BOX_POINTS] for i in range(0, len(order), BOX_POINTS)]
    top = np.stack([points[b].max(axis=0) for b in boxes])
    least = np.array([n[b].min() for b in boxes])
    across = side.any() and not side.all()
    left, right = [], []
    for i, a in enumerate(boxes):
        meets = np.minimum(top[i], top[i:]).sum(axis=1) * (p + q) >= p * (least[i] + least[i:])
        for j in np.flatnonzero(meets) + i:
            b = boxes[j]
            bound = np.minimum(points[a][:, None, :], points[b][None, :, :]).sum(axis=2)
            total = n[a][:, None] + n[b][None, :]
            good = (bound * (p + q) >= p * total) & (comp[a][:, None] != comp[b][None, :])
            good &= p * np.maximum(n[a][:, None], n[b][None, :]) <= q * np.minimum(n[a][:, None], n[b][None, :])
            if across:
                good &= side[a][:, None] != side[b][None, :]
            if i == j:
                good &= np.triu(np.ones(good.shape, dtype=bool), 1)
            x, y = np.nonzero(good)
            left.append(a[x])
            right.append(b[y])
    return np.concatenate(left), np.concatenate(right)


def leaf_pairs(members: DataFrame, sets: DataFrame, p: int, q: int, steps: WorkingTables) -> DataFrame:
    """Pairs (a, b) of classes of different components that share a leaf and survive the bounds.

    ``members`` has leaf, node, comp. Leaves are worked off by ranges of their hashes, so that the points and sketches of one range at a
    time are on the disks.
    """
    found = [steps.keep(_pairs_of_leaves(members.where(F.pmod("leaf", F.lit(UNIT_RANGES)) == i), sets, p, q), "part") for i in range(UNIT_RANGES)]
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    return out.distinct()


def _pairs_of_leaves(members: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """The pairs of some leaves.

    A leaf of many points is cut into chunks of about ``CHUNK_POINTS``; each
    pair of chunks is one unit, so no unit grows with the leaf.
    """
    info = members.groupBy("leaf").agg(F.count("*").alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    info = info.where("lo < hi").select("leaf", F.ceil(F.col("m") / CHUNK_POINTS).cast("int").alias("chunks"))
    rows = members.join(info, "leaf").withColumn("c", F.pmod(F.xxhash64("node", "leaf"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("node", "comp", "leaf", F.least("c", "j").alias("c1"), F.greatest("c", "j").alias("c2"), (F.col("c") > F.col("j")).alias("second"))
    rows = rows.join(sets.select("node", "n", "point", "sketch"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def unit(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            get = lambda c: rows.column(c).to_numpy()
            points = np.frombuffer(b"".join(rows.column("point").to_pylist()), dtype="<i4").reshape(-1, GROUPS)
            node = get("node")
            x, y = surviving(points, get("n"), get("comp"), get("second").astype(np.int8), p, q)
            near = may_link(rows.column("sketch").to_pylist(), get("n"), x, y, p, q)
            x, y = x[near], y[near]
            return np.minimum(node[x], node[y]), np.maximum(node[x], node[y])

        rest = None
        for batch in _with_end(batches):
            table = rest if batch is None else pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            if table is None or not table.num_rows:
                continue
            table = table.combine_chunks()
            key = np.stack([table.column(c).to_numpy() for c in ("leaf", "c1", "c2")])
            cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            ends = [*cut.tolist(), *([table.num_rows] if batch is None else [])]
            start, found = 0, []
            for end in ends:
                if end - start > 1:
                    found.append(unit(table.slice(start, end - start)))
                start = end
            rest = table.slice(start)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[i] for f in found])) for i in (0, 1)], names=["a", "b"])

    units = rows.repartition("leaf", "c1", "c2").sortWithinPartitions("leaf", "c1", "c2")
    return units.mapInArrow(run, "a long, b long").distinct()


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def components(docs: DataFrame, k: int = 3, p: int = 90, q: int = 100) -> DataFrame:
    """doc_id, copy, n_shingles, component_id and node of every row of ``docs`` (doc_id, text).

    Two rows link when their shingle sets have a Jaccard similarity of at least p / q; component_id is the smallest doc_id
    reachable. Empty sets link with nothing. NULL texts count as empty; rows without an id link as others do and
    never name a component with ids in it; repeated rows are all returned; columns other than doc_id and text are not read.
    Classes and shingles are 64-bit hashes: links are exact but for collisions of those.
    """
    docs, steps = docs.select("doc_id", "text"), WorkingTables("near")
    wide = steps.keep(sets_of(docs, k, p, q), "leaves")
    rows = steps.keep(wide.drop("leaves"), "sets")
    shared = shared_leaves(wide, steps)
    members = leaf_rows(wide, bitmap(shared, "leaf", CELL_BITS)).distinct().join(shared, "leaf", "left_semi")
    members = steps.keep(members, "members")
    steps.drop(wide)
    wanted = members.select("node").distinct().join(rows.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "node")
    wanted = steps.keep(wanted, "wanted")
    sets = steps.keep_bucketed(token_sets(docs, k, wanted), "tokens", "node")
    links = steps.keep(verified(star_pairs(members), sets, p, q, steps), "links")
    first = connected_components(links)
    now = members.join(first, "node", "left").select("leaf", "node", F.coalesce("label", "node").alias("comp"))
    pairs = steps.keep(leaf_pairs(now, sets, p, q, steps), "pairs")
    more = steps.keep(verified(pairs, sets, p, q, steps), "more")
    steps.drop(pairs, members)
    # Classes by the smallest id of their rows: the label that components end with names them, and no row is gathered by label.
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node")
    names = wanted.select("node", name.alias("name"))
    named = links.union(more).join(names.toDF("a", "na"), "a").join(names.toDF("b", "nb"), "b").select(
        F.col("na").alias("a"), F.col("nb").alias("b"))
    final = connected_components(named).select(F.col("node.node").alias("node"), "label")
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node")
    alone = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id")).select("node", own.alias("own")).join(final, "node", "left").select(
        "node", F.coalesce("label", "own").alias("label"))
    return steps.keep(rows.join(alone, "node").select(
        "doc_id", "copy", F.col("n").alias("n_shingles"), F.col("label.doc_id").alias("component_id"), "node",
        F.col("label.node").alias("label")), "labelled")


def keep_one(docs: DataFrame, k: int = 5, p: int = 80, q: int = 100) -> DataFrame:
    """One row of each component, the one of the smallest doc_id; columns as they are.

    Rows without a shingle all stay, but for repeated rows of one id. Only rows that may have to go are shuffled:
    a bitmap of fixed size tells the others apart.
    """
    found = components(docs, k, p, q)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "copy")
    best = found.groupBy("label").agg(F.min_by(F.struct("doc_id", "copy"), rank).alias("best"))
    # rows of one id and text are told apart by nothing: they are one group, of which one row stays
    same = lambda d, c: F.xxhash64(F.coalesce(d, F.lit(-1)), c)
    keyed = found.join(best, "label").select(
        same(F.col("doc_id"), F.col("copy")).alias("row_key"),
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & F.col("copy").eqNullSafe(F.col("best.copy"))).alias("stays"))
    per_key = keyed.groupBy("row_key").agg(F.max("stays").alias("stays"), F.count("*").alias("rows"))
    doubtful = stage(per_key.where("not stays or rows > 1"), "doubtful")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(doubtful, "row_key", CELL_BITS))
    keyed_docs = docs.select(F.struct(*docs.columns).alias("row"), same(F.col("doc_id"), F.xxhash64("text")).alias("row_key"))
    from pyspark.sql.types import BooleanType, StructField, StructType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maybe = in_bitmap(shared.value, batch.column("row_key").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(maybe)], names=["row", "row_key", "maybe"])

    marked = keyed_docs.mapInArrow(run, StructType([*keyed_docs.schema.fields, StructField("maybe", BooleanType())]))
    sure = marked.where("not maybe").select("row.*")
    held = marked.where("maybe").join(doubtful, "row_key", "left")
    kept = held.where("stays is null").select("row.*").union(
        held.where("stays").select("row", "row_key").dropDuplicates(["row_key"]).select("row.*"))
    return sure.union(kept)
