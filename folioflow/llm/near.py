"""Near-duplicates by an LSH forest over MinHash signatures.

Documents with equal shingle sets are one class from the start. The classes' signatures are sorted in several orders,
one for each tree of the forest; in each order a class is compared with its next neighbours, as long as they share a
prefix. Where many are alike the nearest neighbours share a long prefix, where few are a short one does: the depth fits
the region. Links are confirmed on full shingle sets, and classes joined by them make a component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.common import ROW_KEY, join_facts, keep_marked, plain_text, staged
from folioflow.llm.tokens import by_bytes, text_sizes
from folioflow.llm.words import batch_hashes, mixed, shingles
from folioflow.session import shuffle_partitions

TREES = 16
DEPTH = 8  # values of a tree's label
MISSED = 2.5e-7  # at most with this probability the trees show a pair at the limit nowhere, for limits of 62 percent and more
SHALLOWEST = 3  # no limit asks candidates to share more values than this
NEIGHBOURS = 6  # candidates on one side in each order
WAVES = (1, 8)  # candidates of a class tried up to the end of each wave; the last wave has the rest
CROWD = 2048  # classes in a block of a crowded region
SIGNATURE = TREES * DEPTH
BATCH = 1 << 20

_draw = np.random.default_rng(8)
_MUL = _draw.integers(1, 1 << 63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _draw.integers(0, 1 << 63, SIGNATURE, dtype=np.uint64)


def shallowest(percent: int) -> int:
    """Values that candidates share at least: as many as let the trees miss a pair at the limit with probability MISSED at most.

    0.85 takes 3 (2.4e-7), 0.8 takes 2 (8e-8). Below 0.62 even one value misses more often, (1 - limit) ** TREES.
    """
    limit = percent / 100
    return max([k for k in range(1, SHALLOWEST + 1) if (1 - limit**k) ** TREES <= MISSED], default=1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of the shingles under SIGNATURE hash functions, as big-endian 32-bit numbers; all sets must be non-empty."""
    every = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), SIGNATURE), ">u4")
    for k in range(SIGNATURE):
        out[:, k] = np.minimum.reduceat((every * _MUL[k] + _ADD[k]) >> np.uint64(32), starts)
    return out


def set_key(own: np.ndarray) -> bytes:
    """16 bytes that equal sets share."""
    if not len(own):
        return b""
    other = mixed(own ^ np.uint64(0x5851F42D4C957F2D))
    return own.sum(dtype=np.uint64).tobytes() + other.sum(dtype=np.uint64).tobytes()


def _sets(texts: list[str], size: int) -> list[np.ndarray]:
    hashes, before = batch_hashes(texts)
    return [shingles(hashes[a:b], size) for a, b in zip(before[:-1], before[1:], strict=True)]


def fingerprints(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: row, id, n_shingles, key of the shingle set, signature (null for an empty set)."""

    def run(batches):
        for batch in batches:
            for lo, hi in by_bytes(text_sizes(batch.column(2)), BATCH):
                part = batch.slice(lo, hi - lo)
                sets = _sets(part.column(2).to_pylist(), size)
                full = [s for s in sets if len(s)]
                rows = iter(signatures(full) if full else [])
                sig = [next(rows).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) for s in sets], pa.binary()), pa.array(sig, pa.binary())],
                    ["row", "id", "n_shingles", "key", "signature"],
                )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), plain_text(text_col).alias("text"))
    return rows.mapInArrow(run, "row bigint, id bigint, n_shingles bigint, key binary, signature binary")


def _neighbours(labels: np.ndarray, tree: np.ndarray, n: np.ndarray, percent: int, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions i whose (i + lag)th neighbour shares at least `shallowest` values, and how many."""
    same = labels[:-lag] == labels[lag:]
    shared = np.cumprod(same, axis=1).sum(1) * (tree[:-lag] == tree[lag:])
    small, large = np.minimum(n[:-lag], n[lag:]), np.maximum(n[:-lag], n[lag:])
    fine = (shared >= shallowest(percent)) & (100 * small >= percent * large)
    found = np.flatnonzero(fine)
    return found, shared[found]


# Rows of a range that meet those of other ranges, and a row with the number of rows of a range.
TAIL, HEAD, COUNT = 0, 1, 2


def _reach(sizes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(later, range): the ranges after each that hold its last rows' next NEIGHBOURS rows, from (range, rows) in order."""
    out = []
    for i, (owner, _) in enumerate(sizes):
        covered = 0
        for later, n in sizes[i + 1 :]:
            out.append((later, owner))
            covered += n
            if covered >= NEIGHBOURS:
                break
    return out


def candidates(classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of class rows with a < b and the number of values they share as neighbours."""
    spark = classes.sparkSession
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    labelled = classes.select("row", "n_shingles", "signature", tree.alias("tree")).select(
        "tree", F.expr(f"substring(signature, 1 + {4 * DEPTH} * tree, {4 * DEPTH})").alias("label"), "row", "n_shingles"
    )
    order = ["tree", "label", "row"]
    # With the row in the order, a region that holds much of the data is cut like any other stretch of it.
    ranged = labelled.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    schema = "a bigint, b bigint, shared int, border int, tree int, label binary, row bigint, n_shingles bigint"

    def pairs_of(tree, label, row, n, later: int = 0):
        """Candidates among sorted rows; of the first `later` rows only with rows after them."""
        a, b, shared = [], [], []
        for lag in range(1, min(NEIGHBOURS, len(row) - 1) + 1):
            i, s = _neighbours(label, tree, n, percent, lag)
            if later:
                keep = (i < later) & (i + lag >= later)
                i, s = i[keep], s[keep]
            a.append(np.minimum(row[i], row[i + lag]))
            b.append(np.maximum(row[i], row[i + lag]))
            shared.append(s)
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return join(a), join(b), join(shared)

    def as_arrays(batch):
        label = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").reshape(-1, DEPTH)
        return batch.column(0).to_numpy(), label, batch.column(2).to_numpy(), batch.column(3).to_numpy()

    def blank(k, kind):
        return pa.nulls(k, kind)

    def run(batches):
        part = TaskContext.get().partitionId()
        held, first, seen = None, True, 0
        names = [c.split()[0] for c in schema.split(", ")]

        def border(arrays, kind):
            k = len(arrays[2])
            label = pa.array([x.tobytes() for x in arrays[1]], pa.binary())
            return pa.RecordBatch.from_arrays(
                [blank(k, pa.int64()), blank(k, pa.int64()), pa.array([kind] * k, pa.int32()), pa.array([part] * k, pa.int32()), pa.array(arrays[0], pa.int32()), label, pa.array(arrays[2], pa.int64()), pa.array(arrays[3], pa.int64())], names
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            own = as_arrays(batch)
            seen += batch.num_rows
            if first:
                yield border([x[:NEIGHBOURS] for x in own], HEAD)
                first = False
            overlap = 0
            if held is not None:
                overlap = len(held[2])
                joined = [np.concatenate([h, o]) for h, o in zip(held, own, strict=True)]
                a, b, s = pairs_of(*[x[: overlap + NEIGHBOURS] for x in joined], later=overlap)
                a2, b2, s2 = pairs_of(*own)
                a, b, s = np.concatenate([a, a2]), np.concatenate([b, b2]), np.concatenate([s, s2])
            else:
                joined = own
                a, b, s = pairs_of(*own)
            held = [x[-NEIGHBOURS:] for x in joined]
            k = len(a)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.int32()), blank(k, pa.int32()), blank(k, pa.int32()), blank(k, pa.binary()), blank(k, pa.int64()), blank(k, pa.int64())], names
            )
        if held is not None:
            yield border(held, TAIL)
            yield border([np.zeros(1, np.int32), np.zeros((1, 0), ">u4"), np.zeros(1, np.int64), np.array([seen])], COUNT)

    found = staged(ranged.mapInArrow(run, schema), "near-candidates")

    def over_border(rows: pa.Table) -> pa.Table:
        # The last rows of a range and the first of those after it, as many as have neighbours there: about 2 * NEIGHBOURS.
        rows = rows.sort_by([("tree", "ascending"), ("label", "ascending"), ("row", "ascending")])
        label = np.frombuffer(b"".join(rows.column("label").to_pylist()), ">u4").reshape(-1, DEPTH)
        before = int((rows.column("shared").to_numpy() == TAIL).sum())
        own = [rows.column("tree").to_numpy(), label, rows.column("row").to_numpy(), rows.column("n_shingles").to_numpy()]
        a, b, s = pairs_of(*own, later=before) if before else pairs_of(*[x[:0] for x in own])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "shared": pa.array(s, pa.int32())})

    inside = found.filter("border IS NULL").select("a", "b", "shared")
    edges = found.filter("border IS NOT NULL").select("border", "shared", "tree", "label", "row", "n_shingles")
    # One number for each range; a thin range lets the one before it look further.
    sizes = sorted((r["border"], r["n_shingles"]) for r in edges.filter(F.col("shared") == COUNT).select("border", "n_shingles").collect())
    # As Arrow: rows of Python objects would go through Python workers of another kind, which stay beside the others.
    ways = np.array(_reach(sizes), np.int32).reshape(-1, 2)
    reach = spark.createDataFrame(pa.table({"border": ways[:, 0], "owner": ways[:, 1]}), "border int, owner int")
    tails = edges.filter(F.col("shared") == TAIL).withColumn("owner", F.col("border"))
    heads = edges.filter(F.col("shared") == HEAD).join(F.broadcast(reach), "border")
    across = tails.unionByName(heads).drop("border").groupBy("owner").applyInArrow(over_border, "a bigint, b bigint, shared int")
    return inside.unionByName(across).groupBy("a", "b").agg(F.sum("shared").cast("int").alias("shared")).filter("a < b")


def shingle_sets(docs: DataFrame, ends: DataFrame, classes: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(row, shingles) of the class rows in `ends`, computed from their texts once."""
    wanted = staged(ends.join(classes.select("row", "id", "key"), "row"), "near-ends")

    def sets(batches):
        for batch in batches:
            for lo, hi in by_bytes(text_sizes(batch.column(0)), BATCH):
                own = _sets(batch.column(0).slice(lo, hi - lo).to_pylist(), size)
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in own], pa.binary()), pa.array([s.tobytes() for s in own], pa.binary())], ["key", "shingles"])

    ids = wanted.select("id").distinct()
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), plain_text(text_col).alias("text"))
    chosen = texts.join(ids, texts["id"].eqNullSafe(ids["id"]), "left_semi").select("text")
    # Ids may repeat with other texts: the key says which set is meant; equal keys have equal sets.
    full = chosen.mapInArrow(sets, "key binary, shingles binary").join(wanted.select("row", "key"), "key").dropDuplicates(["row"]).select("row", "shingles")
    return staged(full, "near-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) of class rows, those with 100 * intersection >= percent * union on full sets."""
    both = pairs.select("a", "b").join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")

    def test(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return staged(both.select("a", "b", "left", "right").mapInArrow(test, "a bigint, b bigint"), "near-links")


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): each linked node with the smallest node it reaches, as (node, root).

    Rounds of large-star and small-star steps; each round's edges are written to the shared folder.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    # Done when every edge leads to a node that leads nowhere: stars.
    while not edges.select("b").join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty() or not edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n")), "stars")
        large = join_facts(both, least, "u", "n").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "large-star")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "stars")
        small = join_facts(large, least, "u", "n").filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        edges = staged(small.union(least.select("u", "m")).distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) after more links: the links join whole components, so only their roots are gone through."""
    left, right = roots.toDF("a", "root_a"), roots.toDF("b", "root_b")
    ends = links.join(left, "a", "left").join(right, "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    more = staged(components(ends), "near-joined")
    moved = roots.join(more.toDF("root", "next"), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return staged(moved.unionByName(more), "near-roots")


def _crossing(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are not yet in one component."""
    left = roots.toDF("a", "root_a")
    right = roots.toDF("b", "root_b")
    placed = pairs.join(left, "a", "left").join(right, "b", "left")
    return placed.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select(pairs.columns)


def _in_waves(pairs: DataFrame) -> DataFrame:
    """Candidates (a, b) with the wave they are tried in: by their rank among the candidates of the end that ranks them
    higher, most shared values first. A class has at most 2 * NEIGHBOURS candidates in each of the trees."""
    ways = pairs.select("a", "b", "shared", F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("way"))
    own = Window.partitionBy("way.u").orderBy(F.desc("shared"), F.col("way.v"))
    wave = F.size(F.filter(F.array(*map(F.lit, WAVES)), lambda most: most < F.col("rank")))
    return ways.withColumn("rank", F.row_number().over(own)).groupBy("a", "b").agg(F.min(wave).alias("wave"))


def _least_agreement(percent: int) -> float:
    """Share of equal signature values five standard errors below the limit: what links does not fall below it."""
    limit = percent / 100
    return limit - 5 * (limit * (1 - limit) / SIGNATURE) ** 0.5


def sketched(classes: DataFrame) -> DataFrame:
    """(row, n_shingles, sketch) of classes: the low byte of each signature value. Sketches agree where signatures do."""

    def run(batches):
        for batch in batches:
            low = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, SIGNATURE, 4)[:, :, 3]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([x.tobytes() for x in low], pa.binary())], ["row", "n_shingles", "sketch"])

    return classes.select("row", "n_shingles", "signature").mapInArrow(run, "row bigint, n_shingles bigint, sketch binary")


def _likely(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs whose whole sketches agree well enough."""
    least = _least_agreement(percent)
    own = sketches.select("row", "sketch")
    both = pairs.select("a", "b").join(own.toDF("a", "left"), "a").join(own.toDF("b", "right"), "b").select("a", "b", "left", "right")

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SIGNATURE) for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((x == y).mean(1) >= least, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


PLACE = ["region", "i", "j"]


def _sized(rows: DataFrame) -> DataFrame:
    """Staged rows (region, row, root, top) with the numbers of blocks that their region's `members` and `others` fill;
    only of regions that have rows outside their largest component `top`."""
    outside = F.count_if(F.col("root") != F.col("top"))
    sizes = rows.groupBy("region").agg(F.count("*").alias("n"), F.ceil(F.count("*") / CROWD).cast("int").alias("members"), F.ceil(outside / CROWD).cast("int").alias("others"))
    sized = join_facts(rows, staged(sizes, "near-blocks"), "region", "n").filter("others > 0")
    return staged(sized.select("region", "row", "root", "top", "members", "others"), "near-crowded")


def _blocked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sized rows dealt into blocks (i, j) of their region: all of them as members, and those outside its largest component
    as outsiders. Each pair of the two meets in one block."""

    def own_block(c: str) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(c)), F.col(c)).cast("int")

    def every(c: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(c) - 1))

    left = rows.withColumn("i", own_block("members")).withColumn("j", every("others"))
    right = rows.filter("root != top").withColumn("j", own_block("others")).withColumn("i", every("members"))
    columns = [c for c in left.columns if c not in ("members", "others", "top")]
    return left.select(columns), right.select(columns).toDF(*columns)


def crowded_links(classes: DataFrame, sketches: DataFrame, roots: DataFrame, sets: DataFrame, missing_sets, percent: int) -> DataFrame:
    """Links between components that no order shows as near neighbours: in regions (classes that share the first `shallowest` values in a
    tree) of more classes than an order compares, if they still fall into several components.

    There each class outside the region's largest component is compared with every class of another component, in blocks
    of about CROWD by CROWD: first by sketches, one byte of each signature value, which tell the rows that have a likely
    partner; only those meet again, by signature and on full sets. A block gives at most one link for two components that it
    joins, so what it gives does not grow with its pairs. A pair is compared in the first tree in which it shares a region.
    `missing_sets` makes the sets of rows that `sets` does not hold.
    """
    least, depth = _least_agreement(percent), shallowest(percent)
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    prefix = F.expr(f"substring(signature, 1 + {4 * DEPTH} * tree, {4 * depth})")
    rows = classes.select("row", "signature", tree.alias("tree")).select("row", F.struct("tree", prefix.alias("prefix")).alias("region"))
    sizes = rows.groupBy("region").agg(F.count("*").alias("n")).filter(F.col("n") > NEIGHBOURS + 1)
    sizes = staged(sizes, "near-regions")
    rows = join_facts(rows, sizes, "region", "n").select("row", "region", "n")
    rooted = staged(rows.join(roots.toDF("row", "root"), "row", "left").withColumn("root", F.coalesce("root", "row")), "near-crowds")
    parts = rooted.groupBy("region", "n", "root").agg(F.count("*").alias("m"))
    mixed = parts.groupBy("region", "n").agg(F.max(F.struct("m", "root")).alias("top")).filter("top.m < n")
    mixed = staged(mixed.select("region", "n", F.col("top.root").alias("top")), "near-mixed")
    rows = _sized(join_facts(rooted.drop("n"), mixed, "region", "n").drop("n"))

    # First by sketches: which rows have a likely partner at all.
    def promising(key, members: pa.Table, others: pa.Table) -> pa.Table:
        x, y = (
            (t.column("row").to_numpy(), t.column("root").to_numpy(), t.column("n_shingles").to_numpy(), np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(-1, SIGNATURE))
            for t in (members, others)
        )
        hit, hits = np.zeros(len(x[0]), bool), np.zeros(len(y[0]), bool)
        for k, (root, n, own) in enumerate(zip(*y[1:], strict=True)):
            fine = np.flatnonzero((x[1] != root) & (100 * np.minimum(x[2], n) >= percent * np.maximum(x[2], n)))
            likely = (x[3][fine] == own).mean(1) >= least
            hit[fine[likely]] = True
            hits[k] = likely.any()
        found = np.concatenate([x[0][hit], y[0][hits]])
        region = key[0].as_py() if len(found) else None
        return pa.table({"tree": pa.array([region and region["tree"]] * len(found), pa.int32()), "prefix": pa.array([region and region["prefix"]] * len(found), pa.binary()), "row": pa.array(found, pa.int64())})

    left, right = _blocked(rows.join(sketches, "row"))
    likely = left.groupBy(*PLACE).cogroup(right.groupBy(*PLACE)).applyInArrow(promising, "tree int, prefix binary, row bigint")
    likely = staged(likely.distinct(), "near-promising").select(F.struct("tree", "prefix").alias("region"), "row")
    rows = _sized(rows.select("region", "row", "root", "top").join(likely, ["region", "row"], "left_semi"))

    # Then those rows by signatures and full sets.
    missing = staged(rows.select("row").distinct().join(sets, "row", "left_anti"), "near-missing")
    if not missing.isEmpty():
        sets = sets.unionByName(missing_sets(missing))
    left, right = _blocked(rows.join(classes.select("row", "n_shingles", "signature"), "row").join(sets, "row"))

    def compare(key, members: pa.Table, others: pa.Table) -> pa.Table:
        x, y = (
            (t.column("row").to_numpy(), t.column("root").to_numpy(), t.column("n_shingles").to_numpy(), np.frombuffer(b"".join(t.column("signature").to_pylist()), ">u4").astype(np.uint32).reshape(-1, SIGNATURE), t.column("shingles").to_pylist())
            for t in (members, others)
        )
        now = key[0].as_py()["tree"] if others.num_rows else 0
        above: dict[int, int] = {}

        def find(node):
            while node in above:
                node = above[node]
            return node

        a, b = [], []
        for row, root, n, signature, shingles in zip(*y, strict=True):
            fine = np.flatnonzero((x[1] != root) & (100 * np.minimum(x[2], n) >= percent * np.maximum(x[2], n)))
            same = x[3][fine] == signature
            first = same.reshape(-1, TREES, DEPTH)[:, :, :depth].all(2).argmax(1)
            likely = (same.mean(1) >= least) & (first == now)
            own = np.frombuffer(shingles, np.uint64)
            for i in fine[likely].tolist():
                left, right = find(int(x[1][i])), find(int(root))
                if left == right:
                    continue
                other = np.frombuffer(x[4][i], np.uint64)
                shared = int((other[np.minimum(np.searchsorted(other, own), len(other) - 1)] == own).sum())
                if 100 * shared >= percent * (len(own) + len(other) - shared):
                    above[max(left, right)] = min(left, right)
                    a.append(min(int(x[0][i]), int(row)))
                    b.append(max(int(x[0][i]), int(row)))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return left.groupBy(*PLACE).cogroup(right.groupBy(*PLACE)).applyInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id, n_shingles, component_id (smallest id it reaches by links, itself included), kept.

    Words are runs without white space, A-Z lower-cased; a set holds the distinct runs of `size` words, of a shorter text
    the whole. Sets link when 100 * intersection >= percent * union. Null and empty texts and such without words have an
    empty set and link with nothing. Rows with null ids take part; a component whose ids are all null has a null
    component_id. `kept` marks the row with the smallest id of a component, and exactly one of rows that repeat it.
    Other columns are not read. Empty tables give empty ones.
    """
    prints = staged(fingerprints(docs, size, id_col, text_col), "near-prints")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    full = prints.filter("n_shingles > 0")
    groups = staged(full.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("n")), "near-classes")
    classes = staged(groups.select(F.col("first.row").alias("row")).join(full, "row").select("row", "id", "key", "n_shingles", "signature"), "near-reps")
    pairs = staged(candidates(classes, percent), "near-pairs")

    # Each class tries its best candidate first, then the next few, then more: what one wave joins, later ones need not try.
    ranked = staged(_in_waves(pairs), "near-ranked")
    sketches = staged(sketched(classes), "near-sketches")
    tree = ranked.filter("wave = 0").select("a", "b")
    ends = tree.select(F.col("a").alias("row")).union(tree.select("b")).distinct()
    sets = shingle_sets(docs, ends, classes, size, id_col, text_col)
    roots = staged(components(confirmed(tree, sets, percent)), "near-roots")
    for wave in range(1, len(WAVES) + 1):
        rest = staged(_likely(_crossing(ranked.filter(F.col("wave") == wave).select("a", "b"), roots), sketches, percent), "near-rest")
        links = None if rest.isEmpty() else confirmed(rest, sets, percent)
        roots = roots if links is None or links.isEmpty() else _joined(roots, links)
    # Then what regions too crowded for their orders hold.
    fetch = lambda rows: shingle_sets(docs, rows, classes, size, id_col, text_col)
    links = staged(crowded_links(classes, sketches, roots, sets, fetch, percent), "near-links")
    roots = roots if links.isEmpty() else _joined(roots, links)

    # A component is named by the smallest place among its classes.
    firsts = groups.select(F.col("first.row").alias("node"), "key", "first", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = staged(firsts, "near-firsts")
    names = staged(firsts.groupBy("root").agg(F.min("first").alias("name"), F.count("*").alias("classes")), "near-names")
    facts = staged(join_facts(firsts, names, "root", "classes").select("key", "name", "n"), "near-facts")
    named = join_facts(full.select("row", "id", "n_shingles", "key"), facts, "key", "n")
    out = ["id", "n_shingles", F.col("name.id").alias("component_id"), (F.col("row") == F.col("name.row")).alias("kept"), "key"]
    empty = prints.filter("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id"), F.lit(True).alias("kept"), "key")
    return named.select(out).unionByName(empty).withColumnRenamed("id", id_col)


def deduplicated(docs: DataFrame, percent: int = 80, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns."""

    def with_key(rows: DataFrame) -> DataFrame:
        at = rows.columns.index(text_col)

        def run(batches):
            for batch in batches:
                keys = [set_key(s) for t in batch.column(at).to_pylist() for s in _sets([t or ""], size)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, ROW_KEY])

        return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(ROW_KEY, T.BinaryType())]))

    found = near_duplicates(docs, percent, size, id_col, text_col)
    marks = staged(found.select(F.col(id_col).alias("_id"), F.col("key").alias("_key"), F.col("kept").alias("_kept")), "near-marks")
    return keep_marked(docs, marks, id_col, with_key)
