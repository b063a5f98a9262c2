"""A Merkle manifest of a collection whose witnesses grow with it.

Rows are leaves of one tree per `tree` value, in the order of their ids; the trees' roots, in the order of the values,
are the leaves of one more tree. A tree is appended to from left to right in aligned blocks. Inside a block every leaf
meets the open subtrees before it; when two subtrees of one size close into one, the witness of each leaf below gets
the root of the other half. A closed block is one leaf for the level above, which grows in the same way, so a level has
one row for each `BLOCK` rows of the level below, and a task holds one block. What later batches append reaches the
witnesses of earlier rows through their block: only a tree's last, open block is taken up again.

A witness is a `path`, one letter a level from the leaf up (L: the sibling is left, R: right, -: none, the node is
hashed alone), and the digests of the siblings in the same order, 32 bytes each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import bucketed, staged
from folioflow.session import range_partitions

# Leaves of one task's subtree; a power of two.
BLOCK = 4096

# A table of ranges and trees up to this many rows (some 50 bytes each) is broadcast, a longer one is joined.
BROADCAST_ROWS = 100_000

WITNESS = "path string, siblings binary"


def digest_of(fields: list[Column]) -> Column:
    """SHA-256, as hex, of the fields one after another: `-` for null, else UTF-8 length, colon, value."""
    values = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v), F.lit(":"), v), F.lit("-")) for v in values]), 256)


def join_digests(digests: str) -> str:
    return hashlib.sha256(digests.encode()).hexdigest()


class Growth:
    """One tree under streaming append: the open subtrees, from large to small, and the witnesses of all leaves so far."""

    def __init__(self, capacity: int):
        levels = max(1, capacity - 1).bit_length() if capacity > 1 else 0
        self.sides = np.full((capacity, levels), b"-", "S1")
        self.siblings = np.zeros((capacity, levels), "S64")
        self.count = 0
        self.open: list[tuple[int, int, int, str]] = []  # level, first leaf, end, root

    def append(self, root: str) -> None:
        self._settle((0, self.count, self.count + 1, root))
        self.count += 1

    def _settle(self, node: tuple[int, int, int, str]) -> None:
        while self.open and self.open[-1][0] == node[0]:
            level, first, middle, left = self.open.pop()
            _, _, end, right = node
            self.siblings[first:middle, level], self.sides[first:middle, level] = right, b"R"
            self.siblings[middle:end, level], self.sides[middle:end, level] = left, b"L"
            node = (level + 1, first, end, join_digests(left + right))
        self.open.append(node)

    def close(self, height: int = 0) -> str:
        """Hash what is alone on its level upwards until one root of at least `height` is left."""
        while len(self.open) > 1 or self.open[-1][0] < height:
            level, first, end, root = self.open.pop()
            self._settle((level + 1, first, end, join_digests(root)))
        return self.open[0][3]

    def witness(self, leaf: int, height: int) -> tuple[str, bytes]:
        path = self.sides[leaf, :height].tobytes().decode()
        return path, bytes.fromhex(self.siblings[leaf, :height].tobytes().replace(b"\0", b"").decode())


def fold(leaf: str, path: str, siblings: bytes) -> str:
    """The root that a leaf and its witness lead to."""
    at, node = 0, leaf
    for side in path:
        if side == "-":
            node = join_digests(node)
            continue
        other = siblings[at : at + 32].hex()
        at += 32
        node = join_digests(other + node if side == "L" else node + other)
    return node


def _node(key: str, place: str, block: int) -> Column:
    return F.concat(F.floor(F.col(place) / block).cast("string"), F.lit(":"), F.col(key))


def _grown(rows: DataFrame, block: int) -> DataFrame:
    """Rows (key, place, total, hash, …) with the witness of each inside its block, and the block's root."""
    schema = rows.schema
    height_of_block = block.bit_length() - 1
    added = pa.schema([("node", pa.string()), ("path", pa.string()), ("siblings", pa.binary()), ("block_root", pa.string())])

    def grow(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        tree = Growth(group.num_rows)
        for digest in group.column("hash").to_pylist():
            tree.append(digest)
        total = group.column("total")[0].as_py()
        height = height_of_block if total > block else max(0, total - 1).bit_length()
        if tree.sides.shape[1] < height:
            # A short last block is hashed up alone to the height of its fellows.
            more = height - tree.sides.shape[1]
            tree.sides = np.pad(tree.sides, ((0, 0), (0, more)), constant_values=b"-")
            tree.siblings = np.pad(tree.siblings, ((0, 0), (0, more)), constant_values=b"")
        root = tree.close(height)
        found = [tree.witness(i, height) for i in range(group.num_rows)]
        new = [group.column("node"), pa.array([p for p, _ in found], pa.string()), pa.array([s for _, s in found], pa.binary()), pa.array([root] * group.num_rows, pa.string())]
        kept = [group.column(name) for name in schema.fieldNames()]
        return pa.Table.from_arrays(kept + new, names=[*schema.fieldNames(), *added.names])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keyed = rows.withColumn("node", _node("key", "place", block))
    return keyed.groupBy("node").applyInArrow(grow, f"{out}, node string, {WITNESS}, block_root string")


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Staged `rows` (key, …) with `place`, the number from 0 in the order of `order` within `key`, and `total`.

    A key may hold most rows: the order is cut into ranges, and only one row per range and key is summed across them.
    """
    n = range_partitions(rows)
    by = [F.col(c).asc_nulls_first() for c in ["key", *order]]
    ranged = staged(rows.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    ranged = ranged.withColumn("_range", F.shiftrightunsigned("_at", 33))
    sizes = ranged.groupBy("key", "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    across = Window.partitionBy("key")
    before = across.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("key", "_range", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(across).alias("total"))
    starts = staged(starts, "merkle-ranges")
    if starts.count() <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    joined = ranged.join(starts, ["key", "_range"])
    return joined.withColumn("place", F.col("_start") + F.col("_at") - F.col("_first")).drop("_range", "_at", "_first", "_start")


def _ascended(nodes: DataFrame, block: int) -> DataFrame:
    """Nodes (key, place, total, hash) with their witness up to the root of their tree (`path`, `siblings`), and that root (`top`)."""
    part = staged(_grown(nodes.select("key", "place", "total", "hash"), block), "merkle-level")
    if part.filter(F.col("total") > block).isEmpty():
        return part.select("key", "place", "path", "siblings", F.col("block_root").alias("top"))
    upper = _ascended(_roots(part, block), block).select(
        _key_of_block("key", "place"), F.col("path").alias("_path"), F.col("siblings").alias("_siblings"), "top"
    )
    both = part.join(upper, "node")
    return both.select("key", "place", F.concat("path", "_path").alias("path"), F.concat("siblings", "_siblings").alias("siblings"), "top")


def _key_of_block(key: str, place: str) -> Column:
    return F.concat(F.col(place).cast("string"), F.lit(":"), F.col(key)).alias("node")


def _roots(part: DataFrame, block: int) -> DataFrame:
    first = part.filter(F.col("place") % block == 0)
    return first.select("key", F.floor(F.col("place") / block).alias("place"), F.ceil(F.col("total") / block).alias("total"), F.col("block_root").alias("hash"))


class Manifest:
    """The trees over all batches appended so far. Its tables lie under `spark.checkpoint.dir`.

    `block` (a power of two) is the number of leaves that one task holds.
    """

    def __init__(self, block: int = BLOCK):
        if block < 2 or block & (block - 1):
            raise ValueError("block must be a power of two")
        self.block = block
        self.parts: list[DataFrame] = []

    def append(self, leaves: DataFrame, tree: str, order: str, leaf: str) -> None:
        """Append rows: `tree` names the column of the tree, `order` that of the ids, `leaf` that of the hex digest.

        Other columns are carried along. Null trees form a tree of their own, before all others; null ids come first,
        equal ids in the order of their digests, and repeated rows each are a leaf. Ids of a later batch must not lie
        below those of the same tree in an earlier one; otherwise nothing is appended and ValueError is raised.
        An empty batch changes nothing.
        """
        carried = F.struct(*[F.col(c) for c in leaves.columns]).alias("row")
        key = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("-")).alias("key")
        rows = staged(leaves.select(key, F.col(order).alias("_order"), F.col(leaf).alias("hash"), carried, F.monotonically_increasing_id().alias("_tie")), "merkle-leaves")
        placed = _placed(rows, ["_order", "hash", "_tie"]).drop("_tie")
        if self.parts:
            open_ = self.parts[-1].filter("NOT full").select("key", "place", "hash", "_order", "row")
            before = self._live().groupBy("key").agg(F.max("_order").alias("_last"), F.count("*").alias("_before"))
            before = staged(before, "merkle-counts")
            late = rows.groupBy("key").agg(F.min("_order").alias("_low"), F.count("_order").alias("_ids"), F.count("*").alias("_rows")).join(before, "key")
            if not late.filter("_low < _last OR (_ids < _rows AND _last IS NOT NULL)").isEmpty():
                raise ValueError("a batch must not hold ids below those of an earlier one")
            new = placed.join(before.drop("_last"), "key", "left").withColumn("_before", F.coalesce("_before", F.lit(0)))
            new = new.select("key", (F.col("place") + F.col("_before")).alias("place"), "hash", "_order", "row")
            totals = placed.groupBy("key").agg(F.count("*").alias("_n")).join(before.drop("_last"), "key", "full")
            totals = totals.select("key", (F.coalesce("_n", F.lit(0)) + F.coalesce("_before", F.lit(0))).alias("total"))
            placed = new.unionByName(open_).join(totals, "key")
        full = (F.floor(F.col("place") / self.block) + 1) * self.block <= F.col("total")
        placed = placed.select("key", "place", "total", "hash", "_order", "row", full.alias("full"))
        self.parts.append(bucketed(_grown(placed, self.block), "node", "merkle-blocks"))

    def _layers(self) -> list[DataFrame]:
        return [p.filter("full") for p in self.parts[:-1]] + self.parts[-1:]

    def _live(self) -> DataFrame:
        first, *others = [p.select("key", "place", "total", "hash", "_order", "row", "node", "block_root", "full") for p in self._layers()]
        for other in others:
            first = first.unionByName(other)
        return first

    def witnesses(self) -> DataFrame:
        """Per leaf: its columns as `row`, `leaf`, `path` and `siblings` up to the root, `subroot` of its tree, `root`."""
        live = self._live()
        first = staged(live.filter(F.col("place") % self.block == 0).select("key", "place", "block_root"), "merkle-roots")
        blocks = first.withColumn("place", F.floor(F.col("place") / self.block))
        blocks = blocks.join(blocks.groupBy("key").agg(F.count("*").alias("total")), "key").withColumnRenamed("block_root", "hash")
        upper = staged(_ascended(blocks, self.block), "merkle-upper")
        trees = upper.filter("place = 0").select(F.lit("").alias("key"), F.col("key").alias("tree"), F.col("top").alias("hash"))
        trees = staged(_placed(staged(trees, "merkle-trees"), ["tree"]), "merkle-trees")
        over = _ascended(trees, self.block).join(trees.select("place", "tree"), "place")
        over = over.select(F.col("tree").alias("key"), F.col("path").alias("_path"), F.col("siblings").alias("_siblings"), F.col("top").alias("root"))
        facts = upper.join(over, "key").select(
            _key_of_block("key", "place"), F.concat("path", "_path").alias("_path"), F.concat("siblings", "_siblings").alias("_siblings"), F.col("top").alias("subroot"), "root"
        )
        facts = staged(facts, "merkle-facts")
        out = None
        for layer in self._layers():
            # The blocks lie in buckets of `node`: only the facts, one row for a block, move.
            joined = layer.join(facts, "node").select(
                "row", F.col("hash").alias("leaf"), F.concat("path", "_path").alias("path"), F.concat("siblings", "_siblings").alias("siblings"), "subroot", "root"
            )
            out = joined if out is None else out.unionByName(joined)
        return out


def folded(witnesses: DataFrame, leaf: Column) -> DataFrame:
    """`witnesses` with `proof_sha256` (of the siblings as hex text, leaf to root) and `folded_root` (from `leaf`)."""
    rows = witnesses.withColumn("_leaf", leaf)
    names = rows.columns

    def check(batches):
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            path, siblings, leaves = (columns[n].to_pylist() for n in ("path", "siblings", "_leaf"))
            proof = [join_digests(s.hex()) for s in siblings]
            roots = [fold(x, p, s) for x, p, s in zip(leaves, path, siblings)]
            kept = [columns[n] for n in names if n != "_leaf"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(proof, pa.string()), pa.array(roots, pa.string())], names=[*[n for n in names if n != "_leaf"], "proof_sha256", "folded_root"])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in witnesses.schema)
    return rows.mapInArrow(check, f"{out}, proof_sha256 string, folded_root string")


def verified_manifest(docs: DataFrame, fields: list[str], tree: str, order: str, tampered: Column, changed: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """Per row of `docs`: its id (column `order`), leaf, subroot, root, proof_sha256, folded_root, verified.

    Where `tampered` is true, the root is folded from the row with the columns of `changed` put in; `verified` says
    whether that leads to the root. Null ids and trees, equal ids and repeated rows are placed as `Manifest.append`
    says. An empty table gives an empty one. Columns other than `fields`, `tree` and `order` are not read.
    """
    leaf = digest_of([F.col(f) for f in fields])
    forged = F.when(tampered, digest_of([changed.get(f, F.col(f)) for f in fields]))
    plain = docs.select(F.col(order).alias("id"), F.col(tree).alias("tree"), leaf.alias("leaf"), forged.alias("forged"))
    manifest = Manifest(block)
    manifest.append(plain, "tree", "id", "leaf")
    rows = folded(manifest.witnesses(), F.coalesce(F.col("row.forged"), F.col("leaf")))
    return rows.select(F.col("row.id").alias(order), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
