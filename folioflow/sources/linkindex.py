"""A stored index of who links to whom, kept up to date by differences.

Two keyed tables lie side by side: `pages` (source, modified, targets) has the distinct link targets of each page as it was
last read, and `edges` (target, source) has one row per link. A refresh compares the links of the changed pages with what
`pages` says of them, and writes only the edges that came or went. Edges are dealt by target and, within it, by a hash of
the source into `SOURCE_PARTS` folders: a change rewrites one of them, and a page that a third of all links lead to lies
in as many. Readers who ask for some targets read those targets' folders.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators.diff import DELETED, NEW, UPDATED, classify, to_update
from folioflow.operators.positions import with_position
from folioflow.session import work_dir
from folioflow.sources import sinks

PAGES = "source string, modified timestamp_ntz, targets array<string>"
EDGES = "target string, source string"

# Folders of one target. Fixed for all tables: it decides where an edge lies.
SOURCE_PARTS = 8

# What stands for the time of a page whose revisions are not known.
NEVER = "1900-01-01 00:00:00"


def edge_bucket(keys: list[str], buckets: int) -> Column:
    """Bucket of an edge (target, source): SOURCE_PARTS neighbouring ones belong to a target."""
    return (_first_bucket(keys[0], buckets) + F.pmod(F.hash(keys[1]), F.lit(SOURCE_PARTS))).cast("int")


def _first_bucket(target: str, buckets: int) -> Column:
    return (F.pmod(F.xxhash64(target), F.lit(max(1, buckets // SOURCE_PARTS))) * SOURCE_PARTS).cast("int")


def create(spark: SparkSession, path: str, buckets: int = 64) -> None:
    """A new, empty index with `buckets` folders of edges (a multiple of SOURCE_PARTS)."""
    if buckets % SOURCE_PARTS:
        raise ValueError(f"buckets must be a multiple of {SOURCE_PARTS}")
    for name, schema in (("pages", PAGES), ("edges", EDGES)):
        sinks.create_empty(spark, f"{path}/{name}", buckets)
        assert sinks.read_table(spark, f"{path}/{name}", schema).isEmpty()


def changed(spark: SparkSession, path: str, current: DataFrame) -> DataFrame:
    """Changes of `current` (source, lastmod; null for unknown) against the pages of the index, one row for every key."""
    stored = sinks.read_table(spark, f"{path}/pages", PAGES).select("source", "modified")
    known = current.select("source", F.coalesce("lastmod", F.lit(NEVER).cast("timestamp_ntz")).alias("lastmod"))
    return classify(known, stored, "source")


@dataclass(frozen=True)
class Moves:
    """Edges that came and went (target, source, op), and what the index is to say of the pages they belong to."""

    edges: DataFrame
    pages: DataFrame


def move(spark: SparkSession, path: str, changes: DataFrame, links: DataFrame) -> Moves:
    """Bring the edges up to date: `changes` as `changed` gives them, `links` (source, target) of at least the new and
    updated pages. Until `settle` has stored what the pages link to now, the same call gives the same moves again.

    Null targets and sources, and repeated links, are passed over.
    """
    touched = changes.filter(F.col("change").isin(NEW, UPDATED, DELETED))
    now = to_update(changes).select("source", F.col("lastmod").alias("modified"))
    targets = links.filter("source IS NOT NULL AND target IS NOT NULL").join(now.select("source"), "source", "left_semi")
    lists = targets.groupBy("source").agg(F.array_sort(F.collect_set("target")).alias("targets"))
    empty = F.array().cast("array<string>")
    fresh = _kept(spark, now.join(lists, "source", "left").withColumn("targets", F.coalesce("targets", empty)), "link-pages")
    old = sinks.read_table(spark, f"{path}/pages", PAGES).join(touched.select("source"), "source", "left_semi")
    # A page's two lists meet in one row, so only what differs becomes rows.
    both = fresh.select("source", F.col("targets").alias("now")).join(old.select("source", F.col("targets").alias("was")), "source", "full_outer")
    came, went = (F.array_except(F.coalesce(a, empty), F.coalesce(b, empty)) for a, b in (("now", "was"), ("was", "now")))
    moves = F.concat(
        F.transform(came, lambda t: F.struct(t.alias("target"), F.lit(sinks.PUT).alias("op"))),
        F.transform(went, lambda t: F.struct(t.alias("target"), F.lit(sinks.REMOVE).alias("op"))),
    )
    edges = _kept(spark, both.select("source", F.explode(moves).alias("move")).select("move.target", "source", "move.op"), "link-moves")
    sinks.apply_changes(spark, f"{path}/edges", edges, ["target", "source"], EDGES, place=edge_bucket)
    gone = changes.filter(F.col("change") == DELETED).select("source")
    return Moves(edges, sinks.change_set(fresh, gone, ["source"]))


def settle(spark: SparkSession, path: str, moves: Moves) -> None:
    """Store what the moved pages link to now."""
    sinks.apply_changes(spark, f"{path}/pages", moves.pages, "source", PAGES)


def refresh(spark: SparkSession, path: str, changes: DataFrame, links: DataFrame) -> DataFrame:
    """`move` and `settle`; returns the edges that came and went."""
    moves = move(spark, path, _kept(spark, changes, "link-changes"), links)
    settle(spark, path, moves)
    return moves.edges


def _kept(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def edges_to(spark: SparkSession, path: str, targets: DataFrame | None = None) -> DataFrame:
    """The edges (target, source) of the given targets (column `target`), or all. Only the targets' folders are read; of
    the targets, at most one number per folder reaches the driver."""
    edges = sinks.read_buckets(spark, f"{path}/edges", EDGES)
    if targets is None:
        return edges.select("target", "source")
    count = sinks.bucket_count(spark, f"{path}/edges")
    wanted = targets.select("target").distinct()
    first = [r[0] for r in wanted.select(_first_bucket("target", count).alias("b")).distinct().collect()]
    numbers = [b + i for b in sorted(first) for i in range(SOURCE_PARTS)]
    return edges.filter(F.col("bucket").isin(numbers)).join(wanted, "target", "left_semi").select("target", "source")


def titles(spark: SparkSession, path: str, targets: DataFrame | None = None) -> DataFrame:
    """Rows (target, pos, source): the pages that link to each target, numbered in order, however many."""
    return with_position(edges_to(spark, path, targets), ["source"], ["target"])
