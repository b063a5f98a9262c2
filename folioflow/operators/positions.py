"""Positions and neighbours in a sorted order, without a single-task window.

Rows are range-partitioned by the sort columns and written to the checkpoint folder once, so
that every later step sees the same ranges. Inside a range, a window numbers the rows; across
ranges, only one summary row per range (and group) is combined. A group that holds most of
the rows is cut into many ranges like any other stretch of the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.session import cut, range_partitions, shuffle_partitions


def _ranged(df: DataFrame, order: list[str], group: list[str]) -> DataFrame:
    ranges = df.repartitionByRange(range_partitions(df), *order)
    return cut(ranges.withColumn("_key", F.struct(F.spark_partition_id().alias("_range"), *group)))


def with_position(df: DataFrame, order: list[str], group: list[str] | None = None, name: str = "pos", total: str | None = None) -> DataFrame:
    """Number rows 0, 1, 2 … by `order` inside each `group`; `total` names a group size column.

    `group` and `order` columns together must identify a row.
    """
    group = group or []
    # Range and group as one column: the window and the join below then share one shuffle.
    rows = _ranged(df, group + order, group)
    numbered = rows.withColumn("_local", F.row_number().over(Window.partitionBy("_key").orderBy(*order)))
    # One row per range and group: at most as many rows for a group as there are ranges.
    sizes = rows.groupBy("_key").agg(F.count("*").alias("_n"))
    across = Window.partitionBy(*[F.col("_key")[c] for c in group]) if group else Window.partitionBy(F.lit(0))
    before = across.orderBy(F.col("_key")["_range"]).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    if total:
        starts = starts.withColumn(total, F.sum("_n").over(across))
    placed = numbered.join(starts.drop("_n"), "_key")
    position = (F.col("_start") + F.col("_local") - 1).cast("bigint").alias(name)
    return placed.select(*df.columns, position, *([total] if total else []))


def with_neighbours(df: DataFrame, order: str, previous: str, following: str, wrap: bool) -> DataFrame:
    """Add the value before and after each row's `order` value (which must be unique).

    The value after the last is empty. The value before the first is the last one if `wrap`,
    else empty.
    """
    rows = _ranged(df, [order], [])
    inside = Window.partitionBy("_key").orderBy(order)
    linked = rows.select(
        "*", F.lag(order).over(inside).alias("_before"), F.lead(order).over(inside).alias("_after")
    )
    # One row per range.
    ends = rows.groupBy("_key").agg(F.min(order).alias("_low"), F.max(order).alias("_high"))
    across = Window.partitionBy(F.lit(0)).orderBy("_key")
    edges = ends.select(
        "_key",
        F.lag("_high").over(across).alias("_edge_before"),
        F.lead("_low").over(across).alias("_edge_after"),
        F.max("_high").over(Window.partitionBy(F.lit(0))).alias("_final"),
    )
    first = F.col("_final") if wrap else F.lit("")
    return linked.join(edges, "_key").select(
        *df.columns,
        F.coalesce("_before", "_edge_before", first).alias(previous),
        F.coalesce("_after", "_edge_after", F.lit("")).alias(following),
    )


# Up to this many rows per group Spark prunes each partition before the shuffle (WindowGroupLimit).
PRUNED_RANK = 999


def top_per_group(df: DataFrame, group: list[str], order: list, k: int, rank: str = "rank") -> DataFrame:
    """First `k` rows of each group in `order`, with their rank from 1.

    A hot group is cut down before it meets in one task: by Spark's own rank pruning for small
    `k`, and by a first pass over salted sub-groups for a large one.
    """
    if k > PRUNED_RANK:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(shuffle_partitions(df.sparkSession)))
        parts = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = df.withColumn("_salt", salt).withColumn(rank, F.row_number().over(parts)).filter(F.col(rank) <= k).drop("_salt", rank)
    whole = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= k)
