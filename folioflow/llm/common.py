"""What the operators of this package share: tables staged in the shared folder, hot keys, numbering."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.session import shuffle_partitions, work_dir

# A key counts as hot above this share of all rows, so at most HOT_PARTS keys are hot.
HOT_PARTS = 1000

# Column that `keep_marked` adds and takes away again.
ROW_KEY = "__row_key"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to a fresh folder under `spark.checkpoint.dir` and read again: later steps,
    and tasks that run again after a lost executor, see these very rows."""
    path = work_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, purpose: str) -> DataFrame:
    """Like `staged`, in one bucket of `key` for each shuffle partition: what joins or cogroups with it by `key` comes to it,
    and its own rows are not shuffled. The catalog forgets the table at once; the files stay."""
    spark, name = df.sparkSession, f"{purpose}_{uuid.uuid4().hex}".replace("-", "_")
    writer = df.write.option("compression", "none").option("path", work_dir(spark, purpose))
    writer.bucketBy(shuffle_partitions(spark), key).format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def plain_text(column: str = "text") -> Column:
    """A text column as string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def join_facts(rows: DataFrame, facts: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of many `rows` with one fact per `key`, where a key may hold a large share of the rows.

    `weight` is the number of rows of a key. Keys above a 1/1000 of the total number at most 1000, so their facts
    are broadcast and their rows stay where they are; all other keys meet in an ordinary join. `facts` must be a staged table.
    """
    total = facts.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * HOT_PARTS > total
    heavy = F.broadcast(facts.filter(hot))
    light = facts.filter(~hot)
    return rows.join(heavy, key).unionByName(rows.join(heavy.select(key), key, "left_anti").join(light, key))


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Number the rows of each key 0, 1, 2 … without bringing a key's rows into one task.

    Rows of a key are dealt by a hash of `order` to as many parts as the session has shuffle partitions, numbered
    within the part, and shifted by the sizes of the parts before. `order` must identify a row. `rows` must be staged.
    """
    parts = shuffle_partitions(rows.sparkSession)
    split = rows.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    local = split.withColumn("_local", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)))
    sizes = split.groupBy(*keys, "_part").agg(F.count("*").alias("_size"))
    # One row per part of a key.
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    placed = local.join(starts, [*keys, "_part"])
    return placed.withColumn(name, (F.col("_start") + F.col("_local") - 1).cast("bigint")).drop("_part", "_local", "_start")


def keep_marked(docs: DataFrame, marks: DataFrame, id_col: str, key_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of `docs` that `marks` (staged: _id, _key, _kept; one row for each row of `docs`) keeps, all columns as they are.

    Ids with only dropped rows leave by an anti-join on the id. Only where an id repeats, with kept and dropped rows, does
    `key_of` (adds ROW_KEY) tell the rows apart; one row of each kept key stays.
    """
    by_id = marks.groupBy("_id").agg(F.min("_kept").alias("all"), F.max("_kept").alias("any"))
    gone = staged(by_id.filter(~F.col("all")), "dropped-ids")
    own = docs[id_col].cast("bigint")
    plain = docs.join(gone, own.eqNullSafe(gone["_id"]), "left_anti")
    mixed = gone.filter("any")
    if mixed.isEmpty():
        return plain
    again = key_of(docs.join(mixed, own.eqNullSafe(mixed["_id"]), "left_semi"))
    kept = marks.filter("_kept").select("_id", F.col("_key").alias("_kept_key")).distinct()
    match = again[id_col].cast("bigint").eqNullSafe(kept["_id"]) & (again[ROW_KEY] == kept["_kept_key"])
    return plain.unionByName(again.join(kept, match, "left_semi").dropDuplicates([id_col, ROW_KEY]).select(*docs.columns))
