"""Writing document tables by key.

A stored table is spread over `buckets=<count>/bucket=<number>` folders by a hash of its key. An
upsert or a delete reads and rewrites only the folders that its keys fall into, with Spark's
dynamic partition overwrite: task output is staged and swapped in when the job commits, so a lost
executor costs a task retry and never a half-written table. The number of buckets is chosen when
the table is made and found again in its folder names.

`apply_changes` takes one table of puts and removals and rewrites each touched bucket once. The change set is first
written beside the table, and stays there until the buckets are swapped in: a job that was stopped anywhere after that
is finished by the next call, or by `recover`, and gives the same table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.operators.diff import latest_per_key
from folioflow.session import estimated_bytes

BUCKETS = 32
PLACE = ["buckets", "bucket"]

# What a change set says of a key.
PUT, REMOVE = "put", "remove"

# Folder of change sets inside a table; readers pass over names that begin so.
CHANGES = "_changes"


def upsert(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """`target` with `rows` put in by key; a row replaces the whole old document."""
    return target.join(rows.select(key), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def delete_docs(target: DataFrame, keys: DataFrame, key: str, confirm: bool = False) -> DataFrame:
    """`target` without the given keys; refuses to work unless confirmed."""
    if not confirm:
        raise ValueError("Confirmation required.")
    return target.join(keys.select(key), key, "left_anti")


def verify_published(expected: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys that should have been written and are not there."""
    return expected.select(key).join(target.select(key), key, "left_anti")


def _folder(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def _bucket_count(spark: SparkSession, path: str) -> int:
    files, location = _folder(spark, path)
    for entry in files.listStatus(location):
        name = entry.getPath().getName()
        if name.startswith("buckets="):
            return int(name.partition("=")[2])
    return BUCKETS


def _placed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    number = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    return df.withColumns({"buckets": F.lit(buckets), "bucket": number})


def _write(df: DataFrame, path: str, key: str, files_per_bucket: int) -> None:
    # Every bucket is written by up to `files_per_bucket` tasks, chosen by a second hash of the key.
    part = F.pmod(F.hash(F.col(key)), F.lit(files_per_bucket))
    (
        df.repartition("bucket", part)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PLACE)
        .parquet(path)
    )


def create_table(
    df: DataFrame, path: str, key: str, buckets: int | None = None, files_per_bucket: int = 1
) -> None:
    """Write a new table. Without a count of buckets, one is made for every 512 MB estimated, 32 at least.

    For a table that will grow, choose `buckets` for its later size: a bucket is what one change rewrites. A path that
    holds a table already is refused.
    """
    files, location = _folder(df.sparkSession, path)
    if files.exists(location) and any(e.getPath().getName().startswith("buckets=") for e in files.listStatus(location)):
        raise ValueError(f"there is a table at {path}")
    _write(_placed(df, key, buckets or _buckets_for(df)), path, key, files_per_bucket)


def _buckets_for(df: DataFrame) -> int:
    size = estimated_bytes(df)
    if size > 2**53:  # Catalyst does not know
        return BUCKETS
    return max(BUCKETS, size // (512 * 1024 * 1024))


def bucket_count(spark: SparkSession, path: str) -> int:
    """Number of buckets of the table at `path`."""
    return _bucket_count(spark, path)


def create_empty(spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
    """A new table without rows; the number of its buckets is in its folder's name. A path that holds a table is refused."""
    files, location = _folder(spark, path)
    if files.exists(location) and any(e.getPath().getName().startswith("buckets=") for e in files.listStatus(location)):
        raise ValueError(f"there is a table at {path}")
    files.mkdirs(_folder(spark, f"{path}/buckets={buckets}")[1])


def read_buckets(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table with its columns `buckets` and `bucket`: a filter on them reads only the folders it names."""
    return _stored(spark, path, schema)


def read_keys(spark: SparkSession, path: str, keys: DataFrame, key: str, schema: str | T.StructType) -> DataFrame:
    """The stored rows of the given keys; only the buckets that these fall into are read."""
    numbers = _touched(keys.select(bucket_of([key], _bucket_count(spark, path)).alias("bucket")))
    rows = _stored(spark, path, schema).filter(F.col("bucket").isin(numbers))
    return rows.join(keys.select(key).distinct(), key, "left_semi").drop(*PLACE)


def _stored(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The table with its place columns. Files written at different times may differ in columns,
    so without a schema the columns of all files are put together.
    """
    if schema is None:
        return spark.read.option("mergeSchema", True).parquet(path)
    columns = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = [f for f in columns if f.name not in PLACE] + [T.StructField(c, T.IntegerType()) for c in PLACE]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The table at `path`; with a schema, an empty table can be read and no file footer is looked at."""
    return _stored(spark, path, schema).drop(*PLACE)


def _touched(keys: DataFrame) -> list[int]:
    # At most as many numbers as there are buckets reach the driver.
    return sorted(r[0] for r in keys.select("bucket").distinct().collect())


def save_docs(
    spark: SparkSession, path: str, rows: DataFrame, key: str, schema: str | None = None, files_per_bucket: int = 1,
    newest_by: list[str] | None = None,
) -> None:
    """Put `rows` into the table at `path`, rewriting the touched buckets only.

    `schema` is that of the stored table; without it the table's files are asked. The columns of
    both sides are kept. Of rows that repeat a key the last by `newest_by` is stored; without it
    repeated keys are refused.
    """
    if newest_by:
        rows = latest_per_key(rows, key, newest_by)
    elif not rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        raise ValueError(f"rows repeat a {key}; say by which columns the newest is found")
    rows = _placed(rows, key, _bucket_count(spark, path))
    touched = _touched(rows)
    if touched:
        try:
            old = _stored(spark, path, schema)
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            old = _stored(spark, path, rows.schema)  # a table without files
        old = old.filter(F.col("bucket").isin(touched))
        kept = old.join(rows.select(*PLACE, key), [*PLACE, key], "left_anti")
        _write(kept.unionByName(rows, allowMissingColumns=True), path, key, files_per_bucket)


def remove_docs(
    spark: SparkSession, path: str, keys: DataFrame, key: str, schema: str | None = None,
    confirm: bool = False, files_per_bucket: int = 1,
) -> None:
    """Delete by key from the table at `path`, rewriting the touched buckets only.

    Dynamic overwrite leaves a folder alone when no row is left for it, so such folders are
    deleted outright.
    """
    if not confirm:
        raise ValueError("Confirmation required.")
    count = _bucket_count(spark, path)
    keys = _placed(keys.select(key).distinct(), key, count)
    touched = _touched(keys)
    if not touched:
        return
    kept = _stored(spark, path, schema).filter(F.col("bucket").isin(touched)).join(keys, [*PLACE, key], "left_anti")
    left = set(_touched(kept))
    _write(kept, path, key, files_per_bucket)
    for number in touched:
        if number not in left:
            files, folder = _folder(spark, f"{path}/buckets={count}/bucket={number}")
            files.delete(folder, True)


@dataclass(frozen=True)
class Applied:
    """What a change set did: rows put, keys asked to be removed, buckets rewritten, rows these hold now."""

    put: int
    removed: int
    buckets: int
    rows: int


def bucket_of(keys: list[str], buckets: int) -> Column:
    """Bucket of a row by a hash of its key columns."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def change_set(put: DataFrame | None, remove: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows to put and keys to remove as one table with a column `op`."""
    parts = []
    if put is not None:
        parts.append(put.withColumn("op", F.lit(PUT)))
    if remove is not None:
        parts.append(remove.select(*keys, F.lit(REMOVE).alias("op")))
    if not parts:
        raise ValueError("a change set needs rows to put or keys to remove")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def apply_changes(
    spark: SparkSession, path: str, changes: DataFrame, keys: str | list[str], schema: str | T.StructType | None = None,
    files_per_bucket: int = 1, place=bucket_of,
) -> Applied:
    """Bring the table at `path` up to date with `changes` (column `op`, see `change_set`); each touched bucket is written once.

    `changes` is evaluated once. A key may be put once only; where it is also removed, the removal holds. `place` (key
    columns, number of buckets) gives a row's bucket and must be the same for a table's whole life. The columns of both
    sides are kept. ValueError is raised if not all puts arrived.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    recover(spark, path, keys, schema, files_per_bucket)
    count = _bucket_count(spark, path)
    own = f"{path}/{CHANGES}/{uuid.uuid4().hex}"
    changes.withColumns({"_buckets": F.lit(count), "_bucket": place(keys, count)}).write.parquet(own)
    return _applied(spark, path, own, keys, schema, files_per_bucket)


def recover(spark: SparkSession, path: str, keys: str | list[str], schema: str | T.StructType | None = None, files_per_bucket: int = 1) -> int:
    """Apply again what a stopped job left beside the table; what it had not yet written in full is dropped. The number of
    change sets applied."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    files, folder = _folder(spark, f"{path}/{CHANGES}")
    if not files.exists(folder):
        return 0
    finished = 0
    for entry in files.listStatus(folder):
        own = entry.getPath().toString()
        if files.exists(_folder(spark, f"{own}/_SUCCESS")[1]):
            _applied(spark, path, own, keys, schema, files_per_bucket)
            finished += 1
        else:
            files.delete(entry.getPath(), True)
    return finished


def _swap_in(rows: DataFrame, path: str, keys: list[str], files_per_bucket: int) -> None:
    part = F.pmod(F.hash(*keys), F.lit(files_per_bucket))
    spread = rows.repartition("bucket", part)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PLACE).parquet(path)


def _without(rows: DataFrame, others: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that no other equals in `columns`; nulls are equal to each other."""
    named = others.select(*[F.col(c).alias(f"_other_{c}") for c in columns])
    return rows.join(named, [F.col(c).eqNullSafe(F.col(f"_other_{c}")) for c in columns], "left_anti")


def _applied(spark: SparkSession, path: str, own: str, keys: list[str], schema, files_per_bucket: int) -> Applied:
    changes = spark.read.parquet(own).withColumnsRenamed({"_buckets": "buckets", "_bucket": "bucket"})
    place = [*PLACE, *keys]
    # Each key once, with what is said of it; one row per bucket reaches the driver.
    said = changes.groupBy(*place).agg(F.count_if(F.col("op") == PUT).alias("puts"), F.count_if(F.col("op") == REMOVE).alias("removals"))
    sums = said.groupBy("bucket").agg(
        F.max("puts").alias("most"), F.count_if(F.expr("puts > 0 AND removals = 0")).alias("put"), F.count_if(F.expr("removals > 0")).alias("removed"), F.count_if(F.expr("puts > 0 AND removals > 0")).alias("both")
    )
    touched = {r["bucket"]: r for r in sums.collect()}
    put, removed = sum(r["put"] for r in touched.values()), sum(r["removed"] for r in touched.values())
    files, folder = _folder(spark, own)
    count = _bucket_count(spark, path)
    if any(r["most"] > 1 for r in touched.values()):
        files.delete(folder, True)
        raise ValueError(f"a change set puts a key ({', '.join(keys)}) more than once")
    rows = 0
    if touched:
        puts = changes.filter(F.col("op") == PUT).drop("op")
        if any(r["both"] for r in touched.values()):
            puts = _without(puts, changes.filter(F.col("op") == REMOVE), place)
        try:
            old = _stored(spark, path, schema)
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            old = _stored(spark, path, puts.schema)  # a table without files
        old = old.filter(F.col("bucket").isin(list(touched)))
        kept = _without(old, changes, place).withColumn("_put", F.lit(0))
        both = kept.unionByName(puts.withColumn("_put", F.lit(1)), allowMissingColumns=True)
        # The pass that writes also counts, and marks the buckets that keep rows, 62 to a number.
        seen, numbers = Observation(), sorted(touched)
        place_of = F.array_position(F.array(*map(F.lit, numbers)), F.col("bucket")).cast("int") - 1
        marks = [
            F.coalesce(F.bit_or(F.when(F.floor(place_of / 62) == w, F.call_function("shiftleft", F.lit(1).cast("bigint"), place_of % 62)).otherwise(0)), F.lit(0)).alias(f"w{w}")
            for w in range((len(numbers) + 61) // 62)
        ]
        counted = both.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("_put"), F.lit(0)).alias("put"), *marks).drop("_put")
        _swap_in(counted, path, keys, files_per_bucket)
        try:
            found = seen.get
        except Py4JJavaError:
            # A plan that turns out empty while it runs reports no counts.
            if put:
                raise
            found = {"rows": 0, "put": 0, **{f"w{w}": 0 for w in range(len(marks))}}
        rows = found["rows"]
        if found["put"] != put:
            raise ValueError(f"{put} rows were to be put, {found['put']} were written")
        for i, number in enumerate(numbers):
            # Dynamic overwrite leaves a folder alone when no row is left for it.
            if not found[f"w{i // 62}"] >> (i % 62) & 1:
                store, bucket = _folder(spark, f"{path}/buckets={count}/bucket={number}")
                store.delete(bucket, True)
    files.delete(folder, True)
    return Applied(put, removed, len(touched), rows)
