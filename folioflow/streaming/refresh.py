"""Incremental refresh: new revisions arrive as files and bring the target table up to date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators import diff
from folioflow.session import cut
from folioflow.sources import sinks


def refresh_batch(spark: SparkSession, revisions: DataFrame, path: str, key: str = "title", build: Callable | None = None) -> None:
    """Apply one batch of (key, ts) revisions to the table at `path` (which has key, modified).

    Only the newest revision of a page counts, and only if it is newer than the stored one, so
    a batch that is run again changes nothing and a late revision is passed over.
    """
    newest = diff.latest_revision(revisions, key=key)
    stored = sinks.read_table(spark, path, f"{key} string, modified timestamp_ntz")
    newer = newest.join(stored, key, "left").filter(
        F.col("modified").isNull() | (F.col("lastmod") > F.col("modified"))
    )
    changed = cut(newer.select(key, F.col("lastmod").alias("modified")))
    sinks.save_docs(spark, path, build(changed) if build else changed, key)


def refresh_stream(revisions: DataFrame, path: str, checkpoint: str, key: str = "title", build: Callable | None = None):
    """Start the refresh over a stream of revisions; stops by itself once all files are read."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        refresh_batch(batch.sparkSession, batch, path, key, build)

    return (
        revisions.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def revision_stream(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    """Revision files as a stream, a bounded number of files at a time if wanted."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getFileStatus(location).isFile():
        # A stream watches a folder: a single file is its folder seen through the file's name.
        return reader.option("pathGlobFilter", location.getName()).parquet(location.getParent().toString())
    return reader.parquet(path)
