"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch of documents is reduced to one row per digest, loses the
known ones in a sort-merge anti-join that reads the index without shuffling it, and the rest is appended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.common import ROW_KEY, join_facts, keep_marked, plain_text, staged
from folioflow.session import shuffle_partitions

SPACE = "[\\x20\\x09-\\x0D]+"


def digest(text: Column) -> Column:
    """SHA-256 of the text with each run of white space made one space."""
    return F.unhex(F.sha2(F.regexp_replace(text, SPACE, " "), 256))


class DigestIndex:
    """A table (digest, keep_id, batch), bucketed and sorted by digest, at `path` under the name `name`.

    `buckets` is fixed for the life of an index; its default is the session's number of shuffle partitions, which lets
    every writing task fill one bucket.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int | None = None):
        self.spark, self.name = spark, name
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets or shuffle_partitions(spark)} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, docs: DataFrame, batch: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Deduplicate `docs` among themselves and against all earlier batches, and append their new digests.

        One row per row of `docs`: the id, `keep_id` (id of the row that stays), `group_size` (rows of this batch with
        that text), `kept`, `text_sha256`. Null text counts as empty. Of equal texts the smallest id stays, a null id
        last; of rows that repeat an id with an equal text, exactly one. A text that an earlier batch held is kept
        nowhere in this one. Other columns of `docs` are not read. A batch that runs again gives the same answer.
        """
        rows = staged(
            docs.select(
                F.col(id_col).cast("bigint").alias("doc_id"),
                digest(plain_text(text_col)).alias("digest"),
                F.monotonically_increasing_id().alias("row"),
            ),
            "digests",
        )
        place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
        groups = staged(rows.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("group_size")), "digest-groups")
        index = self.table().hint("merge")
        fresh = groups.join(index, "digest", "left_anti")
        appended = fresh.select("digest", F.col("first.doc_id").alias("keep_id"), F.lit(batch).alias("batch"))
        appended.write.insertInto(self.name)
        # The index answers, also for the digests that this batch brought in.
        stored = self.table().select("digest", "keep_id", (F.col("batch") == batch).alias("own"))
        answers = staged(groups.join(stored.hint("merge"), "digest"), "digest-answers")
        joined = join_facts(rows, answers, "digest", "group_size")
        kept = F.col("own") & (F.col("row") == F.col("first.row")) & F.col("keep_id").eqNullSafe(F.col("first.doc_id"))
        return joined.select(
            F.col("doc_id").alias(id_col),
            "keep_id",
            "group_size",
            kept.alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            "row",
        )


def deduplicated(docs: DataFrame, index: DigestIndex, batch: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    marks = index.add(docs, batch, id_col, text_col)
    marks = staged(marks.select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_key"), F.col("kept").alias("_kept")), "digest-marks")
    return keep_marked(docs, marks, id_col, lambda rows: rows.withColumn(ROW_KEY, F.lower(F.hex(digest(plain_text(text_col))))))
