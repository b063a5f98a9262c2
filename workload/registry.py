"""Named queries over (spark, folder of tables) and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame; `sql` is its check on the same tables."""

    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
