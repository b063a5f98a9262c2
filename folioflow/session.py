"""What operators need to know about the session they run in."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A plan estimated below this is spread over all cores before costly per-row Python work.
SPREAD_BELOW_BYTES = 256 * 1024 * 1024


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session."""
    return f"{checkpoint_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`; a local session may go without."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    root = root or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="folioflow-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder, so that later steps see one fixed partitioning."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_partitions(df: DataFrame) -> int:
    """How many ranges to cut `df` into: the session's setting, fewer for a small table (256 KB in a range at least),
    more for a large one (128 MB at most), both as estimated. A plan of unknown size gets the setting."""
    size, usual = estimated_bytes(df), shuffle_partitions(df.sparkSession)
    if size > 2**53:
        return usual
    return max(1, min(usual, math.ceil(size / (256 * 1024))), math.ceil(size / (128 * 1024 * 1024)))


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input over all cores; a large one already comes in many splits."""
    if estimated_bytes(df) >= SPREAD_BELOW_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
