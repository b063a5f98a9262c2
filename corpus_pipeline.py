"""A collection made ready for training in five stages, each a step of `folioflow.llm` on what the one before it kept.

Each stage takes (spark, docs, folder of tables) and returns the columns of documents, but the last, which returns where
each piece of each document goes. `run` writes every stage as Parquet under `spark.checkpoint.dir` and reads it again.
Null texts count as empty in every stage. A row that a stage keeps keeps its columns; only decontamination edits texts.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm import decontaminate, exact, near, packing, quality
from folioflow.llm.common import staged, table
from folioflow.session import work_dir

# Result rows depend on a trained model and on packing: no SQL says them.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier, fitted on this collection and its labels, takes for good ones."""
    model = quality.train(docs, table(spark, folder, "labels"), held_out_fold=0)
    score, good = (fresh(name, docs.columns) for name in ("_score", "_good"))
    rows = quality.scored(docs, model, threshold=0.3, score_col=score, predicted_col=good)
    return rows.filter(F.col(good) == 1).select(*docs.columns)


def fresh(name: str, taken: list[str]) -> str:
    """`name`, longer by underscores if a column has it; names differ by case to nobody."""
    lower = {c.lower() for c in taken}
    while name in lower:
        name += "_"
    return name


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each text, white space aside: the one with the smallest doc_id."""
    index = exact.DigestIndex(spark, f"pipeline_digests_{uuid.uuid4().hex}", work_dir(spark, "pipeline-digests"))
    return exact.deduplicated(docs, index, "documents")


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each component of near-duplicates: 0.8 of the five-word shingles in common."""
    return near.deduplicated(docs, percent=80, size=5)


def cut_benchmarks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without passages of the benchmark; documents that are mostly such passages go."""
    return decontaminate.decontaminated(docs, table(spark, folder, "benchmark"), window=10, max_coverage=0.5)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Where each piece of each document goes in sequences of 1024 tokens."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), size=1024, end_id=2)


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", cut_benchmarks),
    ("packing", pack),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, folder), f"pipeline-{name}")
    return docs
