"""What the index holds decides, also about a batch's own digests."""

import uuid

from pyspark.sql import functions as F

from folioflow.llm import exact


def test_index_answers(spark, tmp_path):
    index = exact.DigestIndex(spark, f"digests_{uuid.uuid4().hex}", str(tmp_path / "index"))
    held = spark.createDataFrame([(77, "b  c", "now"), (55, "d", "before")], "keep_id bigint, text string, batch string")
    held.select(exact.digest(F.col("text")).alias("digest"), "keep_id", "batch").write.insertInto(index.name)
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b c"), (4, "d"), (None, "e")], "doc_id bigint, text string")
    for _ in range(2):
        got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in index.add(docs, "now").collect()), key=str)
        assert got == sorted([(1, 1, 2, True), (2, 1, 2, False), (3, 77, 1, False), (4, 55, 1, False), (None, None, 1, True)], key=str)
    assert index.table().count() == 4
