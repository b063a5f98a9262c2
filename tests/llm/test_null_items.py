"""Benchmark items without id: their windows hit, and they count as one item, as the SQL has it."""

from folioflow.llm import decontaminate, queries


def test_matches(spark):
    items = spark.createDataFrame([(None, "tiny item"), (None, "other one"), (4, "named item")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "a tiny item and the other one"), (2, "a named item"), (3, "tiny item named item"), (4, "x")], "doc_id bigint, text string")
    for block in (500_000, 1):
        got = {r.id: r for r in decontaminate.matches(docs, items, block_words=block).collect()}
        assert {i: ([tuple(s) for s in r.spans], list(r["items"]), r.unnamed) for i, r in got.items()} == {
            1: ([(1, 3), (5, 7)], [], True), 2: ([(1, 3)], ["4"], False), 3: ([(0, 4)], ["4"], True), 4: ([], [], False),
        }


def test_query(spark, tmp_path):
    words = "w1 w2 w3"
    spark.createDataFrame([(1, f"x {words}"), (2, "x")], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, words), (None, "w2 w3"), (7, "w3")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in queries.decontamination(spark, str(tmp_path)).collect()}
    assert got == {1: (3, 2, True), 2: (0, 0, False)}
