"""What the Katz model stores of its grams."""

from pyspark.sql import functions as F

from folioflow.llm import katz
from folioflow.llm.common import table


def test_parts_store_counts_alone(spark, monkeypatch):
    found, close = {}, katz._Answers.close

    def sizes(self):
        size = sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in "abcd")
        rows = self.spark.table(self.name).groupBy("level", "kind").agg(F.sum(size).alias("n")).collect()
        found.update({(r["level"], r["kind"]): r["n"] for r in rows})
        close(self)

    monkeypatch.setattr(katz._Answers, "close", sizes)
    docs = table(spark, "/root/testdata/sf0.001", "documents").limit(200)
    assert katz.katz_scores(docs, F.col("doc_id") % 5 == 0, order=3).count() == 200
    assert all(found[k, 2] < found[k, 3] for k in (2, 3)) and found[1, 0] < found[1, 1]
