"""What blocks ask the parts for: numbers that repeat are sent once."""

import random

import numpy as np
from pyspark.sql import functions as F

from folioflow.llm import katz


def test_values_are_packed_once():
    draw = np.random.default_rng(3)
    ids = draw.integers(0, 1 << 62, 2000).astype(np.uint64)
    x = ids[np.minimum(draw.zipf(1.3, 50_000), 2000) - 1]
    raw = katz._pack_values(x)
    assert (katz._unpack_values(raw, np.uint64) == x).all()
    assert len(raw) < 0.7 * len(katz._pack(x))
    for few in (x[:0], x[:1], np.array([5, 5, -3], np.int64)):
        assert (katz._unpack_values(katz._pack_values(few), few.dtype) == few).all()


def test_requests_name_each_last_word_once(spark, monkeypatch):
    draw = random.Random(2)
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(draw.choices(words, k=80))) for i in range(40)], "doc_id bigint, text string")
    blocks = katz._blocks(docs.repartition(1), F.col("doc_id") % 5 == 1, "doc_id", "text").toArrow().to_pylist()
    answered = katz._ask_words(1)
    asked = [b for r in blocks for b in answered(spark.createDataFrame([r], katz.BLOCK).select("block", "words", "counts").toArrow().to_batches())]
    import pyarrow as pa

    found = katz._count_words(pa.Table.from_batches(asked))
    rows = [{**r, "level": 1} for r in found.to_pylist()]
    counts = katz._unpack(rows[0]["a"], np.int64)
    counts = counts[counts > 0]
    n = np.bincount(np.minimum(counts, katz.K + 2), minlength=katz.K + 3)[: katz.K + 2].tolist() + [len(counts)]
    total = int(counts.sum())
    model = katz.Model(1, total, katz.Unigrams.of(total, n), 2)
    table = pa.Table.from_pylist(blocks)
    out = katz._ask_grams(model)(None, table, pa.Table.from_pylist([r for r in rows if r["kind"] == 1])).to_pylist()[0]
    names, place = katz._unpack_steps(out["words"], np.uint64), katz._unpack(out["w"], np.uint32)
    assert len(names) == len(set(names.tolist())) == 61 and place.max() == 60
    assert len(place) == len(katz._unpack(out["n"], np.uint32)) > 1000
    assert len(katz._unpack(out["c"], np.int64)) == 61
