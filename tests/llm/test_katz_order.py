"""The Katz model of other orders than two against a plain recursive one, and its normalisation."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import katz
from folioflow.llm.common import table

FOLDER = "/root/testdata/sf0.001"
END, START = "</end>", "<start>"


def plain(rows, held, order):
    texts = [[*(w.decode("utf-8", "replace") for w in (t or "").encode().lower().split()), END] for _, t in rows]
    grams = lambda t, k: zip(*[([START] * (k - 1) + t)[i:] for i in range(k)], strict=False)
    counts = [Counter(g for t, h in zip(texts, held, strict=True) if not h for g in grams(t, k)) for k in range(1, order + 1)]
    ds = [katz.discounts([0, *[sum(c == r for c in own.values()) for r in range(1, katz.K + 2)]]) for own in counts]
    after = [{} for _ in counts]
    for own, to in zip(counts, after, strict=True):
        for g, c in own.items():
            to.setdefault(g[:-1], {})[g[-1]] = c
    weights = {}

    def p(context, w):
        k = len(context)
        disc = lambda c: c * (ds[k][c] if c <= katz.K else 1)
        own = after[k].get(context)
        if not own:
            return p(context[1:], w) if k else 1.0
        if context not in weights:
            n = sum(own.values())
            rest = n - sum(map(disc, own.values()))
            below, rest = (n, rest) if rest > 1e-9 else (n + 1, 1)
            weights[context] = below, rest / below / (1 - sum(p(context[1:], x) for x in own)) if k else rest / below
        below, alpha = weights[context]
        return disc(own[w]) / below if w in own else alpha * p(context[1:], w) if k else alpha

    scores = [sum(math.log10(p(g[:-1], g[-1])) for g in grams(t, order)) for t in texts]
    return scores, [g[0] for g in counts[0]], [c for to in after for c in to], p


def compare(spark, rows, held_out, held, order):
    df = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(rows)], "doc_id bigint, text string")
    out = katz.katz_scores(df, held_out, order=order).collect()
    want, words, contexts, p = plain(rows, held, order)
    got = [r.score for r in sorted(out, key=lambda r: r.doc_id)]
    assert np.allclose(got, want, rtol=1e-9, atol=2e-6)
    for v in random.Random(1).sample(contexts, min(12, len(contexts))):
        assert abs(sum(p(v, w) for w in words) + p(v, "never seen") - 1) < 1e-9
    return got


@pytest.mark.parametrize("order, tokens, words", [(3, 2000, 300), (3, 3_000_000, 250_000), (4, 5000, 3000), (1, 2000, 300)])
def test_documents(spark, monkeypatch, order, tokens, words):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(katz, "PART_WORDS", words)
    rows = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").select("doc_id", "text").orderBy("doc_id").limit(150).collect()]
    held = [zlib.crc32(str(n).encode()) % 5 == 1 for n in range(len(rows))]
    compare(spark, rows, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, held, order)


def test_third_word_counts(spark):
    """Pairs alone cannot tell these texts apart."""
    rows = [(0, "a x b")] * 8 + [(0, "c x d")] * 8 + [(0, "a x b"), (0, "a x d"), (0, None), (0, "new x b x")]
    three = compare(spark, rows, F.col("doc_id") >= 16, [n >= 16 for n in range(len(rows))], 3)
    two = compare(spark, rows, F.col("doc_id") >= 16, [n >= 16 for n in range(len(rows))], 2)
    assert three[16] > three[17] + 0.5 and abs(two[16] - two[17]) < 1e-9
    compare(spark, rows, F.lit(True), [True] * len(rows), 3)
    compare(spark, [(0, "a"), (0, "b")], F.col("doc_id") == 1, [False, True], 3)


def test_ids_of_a_shuffled_input(spark):
    """Ids stay with their texts, whatever lies below: the rows of an aggregation, ids of another type, nulls among them."""
    rows = [(None if i % 7 == 0 else f"k{i}", f"a{i % 3} b{i % 5} " * (i % 4 + 1)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(7, "text").groupBy("doc_id", "text").agg(F.count("*").alias("n"))
    out = katz.katz_scores(df, F.lit(False), order=2).collect()
    expected = sorted({(i, len(t.split()) + 1) for i, t in rows}, key=repr)
    assert sorted({(r.doc_id, r.n_tokens) for r in out}, key=repr) == expected and len(out) == df.count()
