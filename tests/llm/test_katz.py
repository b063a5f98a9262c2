"""The Katz model against a plain one, its normalisation, the odd cases."""

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
END, START = object(), object()


def plain(rows, held):
    texts = [[*(t or "").encode().lower().split(), END] for _, t in rows]
    train = [t for t, h in zip(texts, held, strict=True) if not h]
    uni = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip([START, *t], t, strict=False))
    total = sum(uni.values())
    by = lambda counts: [0, *[sum(c == r for c in counts.values()) for r in range(1, katz.K + 2)]]
    d1, d2 = katz.discounts(by(uni)), katz.discounts(by(two))
    disc = lambda d, c: c * (d[c] if c <= katz.K else 1)
    free = total - sum(disc(d1, c) for c in uni.values())
    low = total if free > 1e-9 else total + 1
    p1 = lambda w: disc(d1, uni[w]) / low if uni[w] else ((free if free > 1e-9 else 1) / low if total else 1.0)
    after = {}
    for (v, w), c in two.items():
        after.setdefault(v, {})[w] = c

    def p2(v, w):
        own = after.get(v)
        if not own:
            return p1(w)
        n = sum(own.values())
        rest = n - sum(disc(d2, c) for c in own.values())
        below = n if rest > 1e-9 else n + 1
        rest = rest if rest > 1e-9 else 1
        if w in own:
            return disc(d2, own[w]) / below
        return rest / below / (1 - sum(p1(x) for x in own)) * p1(w)

    score = [sum(math.log10(p2(v, w)) for v, w in zip([START, *t], t, strict=False)) for t in texts]
    base = [sum(math.log10((uni[w] + 0.5) / (total + 0.5 * (len(uni) + 1))) for w in t) for t in texts]
    known = [sum(uni[w] > 0 for w in t) for t in texts]
    return [(len(t), k, total, b, s) for t, k, b, s in zip(texts, known, base, score, strict=True)], uni, p1, p2


def compare(spark, rows, held_out, held):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' as row", "1 as block")
    out = katz.katz_scores(df, held_out).collect()
    assert len(out) == len(rows)
    want, uni, p1, p2 = plain(rows, held)
    key = lambda x: (x[0], x[1], x[2], round(x[3], 6), round(x[4], 6))
    got = sorted(key((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)) for r in out)
    assert np.allclose(got, sorted(map(key, want)), rtol=1e-9, atol=2e-6)
    for v in random.Random(1).sample([START, *sorted(w for w in uni if w is not END)], min(12, len(uni))):
        assert abs(sum(p2(v, w) for w in uni) + p2(v, b"never seen") - 1) < 1e-9
    return out


@pytest.mark.parametrize("tokens, words", [(3_000_000, 250_000), (2000, 300)])
def test_documents(spark, monkeypatch, tokens, words):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(katz, "PART_WORDS", words)
    rows = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    out = compare(spark, rows, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, held)
    mine = [r for r in out if r.held_out]
    assert sum(r.score for r in mine) > sum(r.base_score for r in mine)


def test_odd_rows(spark):
    rows = [(1, None), (1, "a b a b"), (None, "A  B c"), (3, ""), (4, "a " * 50_000), (5, "new words b"), (6, "x" * 2_500_000)]
    compare(spark, rows, F.col("doc_id") == 5, [i == 5 for i, _ in rows])
    compare(spark, rows, F.lit(True), [True] * len(rows))
    compare(spark, [(1, "a"), (2, "b")], F.col("doc_id") == 2, [False, True])
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert katz.katz_scores(empty, F.lit(False)).count() == 0


def test_packing():
    r = np.random.default_rng(1)
    for kind in (np.uint32, np.uint64, np.int64, np.float64):
        x = (r.random(1000) * 1e6).astype(kind)
        assert (katz._unpack(katz._pack(x), kind) == x).all() and len(katz._unpack(katz._pack(x[:0]), kind)) == 0
