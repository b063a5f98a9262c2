"""Removal of repeated byte strings against brute force; the suffix order; the odd cases."""

import random

import numpy as np
import pytest

from folioflow.llm import repeats
from folioflow.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def brute(rows, size):
    texts = [(i, (t or "").encode()) for i, t in rows]
    key = lambda i: (i is None, i or 0)
    least = {}
    for i, t in texts:
        for s in range(len(t) - size + 1):
            own = t[s : s + size]
            least[own] = min(least.get(own, key(i)), key(i))
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for s in range(len(t) - size + 1):
            if least[t[s : s + size]] < key(i):
                gone[s : s + size] = [True] * size
        spans = []
        for k, g in enumerate(gone):
            if g:
                if spans and spans[-1][1] == k:
                    spans[-1] = (spans[-1][0], k + 1)
                else:
                    spans.append((k, k + 1))
        out.append((i, len(t), tuple(spans), bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def check(spark, rows, size=50, piece=24):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' as spans", "1 as kept")
    out = repeats.without_repeats(df, size, piece).collect()
    got = sorted(((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in out), key=repr)
    assert got == brute(rows, size)


@pytest.mark.parametrize("block, chunk", [(12 << 20, 1 << 21), (20_000, 1000)])
def test_documents(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    check(spark, [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()])


def test_dense_repeats(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 400)
    r = random.Random(1)
    rows = [(i, "".join(r.choice("ab") for _ in range(r.randint(0, 60)))) for i in range(120)]
    rows += [(200 + i, "ab" * r.randint(0, 30)) for i in range(20)] + [(300, "a" * 100), (301, "a" * 101)]
    check(spark, rows, size=9, piece=4)


def test_odd_rows(spark):
    long = "The same passage of more than fifty bytes, né? It is in many rows. "
    rows = [(None, long), (None, long + "x"), (3, None), (4, ""), (5, long), (5, "y" + long), (1, "short"), (2, "z" * 49), (7, "z" * 50), (8, "z" * 5000), (9, long * 3)]
    check(spark, rows)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert repeats.without_repeats(empty).count() == 0


def test_suffix_order():
    r = random.Random(2)
    for _ in range(200):
        size = r.choice([8, 9, 17, 30, 50])
        text = bytes(r.choice([b"ab", b"abc", bytes(range(256))])[0:][r.randrange(2)] for _ in range(r.randint(size, 400)))
        starts = np.arange(len(text) - size + 1)
        order, group = repeats.sorted_classes(text, starts, size, shallow=r.choice([0, 8, 16, 24]))
        strings = [text[s : s + size] for s in starts[order]]
        assert strings == sorted(strings) and sorted(order.tolist()) == starts.tolist()
        assert [a == b for a, b in zip(strings, strings[1:], strict=False)] == (np.diff(group) == 0).tolist()


def test_anchors_cover_all_strings():
    r = random.Random(3)
    texts = [bytes(r.choice(b"abcd") for _ in range(r.randint(0, 300))) for _ in range(30)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    hashes, first, last = repeats.anchors(data, ends, 50, 24)
    covered = [s for a, b in zip(first, last, strict=True) for s in range(a, b + 1)]
    begin = np.concatenate([[0], ends[:-1]])
    assert covered == [s for a, b in zip(begin, ends, strict=True) for s in range(a, b - 49)]
    assert (last - first).max() <= 26
