"""Near-duplicates against all pairs; components against a union-find; the odd cases."""

import random

import numpy as np

from folioflow.llm import near, words
from folioflow.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def shingle_set(text, size=5):
    own = (text or "").encode().lower().split()
    return {tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))} if own else set()


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def brute(rows, percent):
    """Component by all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    holders, union = {}, Union()
    for i, own in sets.items():
        for s in own:
            holders.setdefault(s, []).append(i)
    pairs = {(a, b) for own in holders.values() for k, a in enumerate(own) for b in own[k + 1 :]}
    for a, b in pairs:
        shared = len(sets[a] & sets[b])
        if 100 * shared >= percent * len(sets[a] | sets[b]):
            union.join(a, b)
    return {i: (len(sets[i]), union.find(i)) for i in sets}


def check(spark, rows, percent):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = near.near_duplicates(df, percent).collect()
    assert len(out) == len(rows)
    want = brute(rows, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    check(spark, rows, 85)


def test_many_near_copies(spark):
    r = random.Random(4)
    pool = [f"w{i}" for i in range(3000)]
    rows, base = [], [r.choice(pool) for _ in range(220)]
    for i in range(600):
        own = list(base)
        for _ in range(r.randint(0, 3)):
            own[r.randrange(len(own))] = r.choice(pool)
        rows.append((i, " ".join(own) if i % 3 else " ".join(base)))
    for i in range(600, 700):
        own = base[: r.randint(60, 220)] + [r.choice(pool) for _ in range(r.randint(0, 200))]
        rows.append((i, " ".join(own)))
    rows += [(700 + i, " ".join(r.choice(pool) for _ in range(r.randint(1, 8)))) for i in range(100)]
    check(spark, rows, 85)
    check(spark, rows, 80)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "A b"), (5, "a  B"), (None, "one two three four five six"), (7, "one two three four five six"), (8, "a b c"), (8, "a b c"), (9, "x" * 3_000_000), (10, "w " * 300_000), (None, "z z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'k' as key", "1 as row", "2 as component_id")
    out = near.near_duplicates(df).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[1] == [(0, 1, True)] and by[3] == [(0, 3, True)] and by[5] == [(1, 4, False)]
    assert sorted(by[None], key=str) == [(1, None, True), (2, 7, False)]
    assert sorted(by[8]) == [(1, 8, False), (1, 8, True)] and by[10] == [(1, 10, True)]
    assert near.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(2)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(150)] + [(5000, 5001 + i) for i in range(400)]
    union = Union()
    for a, b in pairs:
        union.join(a, b)
    got = {x.node: x.root for x in near.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {x: union.find(x) for x in union if union.find(x) != x}


def test_borders(spark):
    """Neighbours on either side of a partition border are candidates too."""
    n = 400
    sig = np.zeros((n, near.SIGNATURE), ">u4")
    rows = [(i, 10, sig[i].tobytes()) for i in range(n)]
    df = spark.createDataFrame(rows, "row bigint, n_shingles bigint, signature binary")
    got = {(r.a, r.b): r.shared for r in near.candidates(df, 80).collect()}
    assert got == {(a, b): near.TREES * near.DEPTH for a in range(n) for b in range(a + 1, min(n, a + 1 + near.NEIGHBOURS))}


def test_word_hashes(monkeypatch):
    monkeypatch.setattr(words, "BLOCK", 64)
    r = random.Random(1)
    seen = {}
    for _ in range(1000):
        texts = ["".join(r.choice(["a", "bB", "c", " ", "\n", "\x0b", "é", "q", "x" * 100 if r.random() < 0.1 else "y"]) for _ in range(r.randint(0, 40))) for _ in range(3)]
        hashes, before = words.batch_hashes(texts)
        split = [t.encode().lower().split() for t in texts]
        assert np.diff(before).tolist() == [len(s) for s in split]
        for word, h in zip([w for s in split for w in s], hashes.tolist(), strict=True):
            assert len(word) > 60 or seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_crowded_region(spark, monkeypatch):
    """Many texts of one family that mostly do not link: the few links are found, in blocks too."""
    monkeypatch.setattr(near, "CROWD", 40)
    r = random.Random(9)
    pool = [f"w{i}" for i in range(5000)]
    base, rows = [r.choice(pool) for _ in range(300)], []
    for i in range(160):
        own = list(base)
        for _ in range(13):
            own[r.randrange(len(own))] = r.choice(pool)
        rows.append((i, " ".join(own)))
    for i in range(0, 160, 8):
        own = rows[i][1].split()
        for k in range(20, 300, 60):
            own[k] = "changed"
        rows.append((200 + i, " ".join(own)))
    for neighbours in (6, 1):
        monkeypatch.setattr(near, "NEIGHBOURS", neighbours)
        check(spark, rows, 85)


def test_thin_ranges(spark):
    """Twenty equal signatures over far more ranges than rows: each still meets its next neighbours in every order."""
    n = 20
    rows = [(i, 10, np.zeros(near.SIGNATURE, ">u4").tobytes()) for i in range(n)]
    df = spark.createDataFrame(rows, "row bigint, n_shingles bigint, signature binary")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "150")
        got = {(r.a, r.b): r.shared for r in near.candidates(df, 80).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {(a, b): near.TREES * near.DEPTH for a in range(n) for b in range(a + 1, min(n, a + 1 + near.NEIGHBOURS))}


def test_reach():
    assert near._reach([(0, 9), (2, 3), (3, 1), (7, 8), (9, 1)]) == [(2, 0), (3, 0), (7, 0), (3, 2), (7, 2), (7, 3), (9, 7)]


def test_many_small_partitions(spark):
    r = random.Random(12)
    base = [f"w{r.randrange(900)}" for _ in range(90)]
    rows = []
    for i in range(40):
        own = list(base)
        for _ in range(r.randint(0, 4)):
            own[r.randrange(90)] = f"x{r.randrange(900)}"
        rows.append((i, " ".join(own)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        check(spark, rows, 85)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
