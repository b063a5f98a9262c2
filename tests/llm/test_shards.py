"""Balanced shards: counts, slots, cut links."""

import random
import zlib
from collections import Counter

from folioflow.llm import shards

SCHEMA = "doc_id bigint, text string"


def check(spark, rows, n_shards):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "5 as shard", "'x' as link")
    out = shards.balanced_shards(df, n_shards).collect()
    assert len(out) == len(rows)
    assert sorted((r.size, r.text_crc32) for r in out) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)
    counts = Counter(r.shard for r in out)
    assert set(counts) <= set(range(n_shards))
    if len(rows) >= n_shards:
        assert max(counts.values()) - min(counts.get(j, 0) for j in range(n_shards)) <= 1
    for j in counts:
        assert sorted(r.slot for r in out if r.shard == j) == list(range(counts[j]))
    groups = {}
    for r in out:
        groups.setdefault((r.size, r.text_crc32), []).append(r.shard)
    return groups, len(rows) // n_shards


def test_groups_stay_together(spark):
    r = random.Random(1)
    texts = [f"t{i}" for i in range(500)] + [f"g{i}" for i in range(60) for _ in range(r.randint(2, 9))] + ["hot"] * 700 + [None, "", ""]
    r.shuffle(texts)
    groups, room = check(spark, list(enumerate(texts)), 8)
    hot = groups.pop((4, zlib.crc32(b"hot")))
    assert len(set(hot)) <= -(-700 // room) + 2
    assert sum(len(set(g)) > 1 for g in groups.values()) <= 6


def test_odd_tables(spark):
    check(spark, [(1, "a"), (1, "a"), (None, "a"), (2, None), (3, "x" * 2_000_000)], 4)
    check(spark, [(i, "same") for i in range(100)], 7)
    check(spark, [(i, f"p{i // 2}") for i in range(96)], 4)
    check(spark, [(1, "a")], 3)
    assert shards.balanced_shards(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_links(spark):
    docs = spark.createDataFrame([(i, str(i)) for i in range(120)], SCHEMA)
    links = spark.createDataFrame([(i, f"a{i // 6}") for i in range(60)] + [(i, "b") for i in range(60, 64)], "id bigint, link string")
    where = {r.doc_id: r.shard for r in shards.balanced_shards(docs, 4, links).collect()}
    assert Counter(where.values()) == Counter(dict.fromkeys(range(4), 30))
    assert sum(len({where[i] for i in range(k * 6, k * 6 + 6)}) > 1 for k in range(10)) <= 1


def test_flows_hold_the_quotas():
    r = random.Random(3)
    for _ in range(300):
        k = r.randint(2, 6)
        inside = [r.randint(0, 50) for _ in range(k)]
        quota = [n + r.randint(0, 10) for n in inside]
        wants, left = {}, list(inside)
        for a in range(k):
            for b in range(k):
                if a != b:
                    n = r.randint(0, left[a])
                    left[a] -= n
                    wants[(a, b)] = n
        got = shards.flows(wants, inside, quota)
        for j in range(k):
            assert inside[j] + sum(n for (_, b), n in got.items() if b == j) - sum(n for (a, _), n in got.items() if a == j) <= quota[j]
        assert all(0 < n <= wants[p] for p, n in got.items())
    assert shards.flows({(0, 1): 5, (1, 0): 5}, [9, 9], [9, 9]) == {(0, 1): 5, (1, 0): 5}
