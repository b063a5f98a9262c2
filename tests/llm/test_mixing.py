"""The mix against targets worked out source by source and a plain sort of the keys."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from folioflow.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, size string, row int, draw int, key string"


def table_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "clash", 1, 2, "k") for i, t, s in rows], SCHEMA)


def plain_targets(sizes, weights, most):
    """By adding up what is left, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        open_ = sum(w for s, w in weight.items() if s not in full) or 1
        share = {s: most * sizes[s] if s in full else left * weight[s] / open_ for s in sizes}
        above = {s for s in sizes if s not in full and share[s] > most * sizes[s]}
        if not above:
            return share
        full |= above


def plain_mix(rows, weight_of=None, seed=13, weights=(5, 2, 1), most=3):
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = {}
    for (_, _, s), n in zip(rows, words):
        sizes[s] = sizes.get(s, 0) + n
    share = plain_targets(sizes, weights, most)
    keyed = []
    for (i, t, s), n in zip(rows, words):
        text = hashlib.sha256((t or "").encode()).hexdigest()
        digest = hashlib.sha256(f"{seed}:{'-' if i is None else i}:{text}".encode()).hexdigest()
        keyed.append((-math.log((int(digest[:13], 16) + 1) / 16**13) / (weight_of or {}).get(i, 1.0), i, s, n))
    out = []
    for s in sizes:
        budget = min(math.floor(share[s] + 0.5), most * sizes[s])
        epochs = budget // sizes[s] if sizes[s] else 0
        rest = budget - epochs * sizes[s]
        for _, i, _, n in sorted((k for k in keyed if k[2] == s), key=lambda k: (k[0], k[1] is not None, k[1] or 0)):
            part = max(0, min(n, rest))
            rest -= part
            out.append((i, s, n, sizes[s], share[s], epochs, epochs * n + part))
    return sorted(out, key=repr)


def collection(n=400, seed=5):
    draw = random.Random(seed)
    sources = ["hot"] * 10 + ["a", "b", "ä", "B", "", "tiny", None]
    rows = [(i, " ".join(["wä"] * draw.choice([0, 1, 3, 20, 90])), draw.choice(sources)) for i in range(n)]
    rows += [(n, None, "a"), (None, "x y\tz", "b"), (None, "x y z", None), (n + 1, "  ", "only blanks"), (n + 2, "word " * 30000, "long")]
    return rows + rows[:5] * 3 + [rows[3]] * 100


def same(found, expected):
    found = sorted([tuple(r) for r in found.collect()], key=repr)
    assert len(found) == len(expected)
    for ours, theirs in zip(found, expected):
        assert ours[:4] == theirs[:4] and ours[5:] == theirs[5:] and math.isclose(ours[4], theirs[4], rel_tol=1e-12, abs_tol=1e-9)


@pytest.mark.parametrize("partitions", [1, 7])
def test_mix(spark, partitions):
    rows = collection()
    docs = table_of(spark, rows).repartition(partitions)
    good = {i: w for i, w in enumerate([4.0, 0.25, 1.0] * 100)}
    quality = [(i, w) for i, w in good.items()] + [(1, 0.1), (2, None), (3, -1.0), (4, 0.0), (5, float("nan")), (6, float("inf")), (None, 9.0)]
    quality = spark.createDataFrame(quality, "id bigint, weight double")
    same(mixing.mixed(docs, quality=quality), plain_mix(rows, good))


def test_without_quality_and_with_other_weights(spark):
    rows = collection(120, 6)
    same(mixing.mixed(table_of(spark, rows), weights=(1, 9), most=2, seed=4), plain_mix(rows, seed=4, weights=(1, 9), most=2))


def test_sums_meet_targets(spark):
    found = mixing.mixed(table_of(spark, collection()))
    per_source = found.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target")).collect()
    assert all(abs(r["t"] - r["target"]) <= 0.5 + 1e-6 for r in per_source)
    assert found.filter("taken > 3 * size OR taken < 0").isEmpty()


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, " ", "b")], [(1, "one two", "a")]])
def test_small_tables(spark, rows):
    same(mixing.mixed(table_of(spark, rows)), plain_mix(rows))


def test_heavier_rows_are_likelier(spark):
    rows = [(i, "one two three four", "a" if i < 3000 else "z") for i in range(3003)]
    quality = spark.createDataFrame([(i, 5.0 if i % 2 else 1.0) for i in range(3000)], "id bigint, weight double")
    # Source a may give about two thirds of its words: half of the light rows would be a plain sample's share.
    found = mixing.mixed(table_of(spark, rows), weights=(1,), most=1, quality=quality).collect()
    assert all(r["taken"] == r["size"] for r in found)
    part = mixing.mixed(table_of(spark, rows + [(i, "one two three four", "z") for i in range(4000, 7000)]), weights=(1, 5), most=2, quality=quality)
    taken = {r["odd"]: r["t"] for r in part.filter("source = 'a'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("taken").alias("t")).collect()}
    assert taken[1] > 1.8 * taken[0]


def test_targets_reshare(spark):
    docs = table_of(spark, [(1, "w " * 900, "a"), (2, "w " * 50, "b"), (3, "w " * 10, "c"), (4, "w " * 40, "d")])
    found = {r["source"]: r["target"] for r in mixing.mixed(docs).collect()}
    # a: 5/13, b: 2/13 -> full at 150, c: 1/13 -> full at 30, d: 5/13 -> full at 120; a takes the rest.
    assert found == {"a": 700.0, "b": 150.0, "c": 30.0, "d": 120.0}
