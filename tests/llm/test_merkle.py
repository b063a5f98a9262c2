"""The manifest against trees built by the rule, level by level."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from folioflow.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*digests):
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def leaf_of(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        row = out[-1]
        out.append([H(*row[i : i + 2]) for i in range(0, len(row), 2)])
    return out


def proof(tree, at):
    """(side, sibling or None) from the leaf up."""
    steps = []
    for row in tree[:-1]:
        other = at ^ 1
        steps.append(("-", None) if other >= len(row) else (("L" if other < at else "R"), row[other]))
        at //= 2
    return steps


def climb(leaf, steps):
    for side, other in steps:
        leaf = H(leaf) if side == "-" else H(other, leaf) if side == "L" else H(leaf, other)
    return leaf


def expected(rows, tampered=lambda row: False):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, subroots = {}, []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = own, levels([leaf_of(r) for r in own])
        subroots.append(trees[lang][1][-1][0])
    top = levels(subroots)
    out = []
    for spot, lang in enumerate(langs):
        own, tree = trees[lang]
        for at, row in enumerate(own):
            steps = proof(tree, at) + proof(top, spot)
            changed = (*row[:3], row[3] + 1 if row[3] is not None else None, row[4]) if tampered(row) else row
            root = climb(leaf_of(changed), steps)
            out.append((row[0], leaf_of(row), subroots[spot], top[-1][0], H(*[s for _, s in steps if s]), root, root == top[-1][0]))
    return sorted(out, key=repr)


def bad(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0


def run(spark, rows, block):
    docs = spark.createDataFrame(rows, SCHEMA)
    found = merkle.verified_manifest(docs, FIELDS, "lang", "doc_id", F.crc32(F.col("doc_id").cast("string")) % 7 == 0, {"n_chars": F.col("n_chars") + 1}, block)
    return sorted([tuple(r) for r in found.collect()], key=repr)


def collection(n, seed=3):
    draw = random.Random(seed)
    langs = ["en"] * 6 + ["de", "ä", None, ""]
    rows = [(i, draw.choice(["a", None, "ü"]), draw.choice(langs), draw.choice([None, 0, 12, -4]), draw.choice([None, "", "text", "grün " * 3])) for i in range(n)]
    return rows + [(None, None, "en", 1, "x"), (None, None, None, None, None)] + rows[:3] + [(5, "a", rows[5][2], 7, "other")]


@pytest.mark.parametrize("block, n", [(2, 9), (8, 140), (4096, 90)])
def test_manifest(spark, block, n):
    rows = collection(n)
    assert run(spark, rows, block) == expected(rows, bad)


def test_small_collections(spark):
    for rows in ([(1, "a", "en", 1, "x")], [(1, "a", "en", 1, "x"), (2, "a", None, None, None)], [(7, None, "en", 3, "x")] * 3):
        assert run(spark, rows, 2) == expected(rows, bad)
    assert run(spark, [], 4) == []


def test_tampering_is_found(spark):
    rows = collection(60)
    found = run(spark, rows, 8)
    assert {r[6] for r in found} == {True, False}
    assert all(r[6] for r in found if r[0] is None)


def as_rows(manifest):
    rows = manifest.witnesses().select("row.doc_id", "leaf", "path", "siblings", "subroot", "root").collect()
    return sorted([(r[0], r[1], r[2], bytes(r[3]), r[4], r[5]) for r in rows], key=repr)


@pytest.mark.parametrize("block", [8])
def test_batches_extend_earlier_witnesses(spark, block):
    rows = [r for r in collection(75) if r[0] is not None]
    rows = sorted(set(rows), key=lambda r: r[0])
    rows = [r for i, r in enumerate(rows) if i == 0 or rows[i - 1][0] != r[0]]
    whole, grown = merkle.Manifest(block), merkle.Manifest(block)

    def leaves(some):
        docs = spark.createDataFrame(some, SCHEMA)
        return docs.select("doc_id", "lang", merkle.digest_of([F.col(f) for f in FIELDS]).alias("leaf"), F.lit(1).alias("key"))

    whole.append(leaves(rows), "lang", "doc_id", "leaf")
    for first, end in ((0, 20), (20, 21), (21, 21), (21, 60), (60, len(rows))):
        grown.append(leaves(rows[first:end]), "lang", "doc_id", "leaf")
    assert as_rows(grown) == as_rows(whole)
    with pytest.raises(ValueError):
        grown.append(leaves(rows[:2]), "lang", "doc_id", "leaf")
    assert as_rows(grown) == as_rows(whole)


def test_growth_alone():
    for n in range(1, 40):
        leaves = [H(str(i)) for i in range(n)]
        tree = merkle.Growth(n)
        for x in leaves:
            tree.append(x)
        root = tree.close()
        height = max(0, n - 1).bit_length()
        full = levels(leaves)
        assert root == full[-1][0]
        for i in range(n):
            path, siblings = tree.witness(i, height)
            assert (path, siblings) == ("".join(s for s, _ in proof(full, i)), bytes.fromhex("".join(o or "" for _, o in proof(full, i))))
            assert merkle.fold(leaves[i], path, siblings) == root
