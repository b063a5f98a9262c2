"""Exact dedup, token counts, packing, decontamination: against brute force, and the odd cases."""

import hashlib
import random
import re
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from folioflow.llm import decontaminate, exact, packing, tokens

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    (0, "one two  three"), (1, "one two three"), (2, None), (3, ""), (4, " "), (5, "one two\n three"), (5, "one two three"), (None, "one two three"),
    (None, None), (7, "a <|endoftext|>b 漢字 é²½\x1c y z"), (8, "it's  'll 12ab\r\n\t x" * 3), (9, "nospaces" * 4000), (10, "word and " * 9000),
]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in rows], DOCS)


def index(spark, tmp_path, buckets=4):
    return exact.DigestIndex(spark, "ix_" + uuid.uuid4().hex, str(tmp_path / uuid.uuid4().hex), buckets)


def test_exact(spark, tmp_path):
    out = index(spark, tmp_path).add(docs(spark, ODD), "a").collect()
    assert len(out) == len(ODD)
    by_sha = {}
    for i, t in ODD:
        by_sha.setdefault(hashlib.sha256(re.sub("[ \t-\r]+", " ", t or "").encode()).hexdigest(), []).append(i)
    for r in out:
        group = by_sha[r.text_sha256]
        ids = [x for x in group if x is not None]
        assert r.group_size == len(group) and r.keep_id == min(ids, default=None)
    assert sum(r.kept for r in out) == len(by_sha)


def test_exact_batches_and_rerun(spark, tmp_path):
    ix = index(spark, tmp_path)
    ix.add(docs(spark, [(5, "x"), (6, "y")]), "a").collect()
    for _ in range(2):
        out = {r.doc_id: (r.keep_id, r.kept, r.group_size) for r in ix.add(docs(spark, [(1, "x"), (2, "z"), (3, "z")]), "b").collect()}
        assert out == {1: (5, False, 1), 2: (2, True, 2), 3: (2, False, 2)}
    assert ix.table().count() == 3
    assert index(spark, tmp_path).add(docs(spark, []), "a").count() == 0


def test_exact_hot_group_and_plan(spark, tmp_path):
    rows = [(i, "same" if i % 3 else f"t{i}") for i in range(3000)]
    ix = index(spark, tmp_path)
    marked = ix.add(docs(spark, rows), "a")
    assert sum(r.kept for r in marked.collect()) == 1001
    plan = marked._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
    kept = exact.deduplicated(docs(spark, ODD), index(spark, tmp_path), "a")
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert kept.count() == len({re.sub("[ \t-\r]+", " ", t or "") for _, t in ODD})


def library():
    return Tokenizer.from_file(BPE)


def test_token_counts(spark):
    got = tokens.token_counts(docs(spark, ODD).selectExpr("*", "text as n_bytes"), BPE, limit=12).collect()
    want = sorted((len((t or "").encode()), len(library().encode(t or "", add_special_tokens=False).ids)) for _, t in ODD)
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 12) for r in got)
    assert tokens.token_counts(docs(spark, []), BPE).count() == 0
    piece = public_tokenizers.path("piece_bpe_32k.model")
    assert tokens.token_counts(docs(spark, ODD[:4]), piece).count() == 4


def test_encoder_agrees_with_library():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    encode, plain = tokens.Encoder(BPE), library()
    letters = st.sampled_from(list("ab Z9'’–\n\t\r\x0b\x85\xa0é½²ǃ漢<|>") + ["<|endoftext|>", "'ll", "  ", " the", "10"])

    @settings(max_examples=400, deadline=None)
    @given(st.lists(letters, max_size=25).map("".join))
    def same(text):
        ids = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode.encoded([text])[0], "<u4").tolist() == ids
        assert encode.count([text]) == [len(ids)]

    same()
    assert "".join(tokens.stretches("ab  cd\nef" * 50, 10)) == "ab  cd\nef" * 50


def test_packing_round_trip(spark):
    rows = packing.packed(docs(spark, ODD), BPE, 64, 2, with_ids=True)
    placed = rows.collect()
    assert len(placed) == rows.count()
    want = sorted(np.array([*library().encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t in ODD)
    by_seq, by_doc = {}, {}
    for r in placed:
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_seq.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    unique = [r for r in placed if r.doc_id not in (None, 5)]
    for r in sorted(unique, key=lambda r: (r.doc_id, r.piece)):
        before = by_doc.get(r.doc_id, b"")
        assert r.start * 4 == len(before)
        by_doc[r.doc_id] = before + bytes(r.ids)
    assert all(x in want for x in by_doc.values())
    whole = packing.sequences(rows)
    assert whole.agg({"n_tokens": "sum"}).first()[0] == sum(len(x) // 4 for x in want)
    assert all(len(r.ids) == 4 * r.n_tokens for r in whole.collect())
    assert packing.packed(docs(spark, []), BPE).count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 500, 50_000])
def test_bin_plan(n):
    r = random.Random(n)
    counts = {}
    for _ in range(n):
        length = max(1, min(1023, int(r.lognormvariate(5, 1.2))))
        counts[length] = counts.get(length, 0) + 1
    plan = packing.bin_plan(counts, 1024)
    used = {}
    for lengths, copies in plan:
        assert sum(lengths) <= 1024
        for x in lengths:
            used[x] = used.get(x, 0) + copies
    assert used == counts
    bins, least = sum(c for _, c in plan), -(-sum(k * v for k, v in counts.items()) // 1024)
    assert bins <= least * 1.02 + 1


def occurrences(items, text, window):
    hit, names = [False] * len(text), set()
    for name, item in items:
        n = min(window, len(item))
        own = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(text) - n + 1):
            if tuple(text[i : i + n]) in own:
                names.add(name)
                hit[i : i + n] = [True] * n
    return hit, names


def test_automaton():
    r = random.Random(3)
    for _ in range(1500):
        letters = [b"a", b"b", b"c"][: r.choice([1, 2, 3])]
        items = [(str(i), [r.choice(letters) for _ in range(r.randint(0, 9))]) for i in range(r.randint(0, 5))]
        window, text = r.randint(1, 5), [r.choice([*letters, b"z"]) for _ in range(r.randint(0, 30))]
        spans, names = decontaminate.Automaton(items, window).match(text)
        hit = [any(a <= i < b for a, b in spans) for i in range(len(text))]
        assert (hit, names) == occurrences(items, text, window)


def test_decontaminated(spark):
    item = "The quick brown fox jumps over the lazy dog and then it sleeps well"
    rows = [(1, "Before. " + item.upper() + "! After it all comes more text that is clean and stays, " * 2), (2, item), (3, None), (4, ""), (None, "quick brown fox"), (6, "tiny Item here"), (6, "ok")]
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (None, "ok"), (4, "Tiny item")], "item_id bigint, text string")
    for block in (500_000, 1):
        found = {(r.id, r.n_words): r for r in decontaminate.matches(docs(spark, rows), items, block_words=block).collect()}
        assert len(found) == len(rows)
        assert found[(1, 37)]["items"] == ["1"] and [tuple(s) for s in found[(1, 37)].spans] == [(1, 15)]
        assert found[(6, 3)]["items"] == ["4"] and found[(6, 1)]["items"] == []
        left = {(r.doc_id, r.text): r for r in decontaminate.decontaminated(docs(spark, rows), items, block_words=block).collect()}
        assert {i for i, _ in left} == {1, 3, 4, None} and (3, None) in left
        text = next(t for i, t in left if i == 1)
        assert "QUICK" not in text and text.startswith("Before.") and "After it all" in text and left[(1, text)].n_chars == len(text)
    assert decontaminate.matches(docs(spark, []), items).count() == 0
    assert decontaminate.matches(docs(spark, rows), items.limit(0)).filter("size(spans) > 0 or n_words is null").count() == 0


def test_blocks_give_what_one_gives(spark):
    """Items of several blocks that overlap in a text, and windows that only cutting joins."""
    run = [f"w{i}" for i in range(40)]
    items = [(str(k), " ".join(run[k : k + 12])) for k in range(0, 28, 5)] + [(None, " ".join(f"z{i}" for i in range(11)))]
    z = [f"z{i}" for i in range(11)]
    texts = [" ".join(["a"] * 60 + run[3:30] + ["b"] * 30), " ".join(["c"] * 80 + z[:5] + run[:12] + z[5:] + ["d"] * 20), " ".join(run), " ".join(["e"] * 30), "", None]
    rows = docs(spark, list(enumerate(texts)))
    items = spark.createDataFrame(items, "item_id string, text string")
    assert decontaminate.automatons(items, 10, "item_id", "text", 20)[1] > 2
    found = [sorted([tuple(r) for r in decontaminate.decontaminated(rows, items, block_words=n).collect()], key=repr) for n in (500_000, 20)]
    assert found[0] == found[1] and len(found[0]) == 5
    assert [tuple(r)[1] for r in sorted(decontaminate.decontaminated(rows, items, block_words=20).collect(), key=lambda r: r.doc_id)][1].split() == ["c"] * 80 + ["d"] * 20
