"""The pipeline against plain versions of its stages."""

import zlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from folioflow.llm import decontaminate
from folioflow.llm.common import staged, table
from test_near import brute

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(staged(stage(spark, steps[-1], FOLDER), f"test-{name}"))
    rows = [{r.doc_id: r for r in s.collect()} for s in steps[:-1]]
    assert all(s.columns == docs.columns for s in steps[:-1])
    known = [i for i in labels if i in rows[0]]
    assert sum((i in rows[1]) == bool(labels[i]) for i in known) >= 0.9 * len(known)
    first = {}
    for i in sorted(rows[1]):
        first.setdefault(" ".join((rows[1][i].text or "").split()), i)
    assert set(rows[2]) == set(first.values())
    parts = brute([(i, r.text) for i, r in rows[2].items()], 80)
    assert set(rows[3]) == {i for i, (_, root) in parts.items() if i == root}
    items = [(str(r.item_id), decontaminate.words(r.text)) for r in table(spark, FOLDER, "benchmark").collect()]
    whole = decontaminate.Automaton(items)
    for i, r in rows[3].items():
        hits = whole.match(decontaminate.words(r.text or ""))[0]
        if not hits:
            assert rows[4][i] == r
        elif i in rows[4]:
            assert not whole.match(decontaminate.words(rows[4][i].text))[0] and rows[4][i].n_chars == len(rows[4][i].text)
    assert set(rows[4]) <= set(rows[3])
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = steps[-1].collect()
    want = {i: len(encode.encode(r.text or "", add_special_tokens=False).ids) + 1 for i, r in rows[4].items()}
    got = {}
    for r in packed:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


def test_odd_documents(spark):
    rows = [(1, None, "en", None, None), (1, None, None, "s", 0), (None, "ok words to keep here", "en", "s", 21), (None, "ok words to keep here", "en", "s", 21), (3, "", None, None, 0), (4, "A text of its own. " * 20_000, "en", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").selectExpr("*", "1 as _key", "2 as row", "'k' as kept", "3 as _id")
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, FOLDER), f"odd-{name}")
        if name == "exact_dedup":
            assert docs.count() == 3
    assert docs.agg({"length": "sum"}).first()[0] > 0
    empty = table(spark, FOLDER, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = staged(stage(spark, empty, FOLDER), f"empty-{name}")
    assert empty.count() == 0
    assert zlib.crc32(b"") == 0
