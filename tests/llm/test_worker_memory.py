"""What a Python worker keeps between tasks is bounded."""

import random

import public_tokenizers
from pyspark import SparkContext
from tokenizers import Tokenizer

from folioflow.llm import near, tokens, words

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_kept():
    encode, plain = tokens.Encoder(BPE), Tokenizer.from_file(BPE)
    batch, most = 20_000, 0
    for i in range(0, 400_000, batch):
        texts = [f"the {n}" for n in range(i, i + batch)]
        found = encode.encoded(texts)
        most = max(most, len(encode.ids))
        assert "the" in encode.ids
        assert len(found[7]) == 4 * len(plain.encode(texts[7], add_special_tokens=False).ids)
        assert encode.count(texts[:1]) == [len(plain.encode(texts[0], add_special_tokens=False).ids)]
    assert most <= 300_000 + batch + 1


def test_tables_of_words():
    assert words._POWERS.nbytes + words._BACK.nbytes < 5e6
    # Words longer than a block, and the blocks after them.
    long = "x" * (3 * words.BLOCK + 17)
    hashes, before = words.batch_hashes([f"a {long} b", f"c d e {long} b", f"{long}y", ""])
    assert before.tolist() == [0, 3, 8, 9, 9]
    assert hashes[1] == hashes[6] != hashes[8] and hashes[2] == hashes[7]


def test_one_kind_of_worker(spark, monkeypatch):
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choice("abcdefgh") * 3 for _ in range(30))) for i in range(40)]
    docs = spark.createDataFrame(rows + [(100, rows[0][1] + " more")], "doc_id bigint, text string")

    def refused(*args, **kwargs):
        raise AssertionError("rows of Python objects")

    monkeypatch.setattr(SparkContext, "parallelize", refused)
    found = {r.doc_id: r.component_id for r in near.near_duplicates(docs, 80).collect()}
    assert found[100] == 0 and found[1] == 1 and len(found) == 41
