"""New words go to the tokenizer's library many at a time, and come back as each on its own."""

import random

import public_tokenizers
from tokenizers import Tokenizer

from folioflow.llm import tokens

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_words_are_encoded_in_rows(monkeypatch):
    draw = random.Random(5)
    words = ["".join(draw.choice("abdeéghiılnoßrstÿƒɏ'’0") for _ in range(draw.randint(1, 12))) for _ in range(3000)]
    texts = [" ".join(words[i : i + 30]) for i in range(0, 3000, 30)]
    texts += ["", " ", "a  b", " it's we'll 12x\n\n y\t z ", "<|endoftext|> a <|endoftext|>", "中文 字 a b   c", "x" * 70_000 + " yes"]
    plain = Tokenizer.from_file(BPE)
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    asked, encode = [], tokens.Encoder.encode
    monkeypatch.setattr(tokens.Encoder, "encode", lambda self, part: asked.extend(part) or encode(self, part))
    once = tokens.Encoder(BPE)
    assert [x for x in once.encoded(texts)] == [b"".join(i.to_bytes(4, "little") for i in ids) for ids in expected]
    spaced = sum(p[:1] == " " and p[1:].isalpha() for p in once.ids)
    assert spaced > 1500 and len(asked) < len(once.ids) - 0.9 * spaced
    assert once.count(texts) == list(map(len, expected))


def test_rows_that_the_library_splits_otherwise():
    """Words whose first ids do not tell them apart are encoded one by one."""
    encode = tokens.Encoder(BPE)
    expected = encode.encoded(["ab cd ef"])
    encode.ids.clear()
    encode.spaced[:] = False
    assert encode.encoded(["ab cd ef"]) == expected and encode.count(["ab cd ef"]) == [len(expected[0]) // 4]
