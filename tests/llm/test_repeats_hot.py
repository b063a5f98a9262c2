"""A phrase in much different text: its stretches must spread over the parts, with the same result."""

import random

import numpy as np
from test_repeats import check

from folioflow.llm import repeats


def spied(monkeypatch, folder):
    """Writes down how many stretches each part gets."""
    judge = repeats._judge

    def counting(size):
        run = judge(size)

        def spy(asked):
            rows = asked.to_pylist()
            (folder / str(rows[0]["part"])).write_text(str(sum(len(r["b"]) // 3 for r in rows)))
            return run(asked)

        return spy

    monkeypatch.setattr(repeats, "_judge", counting)
    return lambda: [int(f.read_text()) for f in folder.iterdir()]


def word(r, n):
    return "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))


def texts(n):
    """A phrase between random text, each time another; a phrase that most strings around it have as their anchor."""
    r = random.Random(4)
    sides = [(word(r, 40), word(r, 40)) for _ in range(n)]

    def most(phrase):
        data = np.frombuffer("".join(a + phrase + b for a, b in sides[:50]).encode(), np.uint8)
        hashes = repeats.anchors(data, np.arange(1, 51) * (80 + len(phrase)), 50, 24)[0]
        return np.unique(hashes, return_counts=True)[1].max()

    phrase = max((word(r, 24) for _ in range(60)), key=most)
    return [a + phrase + b for a, b in sides]


def test_hot_anchor_spreads(spark, monkeypatch, tmp_path):
    own = texts(1000)
    rows = list(enumerate(own)) + [(2000 + i, t[:-10] + "0123456789") for i, t in enumerate(own[:20])]
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 20_000)
    sizes = spied(monkeypatch, tmp_path)
    check(spark, rows)
    got = sizes()
    assert len(got) >= 8 and max(got) < sum(got) / 4


def test_dense_hot_anchors(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 400)
    monkeypatch.setattr(repeats, "PART_ANCHORS", 100)
    r = random.Random(1)
    rows = [(i % 90 or None, "".join(r.choice("ab") for _ in range(r.randint(0, 60)))) for i in range(120)]
    check(spark, rows + [(300, "a" * 100), (301, "a" * 101), (5, "")], size=9, piece=4)
