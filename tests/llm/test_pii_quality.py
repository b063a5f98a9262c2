"""Personal data against the plain patterns and a held-out table; quality on held-out labels; the odd cases."""

import random
import re
import zlib

import numpy as np
import pytest

from folioflow.llm import pii, quality
from folioflow.llm.common import table

FOLDER = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
            fine = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and sum(double) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }
            if fine[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def test_patterns():
    r = random.Random(5)
    for _ in range(30_000):
        text = "".join(r.choice("a1 .-@+()b9é") for _ in range(r.randint(0, 24)))
        assert pii.base_spans(text) == plain_spans(text), text
    for number in ("4041894974608795", "4041 8949 7460 8795", "4041-8949-7460-8795"):
        assert pii.base_spans(f"x {number}.") == plain_spans(f"x {number}.")
    long = "1" * 100_000 + " " + "a." * 50_000 + "@" + "+1" * 40_000
    assert pii.base_spans(long) == []


def test_runs():
    r = random.Random(6)
    for _ in range(1000):
        text = "".join(r.choice(["a", "bb ", " ", "\n", "1", " c", " dd"]) for _ in range(r.randint(0, 60)))
        words = [(m.start(), m.end()) for m in re.finditer(r"[^ \t-\r]+", text)]
        mark = ["1" in text[a:b] for a, b in words]
        want = {w for j, w in enumerate(words) if any(mark[max(0, j - pii.NEAR) : j + pii.NEAR + 1])}
        got = [w for run in pii.runs_of(text) for w in run]
        assert len(got) == len(set(got)) and set(got) == want


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(pii.labelled_words(spark))


def test_viterbi_is_best_path():
    r = np.random.default_rng(1)
    k = len(pii.STATES)
    field = pii.Field({}, np.zeros((3, 0, k)), r.normal(size=(k, k)), r.normal(size=k))
    runs = [r.normal(size=(n, k)) for n in (1, 2, 3, 3)]
    for run, path in zip(runs, field.decode(runs), strict=True):
        best = max(
            np.ndindex(*[k] * len(run)),
            key=lambda p: field.first[p[0]] + sum(run[t, s] for t, s in enumerate(p)) + sum(field.move[a, b] for a, b in zip(p, p[1:], strict=False)),
        )
        assert tuple(path) == tuple(best)


def test_field_on_fresh_rows(spark, field):
    rows = pii.labelled_words(spark, 300, seed=99).collect()
    paths = field.decode([field.scores(r.words, {}) for r in rows])
    same = [pii.STATES[a] == b for r, p in zip(rows, paths, strict=True) for a, b in zip(p, r.states, strict=True)]
    assert np.mean(same) > 0.99


def test_personal_data(spark, field):
    rows = [
        (1, "write to jan.doe (at) mail.example.org today"), (2, None), (3, ""), (None, "a.b@c.de"), (9, "call +1 (269) 555-3296 4524132264652876 now"),
        (4, "plain words " * 30_000), (5, "year 1999 and 12.5% at 10:30"), (6, "1 2 " * 2000),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' as spans", "1 as base")
    out = {(r.doc_id, len(r.base)): r for r in pii.personal_data(docs, field).collect()}
    assert len(out) == len(rows)
    assert [tuple(s) for s in out[(1, 0)].spans] == [("email", 9, 38)]
    assert out[(5, 0)].spans == [] and out[(4, 0)].spans == [] and out[(2, 0)].spans == []
    assert out[(None, 1)].base == out[(None, 1)].spans
    assert [s.kind for s in out[(9, 0)].spans] == ["card", "phone"]
    clean = {r.doc_id: r.text for r in pii.redacted(docs, field).collect()}
    assert clean[1] == "write to <email> today" and clean[2] is None and clean[None] == "<email>"
    assert pii.personal_data(docs.limit(0), field).count() == 0
    assert pii.train(pii.labelled_words(spark).limit(0)).decode([np.zeros((2, len(pii.STATES)))])[0].tolist() == [0, 0]


def test_base_spans_of_documents(spark, field):
    docs = table(spark, FOLDER, "documents")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in pii.personal_data(docs, field).collect():
        base = [tuple(s) for s in r.base]
        assert base == plain_spans(texts[r.doc_id] or "") and set(base) <= {tuple(s) for s in r.spans}


def test_quality_held_out(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    model = quality.train(docs, labels)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality.scored(docs, model).collect() if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    again = quality.train(docs, labels)
    assert np.allclose(model.weights, again.weights)


def test_quality_odd_rows(spark):
    rows = [(1, None, "a"), (1, "", "a"), (None, "words here", None), (4, "x", "b"), (5, "x " * 200_000, "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(1, 1), (None, 1), (4, None)], "doc_id bigint, quality int")
    for model in (quality.train(docs, labels), quality.train(docs, labels.limit(0)), quality.train(docs.limit(0), labels)):
        out = quality.scored(docs, model).collect()
        assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
        assert len({r.score for r in out if not r.text}) == 1
        assert quality.scored(docs.limit(0), model).count() == 0


def test_risk_is_not_negative():
    r = np.random.default_rng(0)
    good, bad = r.normal(1, 1, (400, quality.SIZE)), r.normal(-1, 1, (100, quality.SIZE))
    model = quality.fit(good[:200].astype(np.float32), np.concatenate([good[200:], bad]).astype(np.float32), 200 / 300, rounds=60)
    assert model.score(good).min() > model.score(bad).max()
