"""Personal data in long texts full of numbers: where it lies must not matter."""

from folioflow.llm import pii


def test_long_runs(spark):
    field = pii.train(pii.labelled_words(spark))
    phone, got = "call +1 269 555 3296 now", set()
    before = "12 34 "
    for n in range(124, 132):
        text = before * n + phone + " and then " + before * 300
        assert len(pii.runs_of(text)) == 1
        at = len(before) * n
        spans = pii.found_spans([text, "call +1 269 555 3296 now"], field, {})[0]
        got.add(tuple((k, a - at, b - at) for k, a, b in spans if b > at and a < at + len(phone)))
    assert len(got) == 1


def test_long_and_short_runs_together(spark, monkeypatch):
    field = pii.train(pii.labelled_words(spark))
    texts = ["call +1 (269) 555-3296 now", "12 " * 3000, "a.b (at) c.de", "nothing", "4524 1322 6465 2876 " * 200]
    alone = [pii.found_spans([t], field, {})[0] for t in texts]
    monkeypatch.setattr(pii, "GRID", 500)
    assert pii.found_spans(texts, field, {}) == alone
