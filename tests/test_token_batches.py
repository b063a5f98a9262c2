"""Pages are tokenized in pieces of bounded size, however many rows a batch has."""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from folioflow.functions import markup as M

TEXTS = ["<p>one</p>", None, "", "<div>" + "<i>x</i>" * 300 + "</div>", "a <br> b", *[f"<p>{i}</p>" for i in range(200)]]


def test_pieces_cover_a_batch(monkeypatch):
    monkeypatch.setattr(M, "PIECE_BYTES", 100)
    found = list(M._pieces(pa.array(TEXTS, type=pa.string()).slice(1)))
    assert [x for piece in found for x in piece.to_pylist()] == TEXTS[1:] and len(found) > 10
    assert all(len(x) for x in M._pieces(pa.array([None, "", None], type=pa.string())))
    assert sum(len(x) for x in M._pieces(pa.array([], type=pa.string()))) == 0


def test_no_piece_is_larger_than_the_bound(spark, monkeypatch):
    whole = M._tokens_of

    def bounded(html):
        held = pc.sum(pc.binary_length(html)).as_py() or 0
        if held > 100 + max(len(x or "") for x in html.to_pylist()):
            raise ValueError(f"{held} bytes at once")
        return whole(html)

    monkeypatch.setattr(M, "PIECE_BYTES", 100)
    monkeypatch.setattr(M, "_tokens_of", bounded, raising=True)
    pages = spark.createDataFrame(list(enumerate(TEXTS)), "id int, html string").coalesce(1)
    rows = pages.select("id", M.html_tokens("html").alias("tokens")).select("id", F.size("tokens"), M.render("tokens")).collect()
    expected = whole(pa.array(TEXTS, type=pa.string())).to_pylist()
    assert [(r[0], r[1], r[2]) for r in sorted(rows)] == [(i, len(x), "".join(t["raw"] for t in x)) for i, x in enumerate(expected)]
