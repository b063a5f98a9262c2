"""The time that one page's body takes grows with its length, not with its square."""

import time

from pyspark.sql import functions as F

from folioflow.functions import markup as M
from folioflow.operators import bodies
from folioflow.settings import Site

PART = (
    '<h2><span class="mw-headline" id="s{i}">Part {i}</span><span class="mw-editsection">[e]</span></h2>'
    '<p>Text {i} <a href="/wiki/Page_{i}">x</a> &amp; more</p><p><br />\n</p><div class="alert published">y</div>'
    '<a class="image" href="/f"><img src="/thumb/s{i}.jpg/2px-s{i}.jpg"></a><a class="new" href="/n">n</a>'
)


def body_of(parts):
    box = '<div id="rgdatabox-Core" style="display:none;"><p>A:b;c\n</p></div><div id="authorByline"><a href="/a">A</a></div>'
    return box + "".join(PART.format(i=i) for i in range(parts))


def worked(spark, parts):
    """Number of tokens of a page, seconds of all steps on them, and the finished body."""
    rows = spark.createDataFrame([(body_of(parts),)], "html string")
    tokens = rows.select(M.html_tokens("html").alias("tokens"), F.array(F.lit("s1")).alias("source_ids"), F.array(F.lit("Page 3")).alias("guide")).checkpoint()
    n = tokens.select(F.size("tokens")).first()[0]
    best = None
    for _ in range(2):
        start = time.perf_counter()
        df = tokens.withColumns({"boxes": M.databoxes("tokens"), "names": M.byline_names("tokens")})
        df = bodies.clean_tokens(df, Site())
        out = df.select("boxes", "names", M.description("tokens").alias("d"), bodies.body_text("tokens").alias("body")).first()
        took = time.perf_counter() - start
        best = took if best is None else min(best, took)
    return n, best, out["body"]


def test_linear(spark):
    worked(spark, 5)
    small, big = worked(spark, 230), worked(spark, 3400)
    assert small[0] > 4_000 and big[0] > 64_000
    assert big[2].count('<div class="section"') == 3400 and "mw-editsection" not in big[2] and "<img" in big[2]
    # Sixteen times the tokens: with a square it would be 200 times the time of a page of 4,000, fixed costs aside.
    assert big[1] < 25 * max(small[1], 0.3)
