"""A publishing job reads the revisions once and keeps the newest of each page."""

import datetime as dt

from folioflow.operators import diff
from folioflow.plans import publish


def test_newest_revisions(spark):
    day = [dt.datetime(2020, 1, d) for d in (1, 2, 3)]
    rows = [("a", day[0]), ("a", day[2]), ("b", day[1]), ("b", None), ("c", None), (None, day[1])]
    revisions = spark.createDataFrame(rows, "title string, ts timestamp_ntz")
    wiki = publish.newest_revisions(spark, publish.Wiki(None, None, revisions, None))
    found = sorted(wiki.revisions.collect(), key=str)
    assert found == sorted([("a", day[2]), ("b", day[1]), ("c", None), (None, day[1])], key=str)
    assert "HashAggregate" not in wiki.revisions._jdf.queryExecution().toString()
    assert sorted(diff.latest_revision(wiki.revisions).collect(), key=str) == sorted(diff.latest_revision(revisions).collect(), key=str)
