"""The media job picks what changed from keys and times, and builds only that."""

import datetime

import pytest

from folioflow.operators import diff, media
from folioflow.plans import publish
from folioflow.sources import schemas, sinks

D = datetime.datetime
FIELDS = {f.name: None for f in schemas.SOURCE_JSON}


def record(key, number, modified, caption, **others):
    base = {**FIELDS, "creative_commons": "no", "created": "2012-01-02", "published": True, "original": "https://x.example.org/o.tif", "display": ""}
    return {**base, "id": number, "encyclopedia_id": key, "modified": modified, "caption": caption, **others}


RECORDS = [
    record("a", "1", "2012-01-05", "old"), record("a", "1", "2012-01-07", "new"), record("a", "1", "2012-01-06", "between"),
    record("b", "2", "2012-01-05", "same time, less"), record("b", "3", "2012-01-05", "same time, more"),
    record("c", "x", "nonsense", "unreadable"), record("c", None, None, "unreadable too"),
    record("d", "4", "2012-01-05", "tie"), record("d", "4", "2012-01-05", "tie"),
    record("e", "5", "2012-01-05", "unchanged"), record("", "6", "2012-01-05", "no key"), record(None, "7", "2012-01-05", "null key"),
]


def records(spark):
    return spark.createDataFrame(RECORDS, schemas.SOURCE_JSON)


def test_newest_documents_as_before(spark):
    rows = records(spark)
    whole = diff.latest_per_key(media.build_sources(rows), "encyclopedia_id", ["modified", "psms_id"])
    found = media.newest_sources(rows, media.newest_keys(rows))
    pick = lambda df: sorted([(r.encyclopedia_id, r.modified, r.psms_id) for r in df.collect() if r.encyclopedia_id is not None], key=repr)
    assert pick(found) == pick(whole)
    captions = {r.encyclopedia_id: r.caption for r in found.collect()}
    assert (captions["a"], captions["b"], captions["d"]) == ("new", "same time, more", "tie") and captions["c"].startswith("unreadable")


def test_job(spark, tmp_path):
    path = str(tmp_path / "sources")
    stored = [("e", D(2012, 1, 5)), ("a", D(2012, 1, 6)), ("gone", D(2012, 1, 1))]
    sinks.create_table(spark.createDataFrame(stored, "encyclopedia_id string, modified timestamp_ntz"), path, "encyclopedia_id")
    done = publish.publish_sources(spark, records(spark), path, apply_deletes=True)
    assert {r.encyclopedia_id for r in done.posted.collect()} == {"a", "b", "c", "d"}
    left = {r.encyclopedia_id: r.caption for r in spark.read.schema(schemas.SOURCE).parquet(path).collect()}
    assert left.keys() == {"a", "b", "c", "d", "e"} and left["a"] == "new" and left["e"] is None
    forced = publish.publish_sources(spark, records(spark), path, force=True)
    assert {r.encyclopedia_id for r in forced.posted.collect()} == {"a", "b", "c", "d", "e"}
    one = publish.publish_sources(spark, records(spark), path, source_id="b")
    assert [r.caption for r in one.posted.collect()] == ["same time, more"]


def exchanges(node, found):
    """Columns of every shuffle and broadcast of a plan, from the top."""
    if "Exchange" in node.getClass().getSimpleName():
        found.append((node, node.output().toString()))
    for i in range(node.children().size()):
        exchanges(node.children().apply(i), found)
    return found


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_texts_move_once(spark, tmp_path, threshold):
    rows = tmp_path / "records"
    records(spark).write.parquet(str(rows))
    read = spark.read.parquet(str(rows))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": threshold}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        narrow = exchanges(media.newest_keys(read)._jdf.queryExecution().executedPlan(), [])
        assert narrow and not any("caption" in columns for _, columns in narrow)
        keys = spark.createDataFrame([("a", D(2012, 1, 7), 1)], "encyclopedia_id string, modified timestamp_ntz, psms_id bigint")
        keys.write.parquet(str(tmp_path / "keys"))
        keys = spark.read.parquet(str(tmp_path / "keys"))
        plan = media.newest_sources(read, keys)._jdf.queryExecution().executedPlan()
        # Where the keys are broadcast, texts are in one shuffle, above the join: only wanted records move. Too many keys for
        # that meet the records by key, and the wanted ones are then grouped.
        wide = [node for node, columns in exchanges(plan, []) if "caption" in columns or "valueWith" in columns]
        if threshold != "-1":
            assert len(wide) == 1 and "LeftSemi" in wide[0].toString()
        else:
            assert len(wide) <= 2 and "LeftSemi" in wide[0].toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
