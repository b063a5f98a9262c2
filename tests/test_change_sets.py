"""Change sets applied to stored tables, jobs stopped half-way, and the link index built on them."""

import datetime
import os
import random

import pytest
from folioflow.plans import build, publish
from folioflow.sources import linkindex, sinks
from test_jobs import make_authors, make_wiki, page

D = datetime.datetime
ROW = "k string, v int"


def rows_of(spark, path, schema=ROW):
    return {r.k: r.v for r in sinks.read_table(spark, path, schema).collect()}


def table_of(spark, path, n=60, buckets=70):
    sinks.create_table(spark.createDataFrame([(str(i), i) for i in range(n)], ROW), path, "k", buckets=buckets)


def files_of(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_puts_and_removals_in_one_pass(spark, tmp_path):
    path = str(tmp_path / "t")
    table_of(spark, path)
    before = files_of(path)
    put = spark.createDataFrame([("3", -3), ("new", 1), ("5", -5)], ROW)
    remove = spark.createDataFrame([("7",), ("5",), ("absent",)], "k string")
    done = sinks.apply_changes(spark, path, sinks.change_set(put, remove, ["k"]), "k", ROW)
    # A key both put and removed is gone.
    expected = {str(i): i for i in range(60) if i not in (5, 7)} | {"3": -3, "new": 1}
    assert rows_of(spark, path) == expected
    assert (done.put, done.removed) == (2, 3) and done.buckets <= 5
    # Only touched folders were written, and no change set is left beside the table.
    assert len({os.path.dirname(f) for f in before - files_of(path)}) <= 5
    assert not files_of(f"{path}/{sinks.CHANGES}")


def test_empty_and_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    table_of(spark, path, 5)
    none = spark.createDataFrame([], ROW)
    assert sinks.apply_changes(spark, path, sinks.change_set(none, None, ["k"]), "k", ROW) == sinks.Applied(0, 0, 0, 0)
    twice = spark.createDataFrame([("1", 1), ("1", 1)], ROW)
    with pytest.raises(ValueError, match="more than once"):
        sinks.apply_changes(spark, path, sinks.change_set(twice, None, ["k"]), "k", ROW)
    assert rows_of(spark, path) == {str(i): i for i in range(5)}
    with pytest.raises(ValueError):
        sinks.change_set(None, None, ["k"])
    every = spark.createDataFrame([(str(i),) for i in range(5)], "k string")
    sinks.apply_changes(spark, path, sinks.change_set(None, every, ["k"]), "k", ROW)
    assert rows_of(spark, path) == {} and not files_of(path)
    sinks.apply_changes(spark, path, sinks.change_set(spark.createDataFrame([("a", 1), (None, 2)], ROW), None, ["k"]), "k", ROW)
    assert rows_of(spark, path) == {"a": 1, None: 2}


def test_created_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.create_empty(spark, path, 6)
    assert sinks.read_table(spark, path, ROW).isEmpty() and sinks.bucket_count(spark, path) == 6
    with pytest.raises(ValueError, match="there is a table"):
        sinks.create_empty(spark, path)
    sinks.apply_changes(spark, path, sinks.change_set(spark.createDataFrame([("a", 1)], ROW), None, ["k"]), "k")
    assert rows_of(spark, path) == {"a": 1} and os.listdir(f"{path}/buckets=6")


def test_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.create_empty(spark, path, 4)
    put = lambda v: sinks.change_set(spark.createDataFrame([(None, v)], ROW), None, ["k"])
    sinks.apply_changes(spark, path, put(1), "k", ROW)
    sinks.apply_changes(spark, path, put(2), "k", ROW)
    assert sorted(r.v for r in sinks.read_table(spark, path, ROW).collect()) == [2]


@pytest.mark.parametrize("stop", ["before", "after"])
def test_a_stopped_job_is_finished_by_the_next(spark, tmp_path, monkeypatch, stop):
    path = str(tmp_path / "t")
    table_of(spark, path, 20)
    changes = sinks.change_set(spark.createDataFrame([("1", -1), ("n", 9)], ROW), spark.createDataFrame([("2",)], "k string"), ["k"])
    whole = sinks._swap_in

    def stopped(rows, *rest):
        if stop == "after":
            whole(rows, *rest)
        raise RuntimeError("stopped")

    monkeypatch.setattr(sinks, "_swap_in", stopped)
    with pytest.raises(RuntimeError):
        sinks.apply_changes(spark, path, changes, "k", ROW)
    monkeypatch.setattr(sinks, "_swap_in", whole)
    # A set that was not written in full is dropped.
    os.makedirs(f"{path}/{sinks.CHANGES}/half")
    if stop == "before":
        assert rows_of(spark, path) == {str(i): i for i in range(20)}
        assert sinks.recover(spark, path, "k", ROW) == 1
    else:
        sinks.apply_changes(spark, path, sinks.change_set(spark.createDataFrame([("m", 1)], ROW), None, ["k"]), "k", ROW)
    expected = {str(i): i for i in range(20) if i != 2} | {"1": -1, "n": 9} | ({"m": 1} if stop == "after" else {})
    assert rows_of(spark, path) == expected
    assert sinks.recover(spark, path, "k", ROW) == 0


# --- links ------------------------------------------------------------------------------------------------------------


def edges_of(spark, path):
    return {(r.target, r.source) for r in linkindex.edges_to(spark, path).collect()}


def state(spark, path, pages):
    """Refresh with pages {source: (time, targets)}."""
    current = spark.createDataFrame([(s, t) for s, (t, _) in pages.items()], "source string, lastmod timestamp_ntz")
    links = spark.createDataFrame([(s, x) for s, (_, own) in pages.items() for x in own], "source string, target string")
    return linkindex.refresh(spark, path, linkindex.changed(spark, path, current), links)


def test_index_follows_changes(spark, tmp_path):
    path = str(tmp_path / "links")
    linkindex.create(spark, path, 16)
    draw = random.Random(3)
    # One target has a third of all links.
    pages = {f"p{i}": (D(2020, 1, 1), {"Hub"} | {f"t{draw.randrange(9)}" for _ in range(2)}) for i in range(60)}
    pages["none"] = (None, {"Hub", "t1"})
    pages["repeats"] = (D(2020, 1, 1), ["t1", "t1", None])
    state(spark, path, pages)
    true = lambda: {(x, s) for s, (_, own) in pages.items() for x in own if x}
    assert edges_of(spark, path) == true()
    before = files_of(f"{path}/edges")
    hub = {os.path.dirname(f) for f in before}
    pages["p1"] = (D(2020, 1, 2), {"t1", "other"})
    pages["p2"] = (D(2019, 1, 2), {"late"})  # older than what is there: passed over
    kept = dict(pages, p2=(D(2020, 1, 1), {x for x, s in edges_of(spark, path) if s == "p2"}))
    gone = pages.pop("p3")[1]
    kept.pop("p3")
    moved = {(r.target, r.source, r.op) for r in state(spark, path, pages).collect()}
    pages = kept
    assert edges_of(spark, path) == true()
    assert {m for m in moved if m[1] == "p3"} == {(x, "p3", "remove") for x in gone} and not any(m[1] == "p2" for m in moved)
    # Only the folders of what moved were written again; the hub's other parts were not.
    assert len(hub - {os.path.dirname(f) for f in before - files_of(f"{path}/edges")}) >= len(hub) - len(moved)
    wanted = spark.createDataFrame([("Hub",), ("Hub",), ("nobody",)], "target string")
    found = linkindex.titles(spark, path, wanted).collect()
    own = sorted(s for x, s in true() if x == "Hub")
    assert sorted((r.pos, r.source) for r in found) == list(enumerate(own))
    assert state(spark, path, pages).isEmpty()


def test_reading_some_targets_reads_their_folders(spark, tmp_path):
    path = str(tmp_path / "links")
    linkindex.create(spark, path, 64)
    state(spark, path, {f"p{i}": (D(2020, 1, 1), [f"t{i % 40}", "Hub"]) for i in range(200)})
    read = linkindex.edges_to(spark, path, spark.createDataFrame([("t7",)], "target string"))
    assert {r.source for r in read.collect()} == {f"p{i}" for i in range(7, 200, 40)}
    filters = read._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert filters.startswith("bucket#") and len(filters.split(",")) <= linkindex.SOURCE_PARTS + 2
    # The hub's links are spread over all its folders.
    hub = sinks.read_buckets(spark, f"{path}/edges", linkindex.EDGES).filter("target = 'Hub'")
    assert hub.select("bucket").distinct().count() == linkindex.SOURCE_PARTS


def author_wiki(spark, tmp_path, links, times):
    pages = [page(t, links=own) for t, own in links.items()]
    members = [("Published", t, False) for t in links] + [("Authors", a, False) for a in ("Ann", "Bob")]
    return make_wiki(spark, tmp_path, pages, members, list(times.items()))


def test_author_job_with_index(spark, tmp_path, monkeypatch):
    links = {"Ann": [], "Bob": ["Ann"], **{f"P{i}": ["Ann"] for i in range(8)}}
    times = {t: D(2020, 1, 1) for t in links}
    path, index = make_authors(spark, tmp_path), str(tmp_path / "links")
    linkindex.create(spark, index, 16)
    done = publish.publish_authors(spark, author_wiki(spark, tmp_path, links, times), path, links_path=index)
    assert {(r.url_title, r.n_articles, len(r.article_titles)) for r in done.posted.collect()} == {("Ann", 9, 0), ("Bob", 0, 0)}
    # A page turns from Ann to Bob: neither author page changed, both documents are made anew. The job is stopped once.
    links["P3"], times["P3"] = ["Bob", "Bob"], D(2020, 2, 1)
    now = author_wiki(spark, tmp_path, links, times)
    whole = build.build_authors

    def stopped(*args, **kwargs):
        raise RuntimeError("stopped")

    monkeypatch.setattr(build, "build_authors", stopped)
    with pytest.raises(RuntimeError):
        publish.publish_authors(spark, now, path, links_path=index)
    monkeypatch.setattr(build, "build_authors", whole)
    done = publish.publish_authors(spark, now, path, links_path=index)
    assert {(r.url_title, r.n_articles) for r in done.posted.collect()} == {("Ann", 8), ("Bob", 1)}
    assert publish.publish_authors(spark, now, path, links_path=index).posted.isEmpty()
    found = linkindex.titles(spark, index, spark.createDataFrame([("Ann",), ("Bob",)], "target string")).collect()
    assert sorted((r.target, r.source) for r in found if r.target == "Bob") == [("Bob", "P3")]
    # A dry run leaves the index alone.
    links["P4"], times["P4"] = [], D(2020, 3, 1)
    publish.publish_authors(spark, author_wiki(spark, tmp_path, links, times), path, links_path=index, dryrun=True)
    assert ("Ann", "P4") in edges_of(spark, index)


def test_neighbours_of_unchanged_pages(spark, tmp_path):
    """Pages come and go between unchanged ones: the stored links are those of a full build, and only rows beside a change are written."""
    names = [f"P{i:02}" for i in range(0, 40, 2)]

    def at(titles, times=None):
        pages = [page(t) for t in titles]
        members = [("Published", t, False) for t in titles]
        return make_wiki(spark, tmp_path / str(len(titles)), pages, members, [(t, (times or {}).get(t, D(2020, 1, 1))) for t in titles])

    def links_of(path):
        return {r.url_title: (r.prev_page, r.next_page) for r in sinks.read_table(spark, path, publish.LINKS).collect()}

    path = str(tmp_path / "articles")
    sinks.create_empty(spark, path, 64)
    publish.publish_articles(spark, at(names), path)
    later = sorted([n for n in names if n != "P10"] + ["P21", "P99"])
    wiki = at(later, {"P30": D(2020, 5, 1)})
    done = publish.publish_articles(spark, wiki, path, apply_deletes=True, relink=True)
    assert {r.url_title for r in done.posted.collect()} == {"P21", "P99", "P30"}
    # Beside the deleted, the added and the last page, and the first, whose neighbour is the last.
    assert {r.url_title for r in done.relinked.collect()} == {"P08", "P12", "P20", "P22", "P38", "P00"}
    whole = build.build_articles(wiki.pages, wiki.members, wiki.revisions, wiki.sources)
    assert links_of(path) == {r.url_title: (r.prev_page, r.next_page) for r in whole.collect()}
    again = publish.publish_articles(spark, wiki, path, apply_deletes=True, relink=True)
    assert again.relinked.isEmpty() and again.posted.isEmpty()
    bodies = {r.url_title: r.body for r in sinks.read_table(spark, path, "url_title string, body string").collect()}
    assert len(set(bodies.values())) == 1 and None not in bodies.values()
