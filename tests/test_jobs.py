import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from folioflow.operators import links
from folioflow.plans import build, publish
from folioflow.settings import Site
from folioflow.sources import readers, schemas, sinks
from folioflow.streaming import refresh

D = datetime.datetime


def page(title, categories=("Published",), html="<p>Text.</p>", links=(), images=()):
    named = lambda names: [{"*": n} for n in names]
    return (
        title,
        json.dumps({"parse": {"displaytitle": title, "categories": named(categories), "links": named(links), "images": list(images),
                              "properties": [{"name": "defaultsort", "*": ""}], "text": {"*": html}}}),
    )


BOXED = """<div id="rgdatabox-Core" style="display:none;"><p>RGMediaType:books;
Title: X</p></div><div id="databox-Camps"><p>GISLat: 38.05; GISLng: -102.3;</p></div>
<div id="authorByline"><b><a href="/Ann">Ann Doe</a></b></div><div id="citationAuthor" style="display:none;">Doe, Ann</div>
<p>First <a href="/wiki/Tule_Lake">lake</a>.</p><a class="image" href="/f"><img src="/thumb/s1.jpg/20px-s1.jpg"></a>"""


def make_wiki(spark, tmp_path, pages, members, revisions):
    rows = spark.createDataFrame(pages, "url_title string, json string")
    path = str(tmp_path / "raw")
    rows.write.mode("overwrite").json(path)
    fields = {f.name: None for f in schemas.SOURCE_JSON}
    sources = spark.createDataFrame([{**fields, "id": "1", "encyclopedia_id": "s1"}], schemas.SOURCE_JSON)
    return publish.Wiki(
        readers.read_pages(spark, path),
        spark.createDataFrame(members, schemas.CATEGORY_MEMBERS),
        spark.createDataFrame(revisions, schemas.REVISIONS),
        sources,
    )


@pytest.fixture(scope="module")
def wiki(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("wiki")
    pages = [
        page("Amache", ("Published", "Camps", "Other"), BOXED, ["Ann"], ["s1.jpg", "x.jpg"]),
        page("Ann", links=["Amache"]),
        page("Poston", html='<p>P</p><div class="nopublish-encycfront">x</div>', links=["Ann"]),
        page("Draft", ("Camps",)),
        ("Gone", json.dumps({"error": {"code": "missingtitle"}})),
    ]
    members = [("Published", t, False) for t in ("Amache", "Ann", "Poston", "Gone")] + [
        ("Published", "Category:Camps", True), ("Authors", "Ann", False), ("Articles", "Category:Camps", True)]
    revisions = [(t, D(2020, 1, d)) for t in ("Amache", "Ann", "Poston", "Gone", "Draft") for d in (1, 5)]
    return make_wiki(spark, tmp, pages, members, revisions)


def test_build_articles(spark, wiki):
    rows = {r.url_title: r for r in build.build_articles(wiki.pages, wiki.members, wiki.revisions, wiki.sources, ["Tule Lake"]).collect()}
    assert set(rows) == {"Amache", "Ann", "Poston", "Draft"}
    a = rows["Amache"]
    assert (a.published, a.published_encyc, a.published_rg, a.modified, a.mw_api_url, a.title_sort) == (True, True, True, D(2020, 1, 5), "/Amache/", "amache")
    assert (a.categories, a.source_ids, tuple(a.coordinates)) == (["Camps"], ["s1"], (-102.3, 38.05))
    assert (a.authors_data.display, a.authors_data.parsed) == (["Ann Doe"], [["Doe", "Ann"]])
    assert (a.databoxes, a.rg_rgmediatype, a.rg_title, a.rg_genre) == (
        ['rgdatabox-Core|{"rgmediatype":["books"],"title":" X"}'], ["books"], [" X"], None)
    assert 'class="encyc rg"' in a.body and "s1.jpg" not in a.body and a.body.endswith("</div>")
    # Neighbours run over published pages that are no authors, including one without a record.
    assert (a.prev_page, a.next_page) == ("Poston", "Gone")
    assert (rows["Ann"].prev_page, rows["Ann"].next_page, rows["Poston"].published_encyc) == ("", "", False)
    draft = rows["Draft"]
    assert (draft.published, draft.description, draft.categories, draft.prev_page, draft.authors_data.display) == (False, None, [], None, [])


def test_build_articles_with_guide_table(spark, wiki):
    guide = spark.createDataFrame([("Tule Lake",)], "id string")
    by_table = build.build_articles(wiki.pages, wiki.members, wiki.revisions, wiki.sources, guide)
    by_list = build.build_articles(wiki.pages, wiki.members, wiki.revisions, wiki.sources, ["Tule Lake"])
    body = lambda df: {r.url_title: r.body for r in df.select("url_title", "body").collect()}
    assert body(by_table) == body(by_list)


def test_build_authors(spark, wiki):
    rows = build.build_authors(wiki.pages, wiki.members, wiki.revisions, wiki.sources, build.page_links(wiki.pages)).collect()
    assert [(r.url_title, r.article_titles, r.n_articles, r.modified) for r in rows] == [("Ann", ["Amache", "Poston"], 2, D(2020, 1, 5))]


def stored(spark, path):
    return {r.url_title: r.modified for r in spark.read.schema(schemas.ARTICLE).parquet(path).collect()}


def old_table(spark, path):
    rows = [("Amache", "Amache", D(2020, 1, 1)), ("Poston", "Poston", D(2020, 1, 5)), ("Old", "Old", D(2019, 1, 1)), ("Draft", "Draft", D(2019, 1, 1))]
    sinks.create_table(spark.createDataFrame(rows, "url_title string, title string, modified timestamp_ntz"), path, "url_title")


def test_publish_articles(spark, wiki, tmp_path):
    path = str(tmp_path / "articles")
    old_table(spark, path)
    dry = publish.publish_articles(spark, wiki, path, dryrun=True)
    assert {r.title: r.change for r in dry.changes.collect()} == {"Amache": "updated", "Poston": "same", "Old": "deleted", "Draft": "deleted", "Gone": "new"}
    assert stored(spark, path)["Amache"] == D(2020, 1, 1)
    done = publish.publish_articles(spark, wiki, path)
    assert [r.url_title for r in done.posted.collect()] == ["Amache"]
    assert [r.url_title for r in done.could_not_post.collect()] == ["Gone"]
    assert done.errors.count() == 0
    assert stored(spark, path) == {"Amache": D(2020, 1, 5), "Poston": D(2020, 1, 5), "Old": D(2019, 1, 1), "Draft": D(2019, 1, 1)}
    again = publish.publish_articles(spark, wiki, path)
    assert again.posted.count() == 0
    # Forced, every stored title is worked on: the draft is not publishable and leaves the table.
    forced = publish.publish_articles(spark, wiki, path, force=True)
    assert [r.url_title for r in forced.unpublished.collect()] == ["Draft"]
    assert set(stored(spark, path)) == {"Amache", "Poston", "Old"}
    one = publish.publish_articles(spark, wiki, path, title="Draft", site=Site(show_unpublished=True))
    assert [r.url_title for r in one.posted.collect()] == ["Draft"]
    publish.publish_all(spark, wiki, make_authors(spark, tmp_path), path)
    assert set(stored(spark, path)) == {"Amache", "Poston"}


def make_authors(spark, tmp_path):
    path = str(tmp_path / "authors")
    sinks.create_table(spark.createDataFrame([], "url_title string, title string, modified timestamp_ntz"), path, "url_title")
    return path


def test_publish_authors(spark, wiki, tmp_path):
    path = make_authors(spark, tmp_path)
    done = publish.publish_authors(spark, wiki, path)
    assert [r.url_title for r in done.posted.collect()] == ["Ann"]
    row = spark.read.schema(schemas.AUTHOR).parquet(path).first()
    assert (row.url_title, row.article_titles) == ("Ann", ["Amache", "Poston"])


def test_publish_sources(spark, tmp_path):
    fields = {f.name: None for f in schemas.SOURCE_JSON}
    base = {**fields, "creative_commons": "no", "created": "2012-01-02", "modified": "2012-01-05", "published": True,
            "original": "https://sources.example.org/media/sources/o.tif", "display": ""}
    records = spark.createDataFrame(
        [{**base, "id": "1", "encyclopedia_id": "new"}, {**base, "id": "2", "encyclopedia_id": "old", "published": False},
         {**base, "id": "3", "encyclopedia_id": ""}, {**base, "id": "4", "encyclopedia_id": "same"}],
        schemas.SOURCE_JSON,
    )
    path = str(tmp_path / "sources")
    rows = [("old", D(2012, 1, 1)), ("same", D(2012, 1, 5)), ("lost", D(2012, 1, 1))]
    sinks.create_table(spark.createDataFrame(rows, "encyclopedia_id string, modified timestamp_ntz"), path, "encyclopedia_id")
    files = spark.createDataFrame([("/var/www/media/sources/o.tif",)], schemas.MEDIA_FILES)
    done = publish.publish_sources(spark, records, path, files, apply_deletes=True)
    assert [r.encyclopedia_id for r in done.posted.collect()] == ["new"]
    assert [r.encyclopedia_id for r in done.unpublished.collect()] == ["old"]
    assert [(r.path, r.present) for r in done.transfers.collect()] == [("/var/www/media/sources/o.tif", True)]
    left = spark.read.schema(schemas.SOURCE).parquet(path).select("encyclopedia_id").collect()
    assert sorted(r[0] for r in left) == ["new", "same"]


def test_sink_keeps_columns_and_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.create_table(spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit("old").alias("v")), path, "k", buckets=4)
    sinks.save_docs(spark, path, spark.createDataFrame([("5", 1), ("x", 2)], "k string, n int"), "k")
    rows = {r.k: (r.v, r.n) for r in sinks.read_table(spark, path).collect()}
    assert len(rows) == 101 and rows["5"] == (None, 1) and rows["6"] == ("old", None) and rows["x"] == (None, 2)
    with pytest.raises(ValueError):
        sinks.remove_docs(spark, path, spark.createDataFrame([("6",)], "k string"), "k")
    gone = spark.range(100).select(F.col("id").cast("string").alias("k")).filter("k <> '5'")
    sinks.remove_docs(spark, path, gone, "k", confirm=True)
    assert sorted(r.k for r in sinks.read_table(spark, path).collect()) == ["5", "x"]
    assert os.listdir(path + "/buckets=4")
    sinks.remove_docs(spark, path, spark.createDataFrame([("5",), ("x",)], "k string"), "k", confirm=True)
    assert sinks.read_table(spark, path, "k string").count() == 0
    sinks.save_docs(spark, path, spark.createDataFrame([("z", 1)], "k string, n int"), "k")
    assert sinks.read_table(spark, path).first().k == "z"


def test_listing_and_lookup(spark):
    docs = spark.createDataFrame(
        [("a", D(2020, 1, 1), "long", ["x"], "hidden"), ("b", D(2020, 1, 2), "long", ["y"], "hidden")],
        "url_title string, modified timestamp_ntz, body string, categories array<string>, extra string",
    )
    assert "extra" not in readers.list_docs(docs).columns and readers.list_docs(docs, limit=1).count() == 1
    assert [r.url_title for r in readers.search_docs(docs, {"categories": ["y", "z"], "extra": "no"}).collect()] == ["b"]
    found = readers.get_doc(docs, "url_title", "a").first()
    assert found.modified == "2020-01-01T00:00:00" and "body" not in found.asDict()
    assert readers.get_document({"article": docs}, "article", "a", body=True).first().body == "long"
    assert "error" in readers.get_document({}, "comic", "a")


def test_csv_slice(spark, tmp_path):
    for name, rows in (("a", range(5)), ("b", range(5, 9))):
        text = '"id","note"\n' + "".join(f'"{i}","line ""{i}""\nnext, x"\n' for i in rows)
        (tmp_path / f"{name}.csv").write_text(text)
    whole = readers.read_csv(spark, str(tmp_path))
    assert sorted((r.id, r.note) for r in whole.collect())[0] == ("0", 'line "0"\nnext, x')
    part = readers.read_csv(spark, str(tmp_path), 3, 7)
    assert sorted(r.id for r in part.collect()) == ["3", "4", "5", "6"]


def test_refresh_stream_in_batches(spark, tmp_path):
    path, folder = str(tmp_path / "target"), tmp_path / "revisions"
    sinks.create_table(spark.createDataFrame([("a", D(2020, 1, 3))], "title string, modified timestamp_ntz"), path, "title")
    batches = [[("a", D(2020, 1, 1)), ("b", D(2020, 1, 1))], [("b", D(2020, 1, 5)), ("b", D(2020, 1, 4))], [("b", D(2020, 1, 2)), ("c", D(2020, 1, 1))]]
    for rows in batches:
        spark.createDataFrame(rows, schemas.REVISIONS).coalesce(1).write.mode("append").parquet(str(folder))
    for _ in range(2):  # the second run finds nothing new
        stream = refresh.revision_stream(spark, str(folder), schemas.REVISIONS, max_files=1)
        refresh.refresh_stream(stream, path, str(tmp_path / "checkpoint")).awaitTermination()
        rows = {r.title: r.modified for r in sinks.read_table(spark, path).collect()}
        assert rows == {"a": D(2020, 1, 3), "b": D(2020, 1, 5), "c": D(2020, 1, 1)}
    refresh.refresh_batch(spark, spark.createDataFrame(batches[1], schemas.REVISIONS), path)
    assert {r.title: r.modified for r in sinks.read_table(spark, path).collect()} == rows


def test_display_titles_are_for_show(spark, wiki, tmp_path):
    """A page whose display title has markup is found again by its key: posted once, then the same."""
    shown = wiki.pages.withColumn("title", F.concat(F.lit("<i>"), "title", F.lit("</i>")))
    other = publish.Wiki(shown, wiki.members, wiki.revisions, wiki.sources)
    row = build.build_articles(shown, wiki.members, wiki.revisions, wiki.sources).filter("url_title = 'Amache'").first()
    assert (row.title, row.prev_page, row.categories) == ("<i>Amache</i>", "Poston", ["Camps"])
    authors = build.build_authors(shown, wiki.members, wiki.revisions, wiki.sources, build.page_links(shown)).collect()
    assert [(r.url_title, r.article_titles) for r in authors] == [("Ann", ["Amache", "Poston"])]
    path, author_path = str(tmp_path / "articles"), make_authors(spark, tmp_path)
    sinks.create_table(spark.createDataFrame([], "url_title string, title string, modified timestamp_ntz"), path, "url_title")
    for turn in range(2):
        _, articles = publish.publish_all(spark, other, author_path, path)
        assert articles.posted.count() == (2 if turn == 0 else 0) and articles.errors.count() == 0
        assert set(stored(spark, path)) == {"Amache", "Poston"}
    assert {r.title: r.change for r in articles.changes.collect()} == {"Amache": "same", "Poston": "same", "Gone": "new"}


def test_repeated_keys_and_existing_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("1", 1), ("2", 1)], "k string, v int")
    sinks.create_table(rows, path, "k", buckets=4)
    with pytest.raises(ValueError, match="there is a table"):
        sinks.create_table(rows, path, "k", buckets=8)
    twice = spark.createDataFrame([("1", 2), ("1", 3), ("3", 1)], "k string, v int")
    with pytest.raises(ValueError, match="repeat"):
        sinks.save_docs(spark, path, twice, "k")
    sinks.save_docs(spark, path, twice, "k", newest_by=["v"])
    assert {r.k: r.v for r in sinks.read_table(spark, path).collect()} == {"1": 3, "2": 1, "3": 1}
    assert sinks.read_table(spark, path).count() == 3


def test_lists_are_whole(spark):
    edges = spark.createDataFrame([("Hub", f"p{i:03}") for i in range(105)] + [("Other", "x")], "target string, source string")
    lists = {r.target: r for r in links.whole_lists(links.backlink_lists(edges, size=10)).collect()}
    assert lists["Hub"].titles == [f"p{i:03}" for i in range(105)] and lists["Hub"].n == 105
    rows = links.author_titles(edges).filter("target = 'Hub'").collect()
    assert sorted((r.pos, r.source) for r in rows) == [(i, f"p{i:03}") for i in range(105)]


def test_only_changed_records_are_parsed(spark, wiki):
    raw = spark.createDataFrame([page("Amache"), page("Poston"), page("Old")], "url_title string, json string")
    keys = spark.createDataFrame([("Poston",)], "url_title string")
    parsed = publish.changed_pages(raw, keys)
    assert [r.url_title for r in parsed.collect()] == ["Poston"]
    # What is parsed is a checkpoint of the chosen records: no join and no other record below the parsing.
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" in plan and "Join" not in plan


def test_jobs_from_raw_records(spark, wiki, tmp_path):
    raw = spark.createDataFrame([page("Amache"), page("Poston")], "url_title string, json string")
    with_raw = publish.Wiki(readers.parse_pages(raw), wiki.members, wiki.revisions, wiki.sources, raw)
    without = publish.Wiki(with_raw.pages, wiki.members, wiki.revisions, wiki.sources)
    found = []
    for k, own in enumerate((with_raw, without)):
        path = str(tmp_path / f"articles{k}")
        sinks.create_table(spark.createDataFrame([], "url_title string, title string, modified timestamp_ntz"), path, "url_title")
        publish.publish_articles(spark, own, path)
        found.append(sorted(spark.read.schema(schemas.ARTICLE).parquet(path).select("url_title", "body", "modified").collect()))
    assert found[0] == found[1] and found[0]
