import datetime
import random

import pytest
from pyspark.sql import functions as F

from folioflow.operators import diff, index, links, media, positions, topics
from folioflow.operators.citations import cite_articles
from folioflow.settings import Site
from folioflow.sources import readers

D = datetime.datetime


def test_changes_partition_the_keys(spark):
    random.seed(1)
    source = [(f"k{i}", D(2020, 1, random.randint(1, 28))) for i in random.sample(range(200), 120)]
    target = [(f"k{i}", D(2020, 1, random.randint(1, 28))) for i in random.sample(range(200), 120)]
    s = spark.createDataFrame(source, "title string, lastmod timestamp_ntz")
    t = spark.createDataFrame(target, "title string, modified timestamp_ntz")
    out = {r.title: r.change for r in diff.classify(s, t, "title").collect()}
    src, tgt = dict(source), dict(target)
    assert out == {
        k: "new" if k not in tgt else "deleted" if k not in src else "updated" if src[k] > tgt[k] else "same"
        for k in src.keys() | tgt.keys()
    }
    parts = [diff.new_keys(s, t, "title"), diff.deleted_keys(s, t, "title"), diff.updated_keys(s, t, "title")]
    for name, part in zip(("new", "deleted", "updated"), parts):
        assert {r.title for r in part.collect()} == {k for k, c in out.items() if c == name}


def test_same_time_is_no_update(spark):
    s = spark.createDataFrame([("a", D(2020, 1, 1))], "title string, lastmod timestamp_ntz")
    t = spark.createDataFrame([("a", D(2020, 1, 1))], "title string, modified timestamp_ntz")
    assert diff.classify(s, t, "title").first().change == "same"


def test_sources_updates_are_found(spark):
    s = spark.createDataFrame([("a", D(2020, 1, 2))], "encyclopedia_id string, modified timestamp_ntz")
    t = spark.createDataFrame([("a", D(2020, 1, 1))], "encyclopedia_id string, modified timestamp_ntz")
    assert diff.sources_to_update(s, t).first().change == "updated"


def test_last_record_wins(spark):
    rows = [("a", 1, "x"), ("a", 2, None), ("b", 1, "y")]
    out = diff.latest_per_key(spark.createDataFrame(rows, "k string, n int, v string"), "k", ["n"]).orderBy("k").collect()
    assert [tuple(r) for r in out] == [("a", 2, None), ("b", 1, "y")]


def test_coverage_of_nothing(spark):
    empty = spark.range(0)
    assert diff.coverage({"author": (empty, spark.range(3))}).first().ratio is None


def _many_ranges(monkeypatch):
    monkeypatch.setattr(positions, "range_partitions", lambda df: 7)


def test_neighbours_across_ranges(spark, monkeypatch):
    _many_ranges(monkeypatch)
    titles = sorted(f"t{i:04}" for i in random.sample(range(5000), 300))
    out = {r.title: (r.prev_page, r.next_page) for r in index.neighbours(spark.createDataFrame([(t,) for t in titles], "title string")).collect()}
    assert out == {t: (titles[i - 1], titles[i + 1] if i + 1 < len(titles) else "") for i, t in enumerate(titles)}


def test_one_title_is_its_own_neighbour(spark):
    row = index.neighbours(spark.createDataFrame([("only",)], "title string")).first()
    assert tuple(row) == ("only", "only", "")


def test_positions_in_hot_groups(spark, monkeypatch):
    _many_ranges(monkeypatch)
    rows = [("hot" if i % 3 else f"g{i % 30}", i) for i in random.sample(range(1000), 1000)] + [(None, 5), (None, 7)]
    df = spark.createDataFrame(rows, "g string, n int")
    out = positions.with_position(df, ["n"], ["g"], total="size").collect()
    for g in {r[0] for r in rows}:
        members = sorted(n for k, n in rows if k == g)
        assert sorted((r.n, r.pos, r["size"]) for r in out if r.g == g) == [(n, i, len(members)) for i, n in enumerate(members)]


@pytest.mark.parametrize("count, columns", [(10, 4), (9, 4), (6, 4), (1, 4), (14, 4), (7, 2)])
def test_columns_layout(spark, count, columns):
    # What a loop over a list would lay out: a column is full once it exceeds the rounded length.
    expected, column = [], []
    for i in range(count):
        column.append(i)
        if len(column) > round(count / columns):
            expected.append(column)
            column = []
    expected += [column] if column else []
    rows = index.columns_layout(spark.range(count), ["id"], columns).orderBy("id").collect()
    out = [[r.id for r in rows if r.column_no == c] for c in range(len(expected))]
    assert out == expected


def test_categories(spark):
    pages = spark.createDataFrame([("b", ["X", "In_Camp", "X"]), ("a", ["X", "Y"]), ("c", [])], "url_title string, categories array<string>")
    rows = index.pages_by_category(pages, Site().hidden_categories).orderBy("category", "pos").collect()
    assert [(r.category, r.pos, r.url_title) for r in rows] == [("X", 0, "a"), ("X", 1, "b"), ("Y", 0, "a")]
    sizes = {r.category: r.n_pages for r in index.category_sizes(pages, Site().hidden_categories).collect()}
    assert sizes == {"X": 2, "Y": 1}


def test_category_whitelist(spark):
    members = spark.createDataFrame(
        [("Articles", "Category:Arts_x", True), ("Articles", "Page", False), ("Articles", "Category:A:B", True)],
        "category string, title string, is_category boolean",
    )
    names = index.category_names(members)
    assert sorted(r[0] for r in names.collect()) == ["A", "Arts_x"]
    pages = spark.createDataFrame([("p", ["Arts x", "B", "A"])], "url_title string, categories array<string>")
    assert sorted(r.category for r in index.whitelisted_categories(pages, names).collect()) == ["A", "Arts x"]


def test_backlink_lists_go_on(spark, monkeypatch):
    _many_ranges(monkeypatch)
    edges = spark.createDataFrame([("t", f"s{i:03}") for i in range(25)] + [("u", "s")], "target string, source string")
    rows = links.backlink_lists(links.backlinks(edges), size=10).collect()
    whole = [x for r in sorted((r for r in rows if r.target == "t"), key=lambda r: r.part) for x in r.titles]
    assert whole == [f"s{i:03}" for i in range(25)] and {r.n for r in rows if r.target == "t"} == {25}
    assert [(r.part, r.n, r.titles) for r in rows if r.target == "u"] == [(0, 1, ["s"])]


def test_primary_sources(spark):
    pages = spark.createDataFrame([("p", ["b.jpg", "/thumb/x/a.jpg/20px", "no.png", "a.jpg", ""])], "url_title string, images array<string>")
    sources = spark.createDataFrame([("a",), ("b",)], "encyclopedia_id string")
    primary = links.primary_sources(pages, sources)
    assert links.source_id_lists(primary).first().source_ids == ["b", "a"]


def test_article_sides(spark):
    articles = spark.createDataFrame(
        [("A", "a", (["X", "Y"],), ["s1", "s2"])],
        "url_title string, title string, authors_data struct<display: array<string>>, source_ids array<string>",
    )
    authors = spark.createDataFrame([("X", "Author X")], "url_title string, title string")
    rows = links.article_authors(articles, authors).orderBy("pos").collect()
    assert [(r.author, r.has_document, r.author_title) for r in rows] == [("X", True, "Author X"), ("Y", False, None)]
    sources = spark.createDataFrame([("s1", "A"), ("s3", ""), ("s4", "Z")], "encyclopedia_id string, headword string")
    assert [(r.source_id, r.found) for r in links.article_sources(articles, sources).orderBy("pos").collect()] == [("s1", True), ("s2", False)]
    assert {r.encyclopedia_id: r.article for r in links.source_article(sources, articles).collect()} == {"s1": "A", "s3": None, "s4": None}


def shared_by_loop(terms, limit):
    """The plain rule: one object of each term in turn until `limit` objects or `limit` empty visits."""
    terms, out, misses = {k: list(v) for k, v in terms.items()}, [], 0
    while terms and len(out) < limit and misses < limit:
        for name, waiting in terms.items():
            if waiting and len(out) < limit:
                out.append((name, waiting.pop(0)))
            else:
                misses += 1
    return out


def test_sharing_like_a_loop(spark):
    random.seed(2)
    cases = [{f"t{j}": [f"{j}-{k}" for k in range(random.choice([0, 0, 1, 2, 5]))] for j in range(random.randint(0, 6))} for _ in range(120)]
    cases.append({"a": ["1", "2", "3"], **{f"e{i}": [] for i in range(5)}})
    terms = spark.createDataFrame(
        [(n, t, p) for n, c in enumerate(cases) for p, t in enumerate(c)], "article int, term_id string, term_pos int"
    )
    objects = spark.createDataFrame(
        [(n, t, p, o) for n, c in enumerate(cases) for t, v in c.items() for p, o in enumerate(v)],
        "article int, term_id string, pos int, obj_id string",
    )
    for limit in (0, 1, 2, 3, 7):
        rows = topics.distribute(objects, terms, limit, by=["article"]).orderBy("article", "place").collect()
        nested = topics.distribute_nested(objects, terms, limit, by=["article"]).collect()
        for n, case in enumerate(cases):
            expected = shared_by_loop(case, limit)
            assert [(r.term_id, r.obj_id) for r in rows if r.article == n] == expected
            lists = {r.term_id: r.objects for r in nested if r.article == n}
            assert lists == {t: [o for name, o in expected if name == t] for t in case}
    last = shared_by_loop(cases[-1], 2)
    one = topics.distribute(objects.filter(f"article = {len(cases) - 1}").drop("article"), terms.filter(f"article = {len(cases) - 1}").drop("article"), 2)
    assert [(r.term_id, r.obj_id) for r in one.collect()] == last == [("a", "1")]


def test_balance(spark):
    terms = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "term_id string, term_pos int")
    objects = spark.createDataFrame([("a", 0, "x"), ("a", 1, "y"), ("c", 0, "z")], "term_id string, pos int, obj_id string")
    assert [r.obj_id for r in topics.balance(objects, terms, 1).orderBy("term_pos").collect()] == ["y", "z"]
    assert topics.balance(objects, terms, 0).count() == 0


@pytest.mark.parametrize("k", [3, 1500])
def test_top_of_hot_groups(spark, k):
    rows = [("hot", i) for i in range(2000)] + [("cold", 1)]
    df = spark.createDataFrame(rows, "g string, n int")
    out = positions.top_per_group(df, ["g"], [F.desc("n")], k).collect()
    assert sorted((r.n, r["rank"]) for r in out if r.g == "hot") == sorted((1999 - i, i + 1) for i in range(k))
    assert [(r.n, r["rank"]) for r in out if r.g == "cold"] == [(1, 1)]


@pytest.mark.parametrize("start, num", [(0, 3), (2, 100), (5, 0), (0, 1)])
def test_page_slice(spark, start, num):
    published = [i % 3 != 1 for i in range(12)]
    posted, failed = [], []
    for n, shown in enumerate(published):
        if len(posted) < num and n > start:
            (posted if shown else failed).append(n)
    items = spark.createDataFrame(list(enumerate(published)), "n int, published boolean")
    rows = topics.page_slice(items, ["n"], start, num).collect()
    assert sorted(r.n for r in rows if r.posted) == posted
    assert sorted(r.n for r in rows if not r.posted) == failed


def test_terms(spark, tmp_path):
    topic = """{"id": "topics", "title": "T", "description": "D", "terms": [{"id": 7, "title": "t", "_title": "u", "description": "d",
      "path": "a: b", "ancestors": [1, 2], "children": [], "siblings": [3], "encyc_urls": ["http://x.org/Tule%20Lake/"], "parent_id": "4", "weight": ""}]}"""
    place = """{"id": "facility", "title": "F", "description": "", "terms": [{"id": "9", "title": "f", "type": "camp",
      "elinks": [{"label": "Gila", "url": "http://x.org/Gila%20River/"}], "location": {"label": "L", "geopoint": {"lat": 1.5, "lng": 2.5}}}]}"""
    (tmp_path / "topics.json").write_text(topic)
    (tmp_path / "facility.json").write_text(place)
    facets, raw = readers.read_vocab(spark, str(tmp_path))
    assert [r.id for r in topics.facets(facets).collect()] == ["facility", "topics"]
    rows = {r.id: r for r in topics.build_terms(raw).collect()}
    t, f = rows["topics-7"], rows["facility-9"]
    assert (t.parent_id, t.weight, t.ancestors, [tuple(u) for u in t.encyc_urls], t.type, t.locations) == (4, None, [1, 2], [("Tule%20Lake", "Tule Lake")], None, None)
    assert (f.type, [tuple(u) for u in f.encyc_urls], f.locations[0].geopoint.lng, f.path) == ("camp", [("Gila%20River", "Gila")], 2.5, None)
    assert [r.id for r in topics.terms(topics.build_terms(raw), "topics").collect()] == ["topics-7"]
    related = topics.article_topics(
        spark.createDataFrame([("Tule%20Lake",)], "url_title string"), topics.topics_by_url(topics.build_terms(raw)), "http://d"
    )
    assert [(r.term_id, r.ddr_topic_url) for r in related.collect()] == [("7", "http://d/7/")]


def test_media_plan_and_export(spark):
    columns = {f.name: None for f in readers.schemas.SOURCE_JSON}
    base = {**columns, "id": "5", "encyclopedia_id": "e", "published": True, "creative_commons": "no", "original_size": "", "created": "2012-01-02",
            "modified": "2012-01-02T03:04:05", "original": "https://sources.example.org/media/sources/a/o.tif", "display": "", "caption": " c "}
    records = spark.createDataFrame(
        [base, {**base, "encyclopedia_id": "f", "published": False}, {**base, "encyclopedia_id": "g", "creative_commons": "?"}],
        readers.schemas.SOURCE_JSON,
    )
    docs = media.build_sources(records)
    row = docs.filter("encyclopedia_id = 'e'").first()
    assert (row.psms_id, row.original, row.original_size, row.caption, row.transcript, row.img_path, row.creative_commons) == (
        5, "o.tif", None, "c", "", "sources/o.tif", False)
    assert sorted(r.path for r in media.transfer_plan(docs).collect()) == ["/var/www/media/sources/a/o.tif"] * 2
    export = media.export_sources(docs).filter("encyclopedia_id = 'f'").first()
    assert (export.published, export.creative_commons, export.created) == ("false", "false", "2012-01-02T00:00:00")
    assert [(r.encyclopedia_id, r.reason) for r in media.unreadable_sources(records).collect()] == [("g", "creative_commons")]


def test_citation_record(spark):
    articles = spark.createDataFrame(
        [("P", "", "cap", ([["Doe", "Ann"]],)), ("Q", "T", "cap", ([],))],
        "url_title string, title string, caption string, authors_data struct<parsed: array<array<string>>>",
    )
    rows = cite_articles(articles.withColumn("modified", F.lit(D(2020, 1, 1))), Site(default_authors="All.")).orderBy("url_title").collect()
    assert [(r.uri, r.title, r.mla) for r in rows] == [("/P/", "cap", "Doe, Ann."), ("/Q/", "T", "All.")]
    assert rows[0].lastmod and rows[0].retrieved
