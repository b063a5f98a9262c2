"""Whole jobs: building documents, publishing them, refreshing from a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.operators import diff, links
from folioflow.plans import build, publish
from folioflow.session import work_dir
from folioflow.sources import linkindex, schemas, sinks
from folioflow.streaming import refresh
from workload import media, topics, wiki
from workload.registry import query, table


@query("build_articles", wiki.WIKI + " SELECT * FROM art")
def build_articles(spark, sf):
    w = wiki.wiki(spark, sf)
    return wiki.light(build.build_articles(w.pages, w.members, w.revisions, w.sources))


@query("article_bodies")
def article_bodies(spark, sf):
    w = wiki.wiki(spark, sf)
    rows = build.build_articles(w.pages, w.members, w.revisions, w.sources)
    return rows.select("url_title", "description", "body")


AUTHORS = wiki.WIKI + r""",
  l AS (SELECT DISTINCT 'Page_' || page_id AS source, 'Page_' || (page_id + length(h)) AS target
        FROM (SELECT page_id, regexp_extract(html, 'lang="([a-z]+)"', 1) AS lang, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS h FROM pages)
        WHERE lang <> 'es')
"""


def linked(spark, sf, w):
    """Link edges that lead to other pages of the wiki."""
    edges = build.page_links(w.pages).withColumn("n", F.substring_index("source", "_", -1).cast("int") + F.length("target") + 1)
    return links.backlinks(edges.select("source", F.concat(F.lit("Page_"), "n").alias("target")))


@query(
    "build_authors",
    AUTHORS + """SELECT a.url_title, a.published, a.modified, a.title_sort, coalesce(string_agg(source, '|' ORDER BY source), '') AS article_titles,
                        count(source) AS n_articles
                 FROM art a LEFT JOIN l ON target = a.url_title WHERE a.url_title IN (SELECT title FROM auth) GROUP BY ALL""",
)
def build_authors(spark, sf):
    w = wiki.wiki(spark, sf)
    rows = build.build_authors(w.pages, w.members, w.revisions, w.sources, linked(spark, sf, w))
    return rows.select(
        "url_title", "published", "modified", "title_sort", F.array_join("article_titles", "|").alias("article_titles"), "n_articles"
    )


def stored_pages(spark, sf, path):
    """A published table that is behind the wiki: what was there before 2000, and one page of its own."""
    old = diff.latest_revision(wiki.revisions(spark, sf).filter("ts < timestamp_ntz '2000-01-01 00:00:00'"))
    rows = old.select(F.col("title").alias("url_title"), "title", F.col("lastmod").alias("modified"))
    sinks.create_table(rows, path, "url_title")


@query(
    "publish_articles",
    wiki.WIKI + """, old AS (SELECT 'Page_' || o_custkey AS title, max(o_orderdate) AS modified FROM orders
                              WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1),
         todo AS (SELECT pub.title FROM pub JOIN rev USING (title) LEFT JOIN old USING (title)
                  WHERE title NOT IN (SELECT title FROM auth) AND (modified IS NULL OR lastmod > modified)),
         w AS (SELECT * FROM art WHERE url_title IN (SELECT title FROM todo))
       SELECT url_title, modified, title_sort, next_page FROM w WHERE published
       UNION ALL SELECT title, modified, NULL, NULL FROM old WHERE title NOT IN (SELECT url_title FROM w)""",
)
def publish_articles(spark, sf):
    path = work_dir(spark, "article-table")
    stored_pages(spark, sf, path)
    publish.publish_articles(spark, wiki.wiki(spark, sf), path)
    return spark.read.schema(schemas.ARTICLE).parquet(path).select("url_title", "modified", "title_sort", "next_page")


@query("publish_neighbours", wiki.WIKI + " SELECT title AS url_title, prev_page, next_page FROM az")
def publish_neighbours(spark, sf):
    """Neighbours in the whole stored table after a job that worked on a part of its pages."""
    path = work_dir(spark, "article-table")
    stored_pages(spark, sf, path)
    publish.publish_articles(spark, wiki.wiki(spark, sf), path, apply_deletes=True, relink=True)
    return sinks.read_table(spark, path, publish.LINKS)


@query(
    "publish_authors",
    wiki.WIKI + """, old AS (SELECT 'Page_' || o_custkey AS title, max(o_orderdate) AS modified FROM orders
                              WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1),
         src AS (SELECT title, lastmod FROM pub JOIN rev USING (title) WHERE title IN (SELECT title FROM auth))
       SELECT url_title, a.modified, title_sort FROM art a JOIN src s ON s.title = url_title LEFT JOIN old o ON o.title = url_title
       WHERE o.modified IS NULL OR lastmod > o.modified
       UNION ALL SELECT title, o.modified, NULL FROM old o JOIN src s USING (title) WHERE NOT lastmod > o.modified""",
)
def publish_authors(spark, sf):
    path = work_dir(spark, "author-table")
    stored_pages(spark, sf, path)
    publish.publish_authors(spark, wiki.wiki(spark, sf), path, apply_deletes=True)
    return spark.read.schema(schemas.AUTHOR).parquet(path).select("url_title", "modified", "title_sort")


def linked_wiki(spark, sf):
    """The wiki with links that lead to its own pages."""
    w = wiki.wiki(spark, sf)
    number = F.substring_index("url_title", "_", -1).cast("int")
    own = F.transform("links", lambda x: F.struct(x["ns"].alias("ns"), F.concat(F.lit("Page_"), number + F.length(x["*"]) + 1).alias("*")))
    return publish.newest_revisions(spark, publish.Wiki(w.pages.withColumn("links", own), w.members, w.revisions, w.sources))


def older_links(spark, sf, w, path):
    """A link index that is behind: a third of the pages had other links, a third is not in it, and pages that are gone are."""
    third = F.pmod(F.substring_index("source", "_", -1).cast("int"), F.lit(3))
    edges = build.page_links(w.pages).filter(third < 2)
    shifted = F.concat(F.lit("Page_"), F.substring_index("target", "_", -1).cast("int") + 1)
    edges = edges.withColumn("target", F.when(third == 0, shifted).otherwise(F.col("target")))
    gone = w.members.filter("category = 'Authors'").select(F.concat(F.lit("Gone_"), "title").alias("source"), F.col("title").alias("target"))
    keys = w.pages.select(F.col("url_title").alias("source")).filter(third < 2)
    newest = diff.latest_revision(w.revisions).withColumnRenamed("title", "source")
    old = F.lit("1899-01-01 00:00:00").cast("timestamp_ntz")
    current = keys.join(newest, "source", "left").withColumn("lastmod", F.when(third == 0, old).otherwise(F.col("lastmod")))
    linkindex.create(spark, path, buckets=16)
    current = current.unionByName(gone.select("source", old.alias("lastmod")))
    linkindex.refresh(spark, path, linkindex.changed(spark, path, current), edges.unionByName(gone))


@query(
    "author_titles",
    AUTHORS + """SELECT target, row_number() OVER (PARTITION BY target ORDER BY source) - 1 AS pos, source FROM l
                 WHERE target IN (SELECT title FROM pub WHERE title IN (SELECT title FROM auth))""",
)
def author_titles(spark, sf):
    """Who links to each published author, from a link index that the author job keeps up to date."""
    path, links_path = work_dir(spark, "author-table"), work_dir(spark, "link-index")
    w = linked_wiki(spark, sf)
    stored_pages(spark, sf, path)
    older_links(spark, sf, w, links_path)
    publish.publish_authors(spark, w, path, apply_deletes=True, links_path=links_path)
    return linkindex.titles(spark, links_path, sinks.read_table(spark, path, "url_title string").withColumnRenamed("url_title", "target"))


@query(
    "author_link_counts",
    AUTHORS + """SELECT p.title AS url_title, count(source) AS n_articles FROM pub p LEFT JOIN l ON target = p.title
                 WHERE p.title IN (SELECT title FROM auth) GROUP BY 1""",
)
def author_link_counts(spark, sf):
    """Author documents made from the link index: they hold the number of titles and no list."""
    path, links_path = work_dir(spark, "author-table"), work_dir(spark, "link-index")
    w = linked_wiki(spark, sf)
    sinks.create_empty(spark, path)
    older_links(spark, sf, w, links_path)
    publish.publish_authors(spark, w, path, links_path=links_path)
    return sinks.read_table(spark, path, "url_title string, n_articles bigint")


SOURCES = media.STORED + """, old AS (SELECT encyclopedia_id, CASE WHEN display = '' THEN modified ELSE modified - INTERVAL 1 DAY END AS modified
                                       FROM src WHERE original <> ''),
  todo AS (SELECT s.encyclopedia_id FROM src s LEFT JOIN old o USING (encyclopedia_id) WHERE o.modified IS NULL OR s.modified > o.modified)"""


def publish_sources_job(spark, sf):
    path = work_dir(spark, "source-table")
    built = media.media.build_sources(media.records(spark, sf))
    stale = F.when(F.col("display") == "", F.col("modified")).otherwise(F.col("modified") - F.expr("interval 1 day"))
    old = built.filter("original <> ''").select("encyclopedia_id", stale.alias("modified"))
    sinks.create_table(old, path, "encyclopedia_id")
    return path, publish.publish_sources(spark, media.records(spark, sf), path)


@query(
    "publish_sources",
    SOURCES + """ SELECT encyclopedia_id, modified, original FROM src WHERE published AND encyclopedia_id IN (SELECT * FROM todo)
                  UNION ALL SELECT encyclopedia_id, modified, NULL FROM old WHERE encyclopedia_id NOT IN (SELECT * FROM todo)""",
)
def publish_sources(spark, sf):
    path, _ = publish_sources_job(spark, sf)
    return spark.read.schema(schemas.SOURCE).parquet(path).select("encyclopedia_id", "modified", "original")


@query(
    "publish_vocabs",
    """SELECT CASE WHEN o_orderstatus = 'F' THEN 'facility-' ELSE 'topics-' END || o_orderkey AS id,
              CASE WHEN o_orderstatus = 'F' THEN 'facility' ELSE 'topics' END AS facet_id, 'Order ' || o_orderkey AS title FROM orders
       UNION ALL SELECT v, v, 'Vocabulary' FROM (VALUES ('facility'), ('topics')) t(v)""",
)
def publish_vocabs(spark, sf):
    facet_path, term_path = work_dir(spark, "facet-table"), work_dir(spark, "term-table")
    raw = topics.vocab(spark, sf)
    facets = raw.select(F.col("facet_id").alias("id"), F.lit("Vocabulary").alias("title"), F.lit("all").alias("description")).distinct()
    sinks.create_table(facets.limit(0), facet_path, "id")
    sinks.create_table(publish.build_terms(raw).limit(0), term_path, "id")
    publish.publish_vocabs(spark, facets, raw, facet_path, term_path)
    terms = spark.read.schema(schemas.FACETTERM).parquet(term_path).select("id", "facet_id", "title")
    heads = spark.read.schema(schemas.FACET).parquet(facet_path)
    return terms.unionByName(heads.select("id", F.col("id").alias("facet_id"), "title"))


@query(
    "publish_status",
    wiki.WIKI + """, c AS (SELECT 'author' AS doctype, (SELECT count(*) FROM supplier) AS stored, (SELECT count(*) FROM auth) AS total
                           UNION ALL SELECT 'article', (SELECT count(*) FROM documents), (SELECT count(*) FROM pub)
                           UNION ALL SELECT 'source', (SELECT count(*) FROM part), 0)
       SELECT doctype, stored, total, round(CASE WHEN total > 0 THEN stored::DOUBLE / total END, 6) AS ratio FROM c""",
)
def publish_status(spark, sf):
    tables = [table(spark, sf, n) for n in ("supplier", "documents", "part")]
    return publish.status(wiki.wiki(spark, sf), *tables).withColumn("ratio", F.round("ratio", 6))


@query(
    "stored_upsert",
    """SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'LARGE') THEN upper(p_name) ELSE p_name END AS p_name FROM part
       WHERE (p_size <= 40 OR p_type IN ('SMALL', 'LARGE')) AND NOT (p_brand = 'Brand#7')""",
)
def stored_upsert(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_type", "p_brand")
    path = work_dir(spark, "part-table")
    sinks.create_table(part.filter("p_size <= 40").select("p_partkey", "p_name"), path, "p_partkey", files_per_bucket=2)
    fresh = part.filter("p_type in ('SMALL', 'LARGE')").select("p_partkey", F.upper("p_name").alias("p_name"))
    sinks.save_docs(spark, path, fresh, "p_partkey")
    sinks.remove_docs(spark, path, part.filter("p_brand = 'Brand#7'"), "p_partkey", confirm=True)
    return sinks.read_table(spark, path)


@query(
    "upsert_newest",
    """SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1""",
)
def upsert_newest(spark, sf):
    """A feed that repeats keys, saved into a table that holds the first half of them."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    path = work_dir(spark, "orders-table")
    first = diff.latest_per_key(orders.filter("o_custkey % 2 = 0"), "o_custkey", ["o_orderkey"])
    sinks.create_table(first, path, "o_custkey")
    sinks.save_docs(spark, path, orders, "o_custkey", schema=orders.schema, newest_by=["o_orderdate", "o_orderkey"])
    return sinks.read_table(spark, path).select("o_custkey", "o_orderkey")


@query(
    "publish_all",
    wiki.WIKI + """, old AS (SELECT 'Page_' || o_custkey AS title, max(o_orderdate) AS modified FROM orders
                              WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1)
       SELECT title AS url_title, CASE WHEN modified IS NULL OR lastmod > modified THEN '<i>' || title || '</i>' ELSE title END AS title,
              lastmod AS modified, 0::BIGINT AS posted_again
       FROM pub JOIN rev USING (title) LEFT JOIN old USING (title) WHERE title NOT IN (SELECT title FROM auth)""",
)
def publish_all(spark, sf):
    """Twice, with deletes, for pages whose display titles have markup: the second run posts nothing."""
    plain = wiki.wiki(spark, sf)
    pages = plain.pages.withColumn("title", F.concat(F.lit("<i>"), "title", F.lit("</i>")))
    shown = publish.Wiki(pages, plain.members, plain.revisions, plain.sources)
    author_path, path = work_dir(spark, "author-table"), work_dir(spark, "article-table")
    for p in (author_path, path):
        stored_pages(spark, sf, p)
    for _ in range(2):
        _, articles = publish.publish_all(spark, shown, author_path, path)
    again = F.lit(articles.posted.count()).cast("bigint").alias("posted_again")
    return spark.read.schema(schemas.ARTICLE).parquet(path).select("url_title", "title", "modified", again)


@query("stream_refresh", "SELECT user_id::VARCHAR AS title, max(ts) AS modified FROM events GROUP BY 1")
def stream_refresh(spark, sf):
    path = work_dir(spark, "stream-table")
    events = table(spark, sf, "events")
    # Half of the pages are there already, at an older state.
    old = events.filter("event_type = 'view'").groupBy(F.col("user_id").cast("string").alias("title")).agg(F.min("ts").alias("modified"))
    sinks.create_table(old, path, "title")
    stream = refresh.revision_stream(spark, f"{sf}/events.parquet", events.schema.simpleString()[7:-1].replace(":", " "))
    rows = stream.select(F.col("user_id").cast("string").alias("title"), "ts")
    refresh.refresh_stream(rows, path, work_dir(spark, "stream-checkpoint")).awaitTermination()
    return sinks.read_table(spark, path)
