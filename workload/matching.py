"""Pages, authors, sources and files matched with one another."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.functions.text import href_title
from folioflow.operators import links
from workload.registry import query, table
from workload.texts import HREF, page_hrefs

LINKS = rf"""WITH l AS (SELECT DISTINCT url AS source, regexp_replace(regexp_replace(h, '/$', ''), '^/', '') AS target
                        FROM (SELECT url, unnest(regexp_extract_all(html, '{HREF}', 1)) AS h FROM pages))"""


def edges(spark, sf):
    rows = page_hrefs(spark, sf).select(F.col("url").alias("source"), href_title("href", "/wiki").alias("target"))
    return links.backlinks(rows)


@query("backlinks", LINKS + " SELECT target, source FROM l")
def backlinks(spark, sf):
    return edges(spark, sf)


@query(
    "backlink_lists",
    LINKS + """, p AS (SELECT target, source, (row_number() OVER (PARTITION BY target ORDER BY source) - 1) // 10 AS part,
                              count(*) OVER (PARTITION BY target) AS n FROM l)
               SELECT target, part::INTEGER AS part, max(n) AS n, string_agg(source, '|' ORDER BY source) AS titles FROM p GROUP BY 1, 2""",
)
def backlink_lists(spark, sf):
    return links.backlink_lists(edges(spark, sf), size=10).withColumn("titles", F.array_join("titles", "|"))


@query(
    "primary_sources",
    """WITH i AS (SELECT o_orderkey AS url_title, unnest([o_custkey, o_orderkey, o_custkey, o_orderkey + o_custkey]) AS k,
                         unnest([0, 1, 2, 3]) AS pos FROM orders)
       SELECT url_title, min(pos) AS pos, 'en-part-' || k AS encyclopedia_id FROM i WHERE k IN (SELECT p_partkey FROM part) GROUP BY 1, 3""",
)
def primary_sources(spark, sf):
    def image(key):
        return F.concat(F.lit("/images/thumb/a/en-part-"), key, F.lit(".jpg/200px-"), key, F.lit(".jpg"))

    key, both = F.col("o_orderkey"), F.col("o_orderkey") + F.col("o_custkey")
    images = F.array(image(F.col("o_custkey")), image(key), image(F.col("o_custkey")), image(both))
    pages = table(spark, sf, "orders").select(key.alias("url_title"), images.alias("images"))
    sources = table(spark, sf, "part").select(F.concat(F.lit("en-part-"), "p_partkey").alias("encyclopedia_id"))
    return links.primary_sources(pages, sources)


@query(
    "author_articles",
    """WITH e AS (SELECT DISTINCT s_name AS author, l_partkey AS k FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
       SELECT author, p_partkey::VARCHAR AS url_title, p_name AS title FROM e JOIN part ON p_partkey = k""",
)
def author_articles(spark, sf):
    lines, supplier = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    pairs = lines.select("l_suppkey", "l_partkey").distinct().join(supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    rows = pairs.select(F.col("l_partkey").cast("string").alias("source"), F.col("s_name").alias("target"))
    articles = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("url_title"), F.col("p_name").alias("title"))
    return links.author_articles(links.backlinks(rows), articles)


@query(
    "article_authors",
    """WITH d AS (SELECT o_orderkey AS url_title, unnest(['Supplier#' || lpad(o_custkey::VARCHAR, 9, '0'), o_orderpriority]) AS display,
                         unnest([0, 1]) AS pos FROM orders)
       SELECT url_title, pos, display, display AS author, s_name IS NOT NULL AS has_document, s_nationkey::VARCHAR AS author_title
       FROM d LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON s_name = display""",
)
def article_authors(spark, sf):
    names = F.array(F.concat(F.lit("Supplier#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")), F.col("o_orderpriority"))
    articles = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("url_title"), F.struct(names.alias("display")).alias("authors_data")
    )
    authors = table(spark, sf, "supplier").filter("s_acctbal > 0").select(
        F.col("s_name").alias("url_title"), F.col("s_nationkey").cast("string").alias("title")
    )
    return links.article_authors(articles, authors)


@query(
    "article_sources",
    """WITH d AS (SELECT o_orderkey AS url_title, unnest([o_custkey, o_orderkey]) AS source_id, unnest([0, 1]) AS pos FROM orders)
       SELECT url_title, pos, source_id::VARCHAR AS source_id, p_partkey::VARCHAR AS encyclopedia_id, p_name AS caption,
              p_partkey IS NOT NULL AS found FROM d LEFT JOIN part ON p_partkey = source_id""",
)
def article_sources(spark, sf):
    ids = F.array(F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"))
    articles = table(spark, sf, "orders").select(F.col("o_orderkey").alias("url_title"), ids.alias("source_ids"))
    sources = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("encyclopedia_id"), F.col("p_name").alias("caption")
    )
    return links.article_sources(articles, sources)


@query(
    "source_article",
    """WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_quantity < 5 THEN '' ELSE l_partkey::VARCHAR END AS headword FROM lineitem)
       SELECT l_orderkey, l_linenumber, headword, p_partkey::VARCHAR AS article, p_name AS article_title, count(*) AS n FROM s
       LEFT JOIN (SELECT * FROM part WHERE p_size > 20) ON headword <> '' AND p_partkey::VARCHAR = headword GROUP BY ALL""",
)
def source_article(spark, sf):
    sources = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_quantity") < 5, "").otherwise(F.col("l_partkey").cast("string")).alias("headword"),
    )
    articles = table(spark, sf, "part").filter("p_size > 20").select(
        F.col("p_partkey").cast("string").alias("url_title"), F.col("p_name").alias("title")
    )
    return links.source_article(sources, articles).groupBy(
        "l_orderkey", "l_linenumber", "headword", "article", "article_title"
    ).agg(F.count("*").alias("n"))


@query(
    "media_presence",
    """SELECT 'o' || o_orderkey AS encyclopedia_id, '/media/' || o_custkey || '.jpg' AS path,
              o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) AS present FROM orders""",
)
def media_presence(spark, sf):
    def path(key):
        return F.concat(F.lit("/media/"), key, F.lit(".jpg")).alias("path")

    plan = table(spark, sf, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("encyclopedia_id"), path("o_custkey"))
    files = table(spark, sf, "customer").filter("c_acctbal > 5000").select(path("c_custkey"))
    return links.with_presence(plan, files)
