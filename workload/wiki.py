"""A wiki made of the given tables: raw page records, members, revisions, media records."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.plans.publish import Wiki
from folioflow.session import spread
from folioflow.sources.readers import parse_pages
from workload import media
from workload.registry import table
from workload.texts import HREF

PARTS = """<div id="authorByline"><b>Authored by <a href="/Ann_B">Ann B</a> and <a href="/wiki/Dan"><i>Dan</i> C</a></b></div>
<div id="citationAuthor" style="display:none;">Bee,Ann; Cee,Dan</div>
<div id="rgdatabox-Core" style="display:none;"><p>RGMediaType:"""

LANG = "regexp_extract(html, 'lang=\"([a-z]+)\"', 1)"


def raw_pages(spark, sf):
    """(url_title, json): every page of the given table as a wiki record."""
    pages = spread(table(spark, sf, "pages")).withColumn("lang", F.expr(LANG)).withColumn("title", F.concat(F.lit("Page_"), "page_id"))

    def named(value):
        return F.struct(value.alias("*"))

    published = F.when(F.col("lang").isin("en", "fr", "de"), F.array(named(F.lit("Published")))).otherwise(F.array().cast("array<struct<`*`:string>>"))
    categories = F.concat(published, F.array(named(F.col("lang")), named(F.lit("Internal"))))
    hrefs = F.regexp_extract_all("html", F.lit(HREF), F.lit(1))
    box = F.concat(F.lit(PARTS), F.when(F.col("lang") == "en", "books;maps;").otherwise(""), F.lit("\nTitle:T: "), "page_id", F.lit("\n</p></div>"))
    parse = F.struct(
        F.col("title").alias("title"),
        F.col("title").alias("displaytitle"),
        categories.alias("categories"),
        F.array(F.concat(F.lit("en-"), "page_id", F.lit(".jpg")), F.lit("logo.png")).alias("images"),
        F.array(
            F.struct(F.lit("notoc").alias("name"), F.lit("x").alias("*")),
            F.struct(F.lit("DEFAULTSORT").alias("name"), F.when(F.col("lang") == "de", F.concat(F.lit("Sort "), "page_id")).otherwise("").alias("*")),
        ).alias("properties"),
        F.transform(hrefs, lambda h: F.struct(F.lit(0).alias("ns"), F.regexp_replace(h, "^/", "").alias("*"))).alias("links"),
        named(F.concat(box, "html")).alias("text"),
    )
    error = F.when(F.col("lang") == "es", F.struct(F.lit("missingtitle").alias("code")))
    body = F.to_json(F.struct(error.alias("error"), F.when(error.isNull(), parse).alias("parse")))
    return pages.select(F.col("title").alias("url_title"), body.alias("json"))


def members(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.expr(LANG).alias("lang"))
    title = F.concat(F.lit("Page_"), "page_id").alias("title")
    published = pages.filter("lang in ('en', 'fr', 'de')").select(F.lit("Published").alias("category"), title, F.lit(False).alias("is_category"))
    authors = pages.filter("lang = 'de'").select(F.lit("Authors").alias("category"), title, F.lit(False).alias("is_category"))
    kinds = pages.filter("lang <> 'fr'").select(F.lit("Articles").alias("category"), F.concat(F.lit("Category:"), "lang").alias("title"), F.lit(True).alias("is_category"))
    return published.unionByName(authors).unionByName(kinds.distinct())


def revisions(spark, sf):
    return table(spark, sf, "orders").select(
        F.concat(F.lit("Page_"), "o_custkey").alias("title"), F.col("o_orderdate").alias("ts")
    )


def wiki(spark, sf) -> Wiki:
    raw = raw_pages(spark, sf)
    return Wiki(parse_pages(raw), members(spark, sf), revisions(spark, sf), media.records(spark, sf), raw)


# The same wiki for SQL.
WIKI = r"""
  WITH p AS (SELECT page_id, 'Page_' || page_id AS title, regexp_extract(html, 'lang="([a-z]+)"', 1) AS lang, html FROM pages),
       rev AS (SELECT 'Page_' || o_custkey AS title, max(o_orderdate) AS lastmod FROM orders GROUP BY 1),
       pub AS (SELECT title FROM p WHERE lang IN ('en', 'fr', 'de') AND title IN (SELECT title FROM rev)),
       auth AS (SELECT title FROM p WHERE lang = 'de'),
       az AS (SELECT title, coalesce(lag(title) OVER (ORDER BY title), max(title) OVER ()) AS prev_page,
                     coalesce(lead(title) OVER (ORDER BY title), '') AS next_page FROM pub WHERE title NOT IN (SELECT title FROM auth)),
       art AS (
         SELECT p.title AS url_title, lang IN ('en', 'fr', 'de') AS published, true AS published_encyc, lang = 'en' AS published_rg,
                lastmod AS modified, '/' || p.title || '/' AS mw_api_url,
                CASE WHEN lang = 'de' THEN 'sort' || page_id ELSE 'page' || page_id END AS title_sort, p.title AS title,
                CASE WHEN p.title IN (SELECT title FROM pub) THEN coalesce(prev_page, '') END AS prev_page,
                CASE WHEN p.title IN (SELECT title FROM pub) THEN coalesce(next_page, '') END AS next_page,
                CASE WHEN p.title IN (SELECT title FROM pub) AND lang <> 'fr' THEN lang ELSE '' END AS categories,
                CASE WHEN page_id IN (SELECT p_partkey FROM part) THEN 'en-' || page_id ELSE '' END AS source_ids,
                CASE WHEN p.title IN (SELECT title FROM pub) THEN 'Ann B|<i>Dan</i>' ELSE '' END AS display,
                CASE WHEN p.title IN (SELECT title FROM pub) THEN 'Bee,Ann|Cee,Dan' ELSE '' END AS parsed,
                'rgdatabox-Core|{"rgmediatype":' || CASE WHEN lang = 'en' THEN '["books","maps"]' ELSE '""' END || ',"title":"T: ' || page_id || '"}' AS databoxes,
                CASE WHEN lang = 'en' THEN 'books|maps' ELSE '' END AS rg_rgmediatype, 'T: ' || page_id AS rg_title
         FROM p LEFT JOIN rev ON rev.title = p.title LEFT JOIN az ON az.title = p.title WHERE lang <> 'es')
"""


def light(articles):
    """Article columns other than the body texts, arrays as text."""
    return articles.select(
        "url_title", "published", "published_encyc", "published_rg", "modified", "mw_api_url", "title_sort", "title",
        "prev_page", "next_page",
        F.array_join("categories", "|").alias("categories"),
        F.array_join("source_ids", "|").alias("source_ids"),
        F.array_join("authors_data.display", "|").alias("display"),
        F.array_join(F.transform("authors_data.parsed", lambda n: F.array_join(n, ",")), "|").alias("parsed"),
        F.array_join("databoxes", "|").alias("databoxes"),
        F.array_join("rg_rgmediatype", "|").alias("rg_rgmediatype"),
        F.array_join("rg_title", "|").alias("rg_title"),
    )
