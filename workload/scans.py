"""Reading and listing documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.functions import flags
from folioflow.functions.text import unwrap_single
from folioflow.plans.build import article_records, page_links
from folioflow.session import work_dir
from folioflow.sources import readers
from workload import wiki
from workload.registry import query, table
from workload.texts import HREF


RAW_PAGES = """WITH p AS (SELECT 'Page_' || page_id AS url_title, regexp_extract(html, 'lang="([a-z]+)"', 1) AS lang, html FROM pages)
       SELECT url_title, CASE WHEN lang = 'es' THEN 404 ELSE 200 END AS status_code, CASE WHEN lang = 'es' THEN 'missingtitle' END AS error,
              CASE WHEN lang <> 'es' THEN url_title END AS title, lang IN ('en', 'fr', 'de') AS published,
              CASE WHEN lang <> 'es' THEN contains(html, '<article>') END AS has_article FROM p"""


def page_columns(pages):
    return pages.select(
        "url_title", "status_code", "error", "title",
        flags.is_published("categories").alias("published"),
        F.contains("html", F.lit("<article>")).alias("has_article"),
    )


@query("raw_pages", RAW_PAGES)
def raw_pages(spark, sf):
    return page_columns(readers.parse_pages(wiki.raw_pages(spark, sf)))


@query("page_files", RAW_PAGES)
def page_files(spark, sf):
    """The same pages from files of one record a line."""
    path = work_dir(spark, "page-files")
    wiki.raw_pages(spark, sf).write.json(path)
    return page_columns(readers.read_pages(spark, path))


@query(
    "publishable_pages",
    """SELECT 'Page_' || page_id AS url_title FROM pages WHERE regexp_extract(html, 'lang="([a-z]+)"', 1) IN ('en', 'fr', 'de')""",
)
def publishable_pages(spark, sf):
    pages = readers.parse_pages(wiki.raw_pages(spark, sf))
    return pages.filter(flags.publishable(flags.is_published("categories"))).select("url_title")


@query(
    "page_link_edges",
    rf"""SELECT 'Page_' || page_id AS source, replace(unnest(regexp_extract_all(html, '{HREF}', 1)), '/', '') AS target FROM pages
         WHERE regexp_extract(html, 'lang="([a-z]+)"', 1) <> 'es'""",
)
def page_link_edges(spark, sf):
    return page_links(readers.parse_pages(wiki.raw_pages(spark, sf)))


def stored_documents(spark, sf):
    return table(spark, sf, "documents").select(
        F.concat(F.lit("D"), "doc_id").alias("url_title"),
        F.col("source").alias("title"),
        F.array("lang", "source").alias("categories"),
        (F.col("n_chars") > 2000).alias("published_encyc"),
        F.col("text").alias("body"),
        F.col("n_chars").alias("internal"),
    )


@query(
    "list_documents",
    """SELECT 'D' || doc_id AS url_title, source AS title, md5(text) AS body, lang || '|' || source AS categories FROM documents""",
)
def list_documents(spark, sf):
    rows = readers.list_docs(stored_documents(spark, sf))
    return rows.withColumns({"body": F.md5("body"), "categories": F.array_join("categories", "|")})


@query(
    "search_documents",
    """SELECT 'D' || doc_id AS url_title, source AS title FROM documents WHERE (lang = 'fr' OR source = 'src5') AND n_chars > 2000""",
)
def search_documents(spark, sf):
    params = {"categories": ["fr", "src5"], "published_encyc": True, "title": "no such parameter"}
    return readers.search_docs(stored_documents(spark, sf), params).select("url_title", "title")


@query(
    "listing_lines",
    """SELECT o_orderkey::VARCHAR AS url_title,
              (row_number() OVER (ORDER BY o_orderkey::VARCHAR) - 1) || '/' || count(*) OVER () || '| ' || o_orderkey AS line FROM orders""",
)
def listing_lines(spark, sf):
    docs = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("url_title"))
    return readers.listing_lines(docs, "url_title")


@query("guide_titles", "SELECT c_name AS id FROM customer")
def guide_titles(spark, sf):
    return readers.rg_titles(table(spark, sf, "customer").select(F.col("c_name").alias("id")))


@query(
    "one_document",
    "SELECT o_orderkey::VARCHAR AS url_title, o_orderpriority AS title, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS modified FROM orders WHERE o_orderkey = 77",
)
def one_document(spark, sf):
    docs = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("url_title"), F.col("o_orderpriority").alias("title"),
        F.col("o_orderdate").alias("modified"), F.lit("long").alias("body"),
    )
    return readers.get_document({"article": docs}, "article", "77")


@query("csv_rows", "SELECT c_custkey::VARCHAR AS c_custkey, c_name || '\"' || chr(10) || ', x' AS note FROM customer")
def csv_rows(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", F.concat("c_name", F.lit('"\n, x')).alias("note"))
    path = work_dir(spark, "csv")
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return readers.read_csv(spark, path)


@query("csv_slice", "SELECT o_orderkey, o_custkey, o_orderpriority FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders) WHERE r >= 40")
def csv_slice(spark, sf):
    path = work_dir(spark, "csv")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    rows.orderBy("o_orderkey").write.option("header", True).csv(path)
    return readers.read_csv(spark, path, row_start=40, schema="o_orderkey bigint, o_custkey bigint, o_orderpriority string", multiline=False)


@query("json_documents", "SELECT s_suppkey AS id, s_name AS title, s_acctbal AS weight FROM supplier")
def json_documents(spark, sf):
    path = work_dir(spark, "json")
    table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"), F.col("s_acctbal").alias("weight")
    ).write.json(path)
    return readers.read_documents(spark, path, "id bigint, title string, weight double")


@query("single_values", "SELECT doc_id, CASE WHEN n_chars > 3000 THEN lang END AS first_value FROM documents")
def single_values(spark, sf):
    values = F.when(F.col("n_chars") > 3000, F.array("lang", "source")).otherwise(F.array().cast("array<string>"))
    return table(spark, sf, "documents").select("doc_id", unwrap_single(values).alias("first_value"))


@query("article_records", wiki.WIKI + " SELECT url_title, title, title_sort, modified, prev_page, categories FROM art")
def records(spark, sf):
    from folioflow.plans.build import build_articles

    parts = wiki.wiki(spark, sf)
    rows = article_records(build_articles(parts.pages, parts.members, parts.revisions, parts.sources))
    return rows.select("url_title", "title", "title_sort", "modified", "prev_page", F.array_join("categories", "|").alias("categories"))
