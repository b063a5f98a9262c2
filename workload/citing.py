"""Author names and citations."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.functions import people
from folioflow.operators.citations import cite_articles
from folioflow.session import spread
from workload.registry import query, table

DEFAULT = "Encyclopedia contributors."

# Line n of an order has n authors; the second has one given name only, the fifth no given name.
NAMES = """
  WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity < 4 THEN []
         ELSE list_transform(range(1, l_linenumber + 1), lambda i: CASE WHEN i = 5 THEN ['Solo' || l_suppkey]
              WHEN i = 2 THEN ['Sur' || l_partkey, 'Ann'] ELSE ['Name' || i, 'Given' || l_suppkey || ' Mid' || i || ' X'] END) END AS names FROM lineitem),
  n AS (SELECT *, len(names) AS k,
               list_transform(names, lambda x: array_to_string(x, ', ')) AS plain,
               list_transform(names, lambda x: array_to_string(list_reverse(x), ' ')) AS turned,
               list_transform(names, lambda x: CASE WHEN len(x) < 2 THEN x[1] ELSE x[1] || ', ' ||
                 array_to_string(list_transform(string_split(x[2], ' '), lambda g, i: CASE WHEN i = 1 THEN g ELSE left(g, 1) || '.' END), ' ') END) AS apa,
               list_transform(names, lambda x: CASE WHEN len(x) < 2 THEN x[1] ELSE x[1] || ', ' ||
                 array_to_string(list_transform(string_split(x[2], ' '), lambda g: left(g, 1) || '.'), ' ') END) AS short,
               list_transform(names, lambda x: CASE WHEN len(x) < 2 THEN x[1] ELSE x[1] || ' ' ||
                 array_to_string(list_transform(string_split(x[2], ' '), lambda g: left(g, 1)), ' ') END) AS bare
        FROM a),
  c AS (SELECT *,
          CASE WHEN k = 1 THEN plain[1] ELSE array_to_string(apa[1:k - 1], ', ') || ', and ' || apa[k] END AS apa_text,
          array_to_string(short, ' and ') AS bibtex_text,
          CASE WHEN k = 1 THEN turned[1] WHEN k < 4 THEN array_to_string(turned[1:k - 1], ', ') || ' and ' || turned[k] ELSE turned[1] || ' et al' END AS chicago_text,
          array_to_string(bare, ', ') AS cse_text,
          CASE WHEN k = 1 THEN turned[1] WHEN k < 4 THEN array_to_string(turned[1:k - 1], ', ') || ' and ' || turned[k] ELSE turned[1] || ' and others' END AS mhra_text,
          CASE WHEN k = 1 THEN plain[1] WHEN k < 4 THEN array_to_string(list_concat([plain[1]], turned[2:k - 1]), ', ') || ', and ' || turned[k]
               ELSE plain[1] || ', et al' END AS mla_text
        FROM n)
"""


def cited(spark, sf):
    i = F.col("l_linenumber")

    def name(n):
        given = F.concat(F.lit("Given"), "l_suppkey", F.lit(" Mid"), n, F.lit(" X"))
        return (
            F.when(n == 5, F.array(F.concat(F.lit("Solo"), "l_suppkey")))
            .when(n == 2, F.array(F.concat(F.lit("Sur"), "l_partkey"), F.lit("Ann")))
            .otherwise(F.array(F.concat(F.lit("Name"), n), given))
        )

    names = F.when(F.col("l_quantity") < 4, F.array().cast("array<array<string>>")).otherwise(
        F.transform(F.sequence(F.lit(1), i), name)
    )
    return spread(table(spark, sf, "lineitem")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", names.alias("names"))


def _style(style):
    stop = "text || '.'" if style == "mla" else "CASE WHEN ends_with(text, '.') THEN text ELSE text || '.' END"
    sql = NAMES + f""", t AS (SELECT *, {style}_text AS text FROM c)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN k = 0 THEN '{DEFAULT}' ELSE {stop} END AS citation FROM t"""

    @query(f"cite_{style}", sql)
    def run(spark, sf):
        return cited(spark, sf).withColumn("citation", people.cite(style, "names", DEFAULT)).drop("names")

    return run


for _name in people.STYLES:
    _style(_name)


@query(
    "article_citations",
    """SELECT 'Page_' || page_id AS url_title, '/Page_' || page_id || '/' AS uri, CASE WHEN page_id > 100 THEN 'Title ' || page_id ELSE url END AS title,
              TIMESTAMP '2020-01-02 03:04:05' AS lastmod, 'Doe, Page ' || page_id || '.' AS apa, 'Doe, P. ' || left(page_id::VARCHAR, 1) || '.' AS bibtex
       FROM pages""",
)
def article_citations(spark, sf):
    names = F.array(F.array(F.lit("Doe"), F.concat(F.lit("Page "), "page_id")))
    articles = table(spark, sf, "pages").select(
        F.concat(F.lit("Page_"), "page_id").alias("url_title"),
        F.when(F.col("page_id") > 100, F.concat(F.lit("Title "), "page_id")).otherwise("").alias("title"),
        F.col("url").alias("caption"),
        F.expr("timestamp_ntz '2020-01-02 03:04:05'").alias("modified"),
        F.struct(names.alias("parsed")).alias("authors_data"),
    )
    return cite_articles(articles).select("url_title", "uri", "title", "lastmod", "apa", "bibtex")


BYLINE = """CASE WHEN s_acctbal > 6000 THEN 'Ander' || s_suppkey || ' and Brand, Sandy' || s_nationkey || ';Solo'
                 WHEN s_acctbal > 3000 THEN ' Sur' || s_suppkey || ' ,Given' || s_nationkey || ' ; Cohn, Al'
                 ELSE 'One, Two, Three' || s_suppkey END"""


@query(
    "byline_names",
    """SELECT s_suppkey, CASE WHEN s_acctbal > 6000 THEN 'Ander' || s_suppkey || '|Br|/S|y' || s_nationkey || '|Solo'
                              WHEN s_acctbal > 3000 THEN 'Sur' || s_suppkey || '/Given' || s_nationkey || '|Cohn/Al'
                              ELSE 'One, Two, Three' || s_suppkey END AS names FROM supplier""",
)
def byline_names(spark, sf):
    parsed = people.parse_names(BYLINE)
    return table(spark, sf, "supplier").select(
        "s_suppkey", F.array_join(F.transform(parsed, lambda n: F.array_join(n, "/")), "|").alias("names")
    )
