"""Navigation and index tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.operators import index, links
from workload.registry import query, table

A_Z = "WITH az AS (SELECT DISTINCT c_name AS title FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')"


def a_z(spark, sf):
    customer = table(spark, sf, "customer").select(F.col("c_name").alias("title"), "c_mktsegment")
    return index.articles_a_z(customer, customer.filter("c_mktsegment = 'AUTOMOBILE'"))


@query("a_z_list", A_Z + " SELECT title FROM az")
def a_z_list(spark, sf):
    return a_z(spark, sf).orderBy("title")


@query(
    "prev_next",
    A_Z + """ SELECT title, coalesce(lag(title) OVER (ORDER BY title), max(title) OVER ()) AS prev_page,
                     coalesce(lead(title) OVER (ORDER BY title), '') AS next_page FROM az""",
)
def prev_next(spark, sf):
    return index.neighbours(a_z(spark, sf))


@query(
    "prev_next_links",
    r"""WITH az AS (SELECT DISTINCT l_orderkey || '/' || l_partkey AS title FROM lineitem)
        SELECT title, coalesce(lag(title) OVER (ORDER BY title), max(title) OVER ()) AS prev_page,
               coalesce(lead(title) OVER (ORDER BY title), '') AS next_page FROM az""",
)
def prev_next_links(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.concat_ws("/", "l_orderkey", "l_partkey").alias("title"))
    return index.neighbours(lines)


@query(
    "columns_layout",
    """WITH p AS (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_name, c_custkey) - 1 AS pos, count(*) OVER () AS n FROM customer)
       SELECT c_custkey, c_name, (pos // (round_even(n / 4.0, 0)::BIGINT + 1))::BIGINT AS column_no,
              (pos % (round_even(n / 4.0, 0)::BIGINT + 1))::BIGINT AS row_no FROM p""",
)
def columns_layout(spark, sf):
    return index.columns_layout(table(spark, sf, "customer").select("c_custkey", "c_name"), ["c_name", "c_custkey"], 4)


def headings(spark, sf):
    """Parts by their names."""
    return table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("title"), F.lower("p_name").alias("title_sort"))


HEADINGS = "WITH h AS (SELECT p_partkey::VARCHAR AS title, lower(p_name) AS title_sort FROM part)"


@query(
    "letter_index",
    HEADINGS + """ SELECT upper(left(title_sort, 1)) AS letter, title_sort AS sort_key, title,
                          row_number() OVER (PARTITION BY upper(left(title_sort, 1)) ORDER BY title_sort, title) - 1 AS pos FROM h""",
)
def letter_index(spark, sf):
    return index.letter_index(headings(spark, sf), "title_sort", "title")


@query("letter_counts", HEADINGS + " SELECT upper(left(title_sort, 1)) AS letter, count(*) AS n FROM h GROUP BY 1")
def letter_counts(spark, sf):
    return index.letter_counts(headings(spark, sf), "title_sort")


HIDDEN = ["src3", "src7"]


def categorised(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("url_title"), F.array("lang", "source").alias("categories")
    )


EDGES = """WITH e AS (SELECT DISTINCT doc_id AS url_title, unnest([lang, source]) AS category FROM documents),
                s AS (SELECT * FROM e WHERE category NOT IN ('src3', 'src7'))"""


@query(
    "pages_by_category",
    EDGES + " SELECT category, url_title, row_number() OVER (PARTITION BY category ORDER BY url_title) - 1 AS pos FROM s",
)
def pages_by_category(spark, sf):
    return index.pages_by_category(categorised(spark, sf), HIDDEN)


@query("category_sizes", EDGES + " SELECT category, count(*) AS n_pages FROM s GROUP BY 1")
def category_sizes(spark, sf):
    return index.category_sizes(categorised(spark, sf), HIDDEN)


@query(
    "category_whitelist",
    """WITH e AS (SELECT doc_id AS url_title, unnest([lang, source, 'War_' || lang]) AS category, unnest([0, 1, 2]) AS pos FROM documents),
            n AS (SELECT DISTINCT source AS name FROM documents WHERE lang = 'en' AND n_chars > 4000 UNION SELECT 'War fr')
       SELECT url_title, pos, category FROM e WHERE replace(category, '_', ' ') IN (SELECT name FROM n)""",
)
def category_whitelist(spark, sf):
    documents = table(spark, sf, "documents")
    pages = documents.select(
        F.col("doc_id").alias("url_title"), F.array("lang", "source", F.concat(F.lit("War_"), "lang")).alias("categories")
    )
    long = documents.filter("lang = 'en' and n_chars > 4000").select(F.concat(F.lit("Category:"), "source", F.lit(":x")).alias("title"))
    war = documents.filter("lang = 'fr'").select(F.lit("Category:War fr").alias("title"))
    members = long.unionByName(war).distinct().select(F.lit("Articles").alias("category"), "title", F.lit(True).alias("is_category"))
    return index.whitelisted_categories(pages, index.category_names(members))


@query(
    "page_flags",
    """SELECT p_partkey AS id, p_name AS title, p_name IN (SELECT p_name FROM part WHERE p_retailprice > 1090) AS is_article,
              p_name IN (SELECT p_name FROM part WHERE p_brand = 'Brand#3' AND p_size > 40) AS is_author FROM part""",
)
def page_flags(spark, sf):
    part = table(spark, sf, "part")
    titles = part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))
    published = part.filter("p_retailprice > 1090").select(F.col("p_name").alias("title"))
    authors = part.filter("p_brand = 'Brand#3' and p_size > 40").select(F.col("p_name").alias("title"))
    flagged = links.flag_members(titles, published, "title", "is_article")
    return links.flag_members(flagged, authors, "title", "is_author")
