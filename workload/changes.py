"""Snapshots, changes and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.operators import diff
from folioflow.sources import sinks
from workload.registry import query, table

KEY = "concat_ws('-', o_custkey, o_orderpriority)"

SNAPSHOTS = f"""
  WITH src AS (SELECT {KEY} AS title, max(o_orderdate) AS lastmod FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1),
       tgt AS (SELECT {KEY} AS title, max(o_orderdate) AS modified FROM orders
               WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1)
"""

CHANGE = """CASE WHEN t.title IS NULL THEN 'new' WHEN s.title IS NULL THEN 'deleted'
                 WHEN s.lastmod > t.modified THEN 'updated' ELSE 'same' END"""


def snapshots(spark, sf):
    """Open orders are the source side; what was ordered before 2000 is what has been published."""
    orders = table(spark, sf, "orders").withColumn("title", F.expr(KEY))
    source = diff.latest_revision(orders.filter("o_orderstatus <> 'F'"), "title", "o_orderdate")
    target = diff.latest_revision(
        orders.filter("o_orderdate < timestamp_ntz '2000-01-01 00:00:00'"), "title", "o_orderdate", "modified"
    )
    return source, target


@query(
    "diff_changes",
    SNAPSHOTS + f"""SELECT coalesce(s.title, t.title) AS title, s.lastmod, t.modified, {CHANGE} AS change
                    FROM src s FULL JOIN tgt t ON s.title = t.title""",
)
def diff_changes(spark, sf):
    return diff.classify(*snapshots(spark, sf), "title")


@query("new_keys", SNAPSHOTS + "SELECT title FROM src WHERE title NOT IN (SELECT title FROM tgt)")
def new_keys(spark, sf):
    return diff.new_keys(*snapshots(spark, sf), "title")


@query("deleted_keys", SNAPSHOTS + "SELECT title FROM tgt WHERE title NOT IN (SELECT title FROM src)")
def deleted_keys(spark, sf):
    return diff.deleted_keys(*snapshots(spark, sf), "title")


@query("updated_keys", SNAPSHOTS + "SELECT s.title FROM src s JOIN tgt t ON s.title = t.title WHERE s.lastmod > t.modified")
def updated_keys(spark, sf):
    return diff.updated_keys(*snapshots(spark, sf), "title")


@query(
    "changes_to_write",
    SNAPSHOTS + """SELECT s.title, s.lastmod, t.modified, CASE WHEN t.title IS NULL THEN 'new' ELSE 'updated' END AS change
                   FROM src s LEFT JOIN tgt t ON s.title = t.title WHERE t.title IS NULL OR s.lastmod > t.modified""",
)
def changes_to_write(spark, sf):
    return diff.to_update(diff.classify(*snapshots(spark, sf), "title"))


@query(
    "change_report",
    SNAPSHOTS + f"SELECT {CHANGE} AS change, count(*) AS n FROM src s FULL JOIN tgt t ON s.title = t.title GROUP BY 1",
)
def change_report(spark, sf):
    return diff.change_report(diff.classify(*snapshots(spark, sf), "title"))


AUTHORS = f"SELECT DISTINCT {KEY} AS title FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 200000"


def author_titles(spark, sf):
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT' and o_totalprice > 200000")
    return urgent.select(F.expr(KEY).alias("title")).distinct()


@query(
    "author_split",
    SNAPSHOTS + f", auth AS ({AUTHORS}) SELECT title, lastmod, title IN (SELECT title FROM auth) AS is_author FROM src",
)
def author_split(spark, sf):
    articles, authors = diff.split_authors(snapshots(spark, sf)[0], author_titles(spark, sf))
    return articles.withColumn("is_author", F.lit(False)).unionByName(authors.withColumn("is_author", F.lit(True)))


def _update_sql(negate):
    return SNAPSHOTS + f""", auth AS ({AUTHORS}),
       s AS (SELECT * FROM src WHERE title {negate} IN (SELECT title FROM auth)),
       t AS (SELECT * FROM tgt)
       SELECT coalesce(s.title, t.title) AS title, s.lastmod, t.modified, {CHANGE} AS change
       FROM s FULL JOIN t ON s.title = t.title"""


@query("articles_to_update", _update_sql("NOT"))
def articles_to_update(spark, sf):
    source, target = snapshots(spark, sf)
    return diff.articles_to_update(author_titles(spark, sf), source, target)


@query("authors_to_update", _update_sql(""))
def authors_to_update(spark, sf):
    source, target = snapshots(spark, sf)
    return diff.authors_to_update(author_titles(spark, sf), source, target)


@query(
    "sources_to_update",
    """WITH s AS (SELECT 'src-' || l_partkey || '-' || l_suppkey AS encyclopedia_id, max(l_shipdate) AS lastmod
                  FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
            t AS (SELECT 'src-' || l_partkey || '-' || l_suppkey AS encyclopedia_id, max(l_shipdate) AS modified
                  FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)
       SELECT coalesce(s.encyclopedia_id, t.encyclopedia_id) AS encyclopedia_id, lastmod, modified,
              CASE WHEN t.encyclopedia_id IS NULL THEN 'new' WHEN s.encyclopedia_id IS NULL THEN 'deleted'
                   WHEN lastmod > modified THEN 'updated' ELSE 'same' END AS change
       FROM s FULL JOIN t ON s.encyclopedia_id = t.encyclopedia_id""",
)
def sources_to_update(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn(
        "encyclopedia_id", F.concat(F.lit("src-"), "l_partkey", F.lit("-"), "l_suppkey")
    )
    records = diff.latest_revision(lines.filter("l_returnflag <> 'R'"), "encyclopedia_id", "l_shipdate", "modified")
    stored = diff.latest_revision(lines.filter("l_linestatus = 'O'"), "encyclopedia_id", "l_shipdate", "modified")
    return diff.sources_to_update(records, stored)


@query("latest_revision", "SELECT user_id, max(ts) AS lastmod FROM events GROUP BY 1")
def latest_revision(spark, sf):
    return diff.latest_revision(table(spark, sf, "events"), "user_id", "ts")


@query(
    "last_record_wins",
    """SELECT event_id, ts, user_id, event_type, value, props FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def last_record_wins(spark, sf):
    return diff.latest_per_key(table(spark, sf, "events"), "user_id", ["ts", "event_id"])


MEMBERS = """
  WITH members AS (SELECT 'Published' AS category, c_name AS title, c_nationkey = 0 AS is_category FROM customer WHERE c_acctbal > 1000
                   UNION ALL SELECT 'Authors', c_name, false FROM customer WHERE c_mktsegment = 'AUTOMOBILE'),
       revisions AS (SELECT c_name AS title, o_orderdate AS ts FROM orders JOIN customer ON c_custkey = o_custkey)
"""


def members(spark, sf):
    customer = table(spark, sf, "customer")
    published = customer.filter("c_acctbal > 1000").select(
        F.lit("Published").alias("category"), F.col("c_name").alias("title"), (F.col("c_nationkey") == 0).alias("is_category")
    )
    authors = customer.filter("c_mktsegment = 'AUTOMOBILE'").select(
        F.lit("Authors").alias("category"), F.col("c_name").alias("title"), F.lit(False).alias("is_category")
    )
    return published.unionByName(authors)


def revisions(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("title"), F.col("o_orderdate").alias("ts")
    )


@query(
    "published_pages",
    MEMBERS + """SELECT title, max(ts) AS lastmod FROM revisions
                 WHERE title IN (SELECT title FROM members WHERE category = 'Published' AND NOT is_category) GROUP BY 1""",
)
def published_pages(spark, sf):
    return diff.published_pages(members(spark, sf), revisions(spark, sf))


@query(
    "published_authors",
    MEMBERS + """SELECT title FROM members WHERE category = 'Authors'
                 INTERSECT SELECT title FROM members WHERE category = 'Published'""",
)
def published_authors(spark, sf):
    return diff.published_authors(members(spark, sf))


@query(
    "coverage",
    """WITH c AS (SELECT 'article' AS doctype, (SELECT count(*) FROM labels) AS stored, (SELECT count(*) FROM documents) AS total
                  UNION ALL SELECT 'author', (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'O'),
                                   (SELECT count(*) FROM customer)
                  UNION ALL SELECT 'source', (SELECT count(*) FROM part), 0)
       SELECT doctype, stored, total, round(CASE WHEN total > 0 THEN stored::DOUBLE / total END, 6) AS ratio FROM c""",
)
def coverage(spark, sf):
    buyers = table(spark, sf, "orders").filter("o_orderstatus = 'O'").select("o_custkey").distinct()
    sides = {
        "article": (table(spark, sf, "documents"), table(spark, sf, "labels")),
        "author": (table(spark, sf, "customer"), buyers),
        "source": (None, table(spark, sf, "part")),
    }
    return diff.coverage(sides).withColumn("ratio", F.round("ratio", 6))


OLD_NEW = """
  WITH old AS (SELECT p_partkey, p_name, p_brand, p_retailprice FROM part WHERE p_size <= 40),
       fresh AS (SELECT p_partkey, upper(p_name) AS p_name, p_brand, p_retailprice FROM part WHERE p_type IN ('SMALL', 'LARGE'))
"""


def old_and_fresh(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice", "p_size", "p_type")
    old = part.filter("p_size <= 40").drop("p_size", "p_type")
    fresh = part.filter("p_type in ('SMALL', 'LARGE')").drop("p_size", "p_type")
    return old, fresh.withColumn("p_name", F.upper("p_name"))


@query(
    "upsert_documents",
    OLD_NEW + "SELECT * FROM old WHERE p_partkey NOT IN (SELECT p_partkey FROM fresh) UNION ALL SELECT * FROM fresh",
)
def upsert_documents(spark, sf):
    return sinks.upsert(*old_and_fresh(spark, sf), "p_partkey")


@query("delete_documents", OLD_NEW + "SELECT * FROM old WHERE p_partkey NOT IN (SELECT p_partkey FROM fresh)")
def delete_documents(spark, sf):
    return sinks.delete_docs(*old_and_fresh(spark, sf), "p_partkey", confirm=True)


@query("verify_published", OLD_NEW + "SELECT p_partkey FROM fresh WHERE p_partkey NOT IN (SELECT p_partkey FROM old)")
def verify_published(spark, sf):
    old, fresh = old_and_fresh(spark, sf)
    return sinks.verify_published(fresh, old, "p_partkey")
