"""Vocabularies, topic indexes and shared-out objects."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.operators import topics
from folioflow.operators.positions import top_per_group
from folioflow.sources import readers
from workload.registry import query, table


def vocab(spark, sf):
    """Each order is a term, of the topics or of the facility vocabulary."""
    orders = table(spark, sf, "orders")
    number = F.col("o_orderkey").cast("bigint")
    return orders.select(
        F.when(F.col("o_orderstatus") == "F", "facility").otherwise("topics").alias("facet_id"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("Order "), "o_orderkey").alias("title"),
        F.col("o_orderpriority").alias("_title"),
        F.lit("about").alias("description"),
        F.concat(F.lit("a:"), "o_orderpriority").alias("path"),
        F.array(number, number + 1).alias("ancestors"),
        F.array(number + 2).alias("children"),
        F.array(number + 3).alias("siblings"),
        F.array(
            F.concat(F.lit("https://www.example.org/"), "o_orderpriority", F.lit("/")),
            F.concat(F.lit("/Customer%20"), "o_custkey", F.lit("?x=1")),
        ).alias("encyc_urls"),
        F.when(F.col("o_custkey") > 500, F.col("o_custkey").cast("string")).otherwise("").alias("parent_id"),
        F.when(F.col("o_custkey") > 900, F.col("o_custkey").cast("string")).alias("weight"),
        F.lit("camp").alias("type"),
        F.array(F.struct(F.col("o_orderpriority").alias("label"), F.concat(F.lit("http://e.org/P"), "o_custkey", F.lit("/")).alias("url"))).alias("elinks"),
        F.struct(
            F.lit("here").alias("label"),
            F.struct(F.lit(1.5).alias("lat"), F.col("o_custkey").cast("double").alias("lng")).alias("geopoint"),
        ).alias("location"),
    )


@query(
    "facet_terms",
    """SELECT CASE WHEN t THEN 'topics-' ELSE 'facility-' END || o_orderkey AS id, o_orderkey::VARCHAR AS term_id, 'Order ' || o_orderkey AS title,
              CASE WHEN t THEN o_orderpriority END AS _title, CASE WHEN t THEN 'a:' || o_orderpriority END AS path,
              CASE WHEN t AND o_custkey > 500 THEN o_custkey END AS parent_id, CASE WHEN t AND o_custkey > 900 THEN o_custkey END AS weight,
              CASE WHEN t THEN o_orderkey || ',' || (o_orderkey + 1) END AS ancestors,
              CASE WHEN t THEN replace(o_orderpriority, '/', '') || '=' || o_orderpriority || ',Customer%20' || o_custkey || '=Customer ' || o_custkey
                   ELSE 'P' || o_custkey || '=' || o_orderpriority END AS encyc_urls,
              CASE WHEN NOT t THEN 'camp' END AS type, CASE WHEN NOT t THEN o_custkey::DOUBLE END AS lng
       FROM (SELECT *, o_orderstatus <> 'F' AS t FROM orders)""",
)
def facet_terms(spark, sf):
    terms = topics.build_terms(vocab(spark, sf))
    return terms.select(
        "id", "term_id", "title", "_title", "path", "parent_id", "weight",
        F.when(F.col("ancestors").isNotNull(), F.array_join(F.col("ancestors").cast("array<string>"), ",")).alias("ancestors"),
        F.array_join(F.transform("encyc_urls", lambda u: F.concat(u["url_title"], F.lit("="), u["title"])), ",").alias("encyc_urls"),
        "type",
        F.try_element_at("locations", F.lit(1))["geopoint"]["lng"].alias("lng"),
    )


@query(
    "terms_of_facet",
    "SELECT 'facility-' || o_orderkey AS id, 'facility' AS facet_id, 'Order ' || o_orderkey AS title, 'camp' AS type FROM orders WHERE o_orderstatus = 'F'",
)
def terms_of_facet(spark, sf):
    return topics.terms(topics.build_terms(vocab(spark, sf)), "facility")


@query("facets", "SELECT p_brand AS id, min(p_name) AS title, max(p_type) AS description FROM part GROUP BY 1")
def facets(spark, sf):
    part = table(spark, sf, "part")
    rows = part.groupBy(F.col("p_brand").alias("id")).agg(F.min("p_name").alias("title"), F.max("p_type").alias("description"))
    return topics.facets(rows)


@query(
    "vocabulary_scan",
    """SELECT o_orderkey::VARCHAR AS facet_id, unnest([0, 1]) AS pos, unnest(['a' || o_custkey, 'b' || o_custkey]) AS id,
              unnest([o_orderpriority, o_orderstatus]) AS title FROM orders""",
)
def vocabulary_scan(spark, sf):
    from folioflow.sources.schemas import VOCAB_JSON

    def term(letter, title):
        return F.struct(F.concat(F.lit(letter), "o_custkey").alias("id"), F.col(title).alias("title"))

    orders = table(spark, sf, "orders")
    terms = F.array(term("a", "o_orderpriority"), term("b", "o_orderstatus"))
    text = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("id"), F.lit("T").alias("title"), terms.alias("terms")))
    docs = orders.select(F.from_json(text, VOCAB_JSON).alias("doc")).select("doc.*")
    return readers.split_vocab(docs)[1].select("facet_id", "pos", "id", "title")


BY_URL = """WITH u AS (SELECT unnest([o_orderpriority, 'Customer%20' || o_custkey]) AS url_title, o_orderkey AS term_id
                      FROM orders WHERE o_orderstatus <> 'F')"""


def by_url(spark, sf):
    terms = topics.build_terms(vocab(spark, sf)).filter("facet_id = 'topics'")
    return topics.topics_by_url(terms.withColumn("term_id", F.col("term_id").cast("bigint")))


@query(
    "topics_by_url",
    BY_URL + "SELECT url_title, term_id, row_number() OVER (PARTITION BY url_title ORDER BY term_id) - 1 AS pos FROM u",
)
def topics_by_url(spark, sf):
    return by_url(spark, sf).select("url_title", "term_id", "pos")


@query(
    "article_topics",
    BY_URL + """SELECT url_title, term_id, 'https://repository.example.org/browse/topics/' || term_id || '/' AS ddr_topic_url
                FROM u WHERE url_title IN (SELECT 'Customer%20' || c_custkey FROM customer)""",
)
def article_topics(spark, sf):
    articles = table(spark, sf, "customer").select(F.concat(F.lit("Customer%20"), "c_custkey").alias("url_title"))
    rows = topics.article_topics(articles, by_url(spark, sf), "https://repository.example.org/browse/topics")
    return rows.select("url_title", "term_id", "ddr_topic_url")


def objects(spark, sf):
    """Line items are the objects of the part they sell."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("term_id"), "l_extendedprice", "l_orderkey", "l_linenumber", "l_suppkey",
        F.concat("l_orderkey", F.lit(".jpg")).alias("img_path"),
    )


@query(
    "related_topk",
    """SELECT term_id, rank, l_orderkey, 'http://media.example.org/media/' || l_orderkey || '.jpg' AS img_url_local FROM (
         SELECT l_partkey AS term_id, l_orderkey, row_number() OVER (
           PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey) AS rank FROM lineitem) WHERE rank <= 5""",
)
def related_topk(spark, sf):
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_suppkey"]
    rows = topics.related_objects(objects(spark, sf), 5, "http://media.example.org/media/", order)
    return rows.select("term_id", F.col("rank").cast("bigint").alias("rank"), "l_orderkey", "img_url_local")


@query(
    "topic_objects",
    """WITH r AS (SELECT p_brand AS term_id, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS rank FROM part)
       SELECT p_brand AS term_id, string_agg(p_partkey::VARCHAR, ',' ORDER BY rank) AS objects
       FROM (SELECT DISTINCT p_brand FROM part) b JOIN r ON r.term_id = p_brand AND rank <= 100 GROUP BY 1""",
)
def topic_objects(spark, sf):
    part = table(spark, sf, "part")
    rows = part.select(F.col("p_brand").alias("term_id"), F.col("p_partkey").cast("string").alias("obj_id"),
                       "p_retailprice", "p_partkey", F.lit("x.jpg").alias("img_path"))
    related = topics.related_objects(rows, 100, "http://media.example.org/media/", ["p_retailprice", "p_partkey"])
    nested = topics.objects_by_term(part.select(F.col("p_brand").alias("term_id")).distinct(), related)
    return nested.select("term_id", F.array_join(F.transform("objects", lambda o: o["obj_id"]), ",").alias("objects"))


ARTICLE_OBJECTS = """
  WITH t AS (SELECT c_name AS url_title, c_nationkey AS term_id, 0::BIGINT AS pos FROM customer
             UNION ALL SELECT c_name, c_nationkey + 1, 1 FROM customer),
       r AS (SELECT s_nationkey AS term_id, s_name AS obj_id, 'http://media.example.org/media/' || s_suppkey || '.jpg' AS img_url_local,
                    row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS rank FROM supplier),
       top AS (SELECT * FROM r WHERE rank <= 3)
"""


def article_objects_input(spark, sf):
    """Customers are the articles; their nation and the next one are the terms, suppliers the objects."""
    numbers = F.array(F.col("c_nationkey"), F.col("c_nationkey") + 1)
    articles = table(spark, sf, "customer").select(F.col("c_name").alias("url_title"), F.posexplode(numbers).alias("pos", "term_id"))
    objects = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("term_id"), F.col("s_name").alias("obj_id"),
        F.concat("s_suppkey", F.lit(".jpg")).alias("img_path"), "s_acctbal", "s_suppkey",
    )
    return articles, topics.related_objects(objects, 3, "http://media.example.org/media/", ["s_acctbal", "s_suppkey"])


@query(
    "article_term_objects",
    ARTICLE_OBJECTS + "SELECT url_title, pos, t.term_id, rank, obj_id, img_url_local FROM t LEFT JOIN top ON top.term_id = t.term_id",
)
def article_term_objects(spark, sf):
    return topics.article_term_objects(*article_objects_input(spark, sf))


@query(
    "article_objects",
    ARTICLE_OBJECTS + """SELECT url_title, pos, t.term_id, obj_id, img_url_local FROM t JOIN top ON top.term_id = t.term_id
       WHERE (top.term_id, rank) IN (SELECT (term_id, max(rank)) FROM top GROUP BY term_id)""",
)
def article_objects(spark, sf):
    return topics.article_objects(*article_objects_input(spark, sf), size=5)


SHARE = """
  WITH terms AS (SELECT DISTINCT s_nationkey AS term_id, s_nationkey::BIGINT AS term_pos FROM supplier
                 UNION ALL SELECT 100 + r_regionkey, 100 + r_regionkey FROM region),
       obj AS (SELECT c_nationkey AS term_id, c_name AS obj_id, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r
               FROM customer WHERE c_nationkey IN (SELECT term_id FROM terms)),
       per AS (SELECT r, (SELECT count(*) FROM terms) - count(*) AS missed FROM obj GROUP BY r),
       opened AS (SELECT r, coalesce(sum(missed) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS m FROM per),
       placed AS (SELECT term_id, term_pos, obj_id, r, row_number() OVER (ORDER BY r, term_pos) AS place
                  FROM obj JOIN terms USING (term_id) WHERE r IN (SELECT r FROM opened WHERE m < {limit})),
       shared AS (SELECT * FROM placed WHERE place <= {limit})
"""


def sharing(spark, sf):
    """Nations and regions are the terms, customers the objects of nations; regions have none."""

    def term(key):
        return key.cast("int").alias("term_id"), key.cast("bigint").alias("term_pos")

    nations = table(spark, sf, "supplier").select(*term(F.col("s_nationkey"))).distinct()
    terms = nations.unionByName(table(spark, sf, "region").select(*term(F.col("r_regionkey") + 100)))
    customers = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("term_id"), F.col("c_custkey").alias("pos"), F.col("c_name").alias("obj_id")
    )
    return customers, terms


@query("round_robin_list", SHARE.format(limit=150) + "SELECT term_id, place, obj_id FROM shared")
def round_robin_list(spark, sf):
    rows = topics.distribute(*sharing(spark, sf), limit=150)
    return rows.select("term_id", F.col("place").cast("bigint").alias("place"), "obj_id")


@query(
    "round_robin_nested",
    SHARE.format(limit=1200) + """SELECT t.term_id, t.term_pos, coalesce(string_agg(obj_id, ',' ORDER BY r), '') AS objects
                                  FROM terms t LEFT JOIN shared s ON s.term_id = t.term_id GROUP BY 1, 2""",
)
def round_robin_nested(spark, sf):
    rows = topics.distribute_nested(*sharing(spark, sf), limit=1200)
    return rows.select("term_id", "term_pos", F.array_join("objects", ",").alias("objects"))


BY_ARTICLE = """
  WITH obj AS (SELECT o_custkey AS article, o_orderstatus AS term_id, o_orderkey AS obj_id,
                      row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS r FROM orders),
       terms AS (SELECT c_custkey AS article, t.s AS term_id, t.p AS term_pos FROM customer, (VALUES ('F', 0), ('O', 1), ('P', 2), ('X', 3)) t(s, p)),
       per AS (SELECT article, r, 4 - count(*) AS missed FROM obj GROUP BY 1, 2),
       opened AS (SELECT article, r, coalesce(sum(missed) OVER (PARTITION BY article ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS m FROM per),
       placed AS (SELECT article, term_id, obj_id, r, row_number() OVER (PARTITION BY article ORDER BY r, term_pos) AS place
                  FROM obj JOIN terms USING (article, term_id) JOIN opened USING (article, r) WHERE m < 5)
"""


def by_article(spark, sf):
    """Per customer, the order states are the terms and the orders their objects."""
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("article"), F.col("o_orderstatus").alias("term_id"),
        F.col("o_orderkey").alias("pos"), F.col("o_orderkey").alias("obj_id"),
    )
    states = F.posexplode(F.array(*[F.lit(s) for s in "FOPX"])).alias("term_pos", "term_id")
    return orders, table(spark, sf, "customer").select(F.col("c_custkey").alias("article"), states)


@query("round_robin_by_article", BY_ARTICLE + "SELECT article, term_id, place, obj_id FROM placed WHERE place <= 5")
def round_robin_by_article(spark, sf):
    rows = topics.distribute(*by_article(spark, sf), limit=5, by=["article"])
    return rows.select("article", "term_id", F.col("place").cast("bigint").alias("place"), "obj_id")


@query("balance", "SELECT o_custkey AS article, o_orderstatus AS term_id, max(o_orderkey) AS obj_id FROM orders GROUP BY 1, 2")
def balance(spark, sf):
    return topics.balance(*by_article(spark, sf), size=5, by=["article"]).select("article", "term_id", "obj_id")


@query(
    "page_slice",
    """WITH n AS (SELECT o_orderkey, o_orderstatus <> 'P' AS published, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx FROM orders),
            p AS (SELECT *, CASE WHEN published THEN row_number() OVER (PARTITION BY published ORDER BY idx) END AS nth FROM n WHERE idx > 10),
            f AS (SELECT max(idx) AS last FROM p WHERE nth = 700)
       SELECT o_orderkey, published, idx, coalesce(nth <= 700, false) AS posted FROM p WHERE idx <= coalesce((SELECT last FROM f), idx)""",
)
def page_slice(spark, sf):
    items = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", (F.col("o_orderstatus") != "P").alias("published")
    )
    return topics.page_slice(items, ["o_orderdate", "o_orderkey"], start=10, num=700).drop("o_orderdate")


@query(
    "page_slice_all",
    """SELECT o_orderkey, o_orderstatus <> 'P' AS published, idx, o_orderstatus <> 'P' AS posted
       FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx FROM orders) WHERE idx > 0""",
)
def page_slice_all(spark, sf):
    items = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", (F.col("o_orderstatus") != "P").alias("published")
    )
    return topics.page_slice(items, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "large_topk",
    """SELECT l_returnflag, l_orderkey, l_extendedprice, rank FROM (SELECT *, row_number() OVER (
         PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey) AS rank FROM lineitem) WHERE rank <= 2000""",
)
def large_topk(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    rows = top_per_group(lines, ["l_returnflag"], [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_suppkey"], 2000)
    return rows.select("l_returnflag", "l_orderkey", "l_extendedprice", F.col("rank").cast("bigint").alias("rank"))
