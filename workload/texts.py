"""Text, date and number expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.functions import dates, flags, media as X, text as T
from folioflow.plans.build import box_json
from folioflow.session import spread
from workload.registry import query, table

HREF = r'<a [^>]*href="([^"]*)"'


def page_hrefs(spark, sf):
    """Links of the raw pages, one row each."""
    pages = table(spark, sf, "pages")
    return pages.select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("href"))


@query(
    "title_sort",
    r"""WITH t AS (SELECT 'page-' || page_id AS id, '' AS sort_key, regexp_extract(html, '<title>([^<]*)', 1) AS title FROM pages
                   UNION ALL SELECT 'part-' || p_partkey, CASE WHEN p_size > 25 THEN p_name || ' #' || p_size ELSE '' END,
                          CASE WHEN p_type = 'SMALL' THEN 'the ' WHEN p_type = 'LARGE' THEN 'The ' ELSE 'a ' END || p_name FROM part)
        SELECT id, regexp_replace(lower(CASE WHEN sort_key <> '' THEN sort_key ELSE regexp_replace(title, '^(a|an|the) ', '') END),
                                  '[^\p{L}\p{N}]', '', 'g') AS title_sort FROM t""",
)
def title_sort(spark, sf):
    pages = table(spark, sf, "pages").select(
        F.concat(F.lit("page-"), "page_id").alias("id"), F.lit("").alias("sort_key"),
        F.regexp_extract("html", "<title>([^<]*)", 1).alias("title"),
    )
    article = F.when(F.col("p_type") == "SMALL", "the ").when(F.col("p_type") == "LARGE", "The ").otherwise("a ")
    parts = table(spark, sf, "part").select(
        F.concat(F.lit("part-"), "p_partkey").alias("id"),
        F.when(F.col("p_size") > 25, F.concat("p_name", F.lit(" #"), "p_size")).otherwise("").alias("sort_key"),
        F.concat(article, "p_name").alias("title"),
    )
    return pages.unionByName(parts).select("id", T.title_sort("sort_key", "title").alias("title_sort"))


@query(
    "strip_text",
    r"""SELECT doc_id, md5(regexp_replace(regexp_replace(coalesce(chr(160) || chr(9) || text || chr(8195) || chr(10), ''),
                                          '^[\s\x{A0}\x{2003}]+', ''), '[\s\x{A0}\x{2003}]+$', '')) AS stripped FROM documents""",
)
def strip_text(spark, sf):
    padded = F.concat(F.lit("\u00a0\t"), "text", F.lit("\u2003\n"))
    return table(spark, sf, "documents").select("doc_id", F.md5(T.none_strip(padded)).alias("stripped"))


@query(
    "absolute_urls",
    """SELECT s_suppkey AS id, '/authors/' || s_name || '/' AS author_url, '/sources/' || s_suppkey || '/' AS source_url,
              '/' || s_name || '/' AS page_url FROM supplier""",
)
def absolute_urls(spark, sf):
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        T.absolute_url("author", "s_name").alias("author_url"),
        T.absolute_url("source", F.col("s_suppkey").cast("string")).alias("source_url"),
        T.absolute_url("page", "s_name").alias("page_url"),
    )


@query(
    "file_names",
    r"""SELECT page_id, regexp_extract(url, '[^/]*$') AS name,
               CASE WHEN page_id > 100 THEN '/abs/' || page_id ELSE 'media/' || regexp_extract(url, '[^/]*$') END AS path FROM pages""",
)
def file_names(spark, sf):
    name = T.basename("url")
    second = F.when(F.col("page_id") > 100, F.concat(F.lit("/abs/"), "page_id")).otherwise(name)
    return table(spark, sf, "pages").select("page_id", name.alias("name"), T.join_path(F.lit("media"), second).alias("path"))


FILES = """CASE p_type WHEN 'SMALL' THEN 'en-part-' || p_partkey || '.v' || p_size || '.jpg'
                       WHEN 'LARGE' THEN '/images/thumb/a/a1/en-part-' || p_partkey || '.JPG/200px-en-part-' || p_partkey || '.JPG'
                       WHEN 'PROMO' THEN '/images/.hidden-' || p_partkey
                       ELSE '/images/a/en-part-' || p_partkey END"""


@query(
    "image_ids",
    rf"""WITH f AS (SELECT p_partkey, {FILES} AS uri FROM part)
         SELECT p_partkey, uri,
                regexp_replace(CASE WHEN contains(uri, 'thumb') THEN regexp_extract(uri, '([^/]*)/+[^/]*$', 1)
                                    ELSE regexp_extract(uri, '[^/]*$') END, '^(\.*[^.].*)\.[^.]*$', '\1') AS image_id FROM f""",
)
def image_ids(spark, sf):
    files = table(spark, sf, "part").select("p_partkey", F.expr(FILES).alias("uri"))
    return files.select("p_partkey", "uri", T.image_id("uri").alias("image_id"))


REPOSITORY = """CASE WHEN p_size > 25 THEN 'http://repository.example.org/ddr/test/' || p_partkey || '/' || p_size || '/'
                     WHEN p_size > 10 THEN 'http://repository.example.org/ddr-test-' || p_partkey || '/'
                     ELSE 'http://other.example.org/sn' || p_partkey END"""


@query(
    "external_urls",
    rf"""SELECT p_partkey, regexp_replace({REPOSITORY}, '^http://repository\.example\.org/(\w+)/(\w+)/(\d+)/(\d+)/',
                           'http://repository.example.org/\1-\2-\3-\4/') AS url FROM part""",
)
def external_urls(spark, sf):
    urls = table(spark, sf, "part").select("p_partkey", F.expr(REPOSITORY).alias("url"))
    return urls.select("p_partkey", T.fix_external_url("url", "http://repository.example.org").alias("url"))


WORDS = """CASE o_orderstatus WHEN 'O' THEN (CASE WHEN o_custkey > 700 THEN 'Yes' ELSE 'ON' END)
                              WHEN 'F' THEN (CASE WHEN o_custkey > 700 THEN 'off' ELSE '0' END) ELSE o_orderpriority END"""


@query(
    "truth_words",
    f"""SELECT o_orderkey, CASE WHEN lower({WORDS}) IN ('y','yes','t','true','on','1') THEN true
                                WHEN lower({WORDS}) IN ('n','no','f','false','off','0') THEN false END AS value FROM orders""",
)
def truth_words(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", T.str_to_bool(F.expr(WORDS)).alias("value"))


@query(
    "url_titles",
    r"""WITH u AS (SELECT 'page-' || page_id AS id, url FROM pages
                   UNION ALL SELECT 'part-' || p_partkey, 'https://www.example.org/wiki/' || replace(p_name, ' ', '%20') || '+%C3%A9/?a=/b' FROM part)
        SELECT id, replace(regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '[?#].*$', ''), '/', '') AS url_title,
               url_decode(replace(replace(regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '[?#].*$', ''), '/', ''), '+', '%2B')) AS title
        FROM u""",
)
def url_titles(spark, sf):
    pages = table(spark, sf, "pages").select(F.concat(F.lit("page-"), "page_id").alias("id"), "url")
    address = F.concat(
        F.lit("https://www.example.org/wiki/"), F.replace("p_name", F.lit(" "), F.lit("%20")), F.lit("+%C3%A9/?a=/b")
    )
    parts = table(spark, sf, "part").select(F.concat(F.lit("part-"), "p_partkey").alias("id"), address.alias("url"))
    rows = pages.unionByName(parts).withColumn("url_title", T.url_title("url"))
    return rows.select("id", "url_title", T.url_unquote("url_title").alias("title"))


@query(
    "domain_rewrite",
    """SELECT page_id, replace(url, 'example.com', 'stage.example.com') AS display,
              replace(url || '/big', 'example.com', 'stage.example.com') AS original FROM pages""",
)
def domain_rewrite(spark, sf):
    rows = table(spark, sf, "pages").select(
        "page_id", F.col("url").alias("display"), F.concat("url", F.lit("/big")).alias("original")
    )
    return T.replace_domain(rows, "example.com", "stage.example.com:8080")


@query(
    "link_titles",
    rf"""WITH h AS (SELECT page_id, '/wiki' || unnest(regexp_extract_all(html, '{HREF}', 1)) || '/' AS href FROM pages)
         SELECT page_id, href, regexp_replace(replace(regexp_replace(href, '/$', ''), '/wiki', ''), '^/', '') AS title, count(*) AS n
         FROM h GROUP BY ALL""",
)
def link_titles(spark, sf):
    hrefs = page_hrefs(spark, sf).select("page_id", F.concat(F.lit("/wiki"), "href", F.lit("/")).alias("href"))
    return hrefs.withColumn("title", T.href_title("href", "/wiki")).groupBy("page_id", "href", "title").agg(F.count("*").alias("n"))


@query(
    "dates",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS revision,
              o_orderdate AS lenient,
              strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS record_text, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso_text FROM orders""",
)
def date_forms(spark, sf):
    ts = F.col("o_orderdate")
    written = (
        F.when(F.col("o_orderstatus") == "O", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.date_format(ts, "MM/dd/yyyy HH:mm"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(ts, "d MMMM yyyy, HH:mm:ss"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(ts, "MMM d, yyyy"))
        .when(F.col("o_orderpriority") == "5-LOW", F.date_format(ts, "yyyyMMdd"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    )
    rows = spread(table(spark, sf, "orders")).withColumn("written", written)
    return rows.select(
        "o_orderkey", dates.revision_ts("written").alias("revision"), dates.lenient_ts("written").alias("lenient"),
        dates.record_text(ts).alias("record_text"), dates.iso_text(ts).alias("iso_text"),
    )


PLACE = """CASE WHEN c_mktsegment = 'BUILDING' THEN 'no box ' ELSE '<div id="databox-Camps"><p>' END
           || 'GISLat: ' || (CASE WHEN c_nationkey = 3 THEN '0.0' ELSE c_nationkey || '.5' END)
           || '; GISLo' || (CASE WHEN c_nationkey > 10 THEN 'o' ELSE '' END) || 'ng: 1.5; GISLong: -' || c_custkey || '.25;'"""


@query(
    "coordinates",
    """SELECT c_custkey, CASE WHEN there THEN -(c_custkey + 0.25) END AS lng, CASE WHEN there THEN c_nationkey + 0.5 END AS lat
       FROM (SELECT *, c_mktsegment <> 'BUILDING' AND c_nationkey <> 3 AS there FROM customer)""",
)
def coordinates(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", flags.coordinates(F.expr(PLACE)).alias("at"))
    return rows.select("c_custkey", "at.lng", "at.lat")



@query(
    "databox_json",
    """SELECT p_partkey, 'databox-Books|{"title":"' || p_name || '","brands":["' || p_brand || '","' || p_type || '"]}' AS databox FROM part""",
)
def databox_json(spark, sf):
    rows = """array(named_struct('key', 'title', 'raw', p_name, 'parts', cast(NULL AS array<string>)),
                    named_struct('key', 'brands', 'raw', '', 'parts', array(p_brand, p_type)))"""
    return table(spark, sf, "part").select("p_partkey", F.concat(F.lit("databox-Books|"), box_json(rows)).alias("databox"))


@query(
    "media_paths",
    """SELECT p_partkey, 'p' || p_partkey || '.jpg' AS original, '2012/p' || p_partkey || '.jpg' AS original_path,
              '/var/www/media/sources/2012/p' || p_partkey || '.jpg' AS original_path_abs,
              'https://sources.example.org/media/sources/2012/p' || p_partkey || '.jpg' AS original_url,
              CASE WHEN p_size > 25 THEN '/clip' || p_size || '.mp4' ELSE '' END AS streaming_url,
              'sources/p' || p_partkey || '.jpg' AS img_path FROM part""",
)
def media_paths(spark, sf):
    from folioflow.settings import Site

    site = Site()
    rows = table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit(site.sources_url + "2012/p"), "p_partkey", F.lit(".jpg")).alias("original"),
        F.when(F.col("p_size") > 25, F.concat(F.lit(site.streamer + "/clip"), "p_size", F.lit(".mp4"))).alias("stream"),
    )
    columns = X.media_columns("original", site)
    return rows.select(
        "p_partkey",
        *[c.alias(n) for n, c in columns.items()],
        X.streaming_path_of("stream", site.streamer).alias("streaming_url"),
        X.bucket_path(X.thumbnail_name(F.lit(""), "original"), site.media_bucket).alias("img_path"),
    )
