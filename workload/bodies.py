"""Page bodies: tokens, links, sections, databoxes, cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.functions import markup as M
from folioflow.operators import bodies
from workload.registry import query, table
from workload.texts import HREF


def page_tokens(spark, sf):
    return bodies.with_tokens(table(spark, sf, "pages").select("page_id", "html"))


@query(
    "token_counts",
    r"""SELECT page_id, len(regexp_extract_all(regexp_replace(html, '(?s)<script>.*?</script>', '', 'g'), '<a[ >]')) AS links,
               len(regexp_extract_all(regexp_replace(html, '(?s)<script>.*?</script>', '', 'g'), '<p>')) AS paragraphs,
               len(regexp_extract_all(html, '<!--')) AS comments, len(regexp_extract_all(html, '<(meta|br)')) AS voids FROM pages""",
)
def token_counts(spark, sf):
    def count(test):
        return F.size(M.elements("tokens", test)).cast("bigint")

    return page_tokens(spark, sf).select(
        "page_id",
        count(lambda t: M.is_start(t, "a")).alias("links"),
        count(lambda t: M.is_start(t, "p")).alias("paragraphs"),
        count(lambda t: f"{t}.kind = 'comment'").alias("comments"),
        count(lambda t: M.is_start(t, "meta", "br")).alias("voids"),
    )


@query(
    "link_classes",
    rf"""WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, '{HREF}', 1)) AS href FROM pages),
              t AS (SELECT *, regexp_replace(replace(regexp_replace(href, '/$', ''), '/wiki', ''), '^/', '') AS title FROM h),
              g AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS title FROM benchmark)
         SELECT page_id, href, CASE WHEN title IN (SELECT title FROM g) THEN 'encyc,rg' ELSE 'encyc,notrg' END AS class, count(*) AS n
         FROM t GROUP BY ALL""",
)
def link_classes(spark, sf):
    guide = table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("id"))
    links = bodies.page_links(page_tokens(spark, sf), "page_id", "/wiki")
    rows = bodies.classify_links(links, guide)
    return rows.groupBy("page_id", "href", "class").agg(F.count("*").alias("n"))


MIXED = """CASE o_orderpriority WHEN '1-URGENT' THEN '#note' || o_custkey WHEN '2-HIGH' THEN 'http://e.org/' || o_custkey
           WHEN '3-MEDIUM' THEN '/File:' || o_custkey || '.jpg' ELSE '/wiki/Customer_' || o_custkey || '/' END"""


@query(
    "built_link_classes",
    f"""SELECT o_orderkey AS url_title, {MIXED} AS href,
               CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN '' WHEN o_orderpriority = '2-HIGH' THEN 'offsite'
                    WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 4000) THEN 'encyc,rg' ELSE 'encyc,notrg' END AS class FROM orders""",
)
def built_link_classes(spark, sf):
    html = F.concat(F.lit("<p>see <a class='rg x' href=\""), F.expr(MIXED), F.lit('">it</a>'))
    pages = table(spark, sf, "orders").select(F.col("o_orderkey").alias("url_title"), html.alias("html"))
    guide = table(spark, sf, "customer").filter("c_acctbal > 4000").select(F.concat(F.lit("Customer "), "c_custkey").alias("id"))
    links = bodies.page_links(bodies.with_tokens(pages), "url_title", "/wiki")
    return bodies.classify_links(links, guide).select("url_title", "href", "class")


@query("descriptions")
def descriptions(spark, sf):
    return page_tokens(spark, sf).select("page_id", M.description("tokens").alias("description"))


@query(
    "built_descriptions",
    """SELECT doc_id, regexp_replace(string_split(text, chr(10))[1], '^[\\s]+|[\\s]+$', '', 'g') AS description FROM documents""",
)
def built_descriptions(spark, sf):
    safe = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    paragraphs = F.array_join(F.transform(F.split(safe, "\n"), lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>\n"))), "")
    html = F.concat(F.lit("<h1>x</h1><p></p><p>Title:x;\n</p>"), paragraphs)
    pages = table(spark, sf, "documents").select("doc_id", html.alias("html"))
    return bodies.with_tokens(pages).select("doc_id", M.description("tokens").alias("description"))


@query("clean_bodies")
def clean_bodies(spark, sf):
    guide = table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("id"))
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("url_title"), "html")
    return bodies.clean_bodies(pages, guide)


# A page of every kind of thing that cleaning looks at; {k}, {n}, {b} are the part's key, name and brand.
DIRTY = (
    "<p><br />\n</p><h1>{n}</h1><div class=\"alert alert-success published\">done</div><p>Hello <a href=\"/wiki/{b}\">b</a> "
    "<a href=\"/mediawiki/index.php?title={n}&amp;action=edit&amp;redlink=1\" class=\"q\">n</a></p>\n"
    "<h2><span class=\"mw-headline\" id=\"s{k}\">{n}</span><span class=\"mw-editsection\">[edit]</span></h2>\n<p>one &amp; two</p>\n"
    "<h2>plain</h2><div id=\"rgdatabox-CoreDisplay\"><p>{b}</p></div><div class=\"nopublish-encycfront\">x</div>"
    "<a class=\"image\" href=\"/File:p{k}.jpg\"><img src=\"/thumb/p{k}.jpg/200px-p{k}.jpg\"/></a>"
    "<a class=\"image\" href=\"/File:q.jpg\"><img src=\"/thumb/q.jpg/200px-q.jpg\"/></a>"
    "<a class=\"new\" href=\"/x\">up</a><h3>{b}</h3><h2>third</h2><p>end"
)

CLEAN = (
    "<p>Hello <a href=\"/wiki/{b}\" class=\"encyc {g}\">b</a> <a href=\"/{n}\" class=\"q encyc notrg\">n</a></p>\n"
    "<div class=\"section\" id=\"s{k}\"><h2><span class=\"mw-headline\" id=\"s{k}\">{n}</span></h2><div class=\"section_content\">"
    "\n<p>one &amp; two</p>\n</div></div>"
    "<h2>plain</h2><!--\"rgdatabox-CoreDisplay\" removed-->"
    "<a class=\"image\" href=\"/File:q.jpg\"><img src=\"/thumb/q.jpg/200px-q.jpg\"/></a>"
    "<h3>{b}</h3><div class=\"toplink\"><a href=\"#top\"><i class=\"icon-chevron-up\"></i> Top</a></div><h2>third</h2><p>end</p>"
    "<div class=\"toplink\"><a href=\"#top\"><i class=\"icon-chevron-up\"></i> Top</a></div>"
)


def _filled(template, quote=True):
    text = "'" + template.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    for mark, column in (("{k}", "p_partkey"), ("{n}", "p_name"), ("{b}", "replace(p_brand, '#', '')"), ("{g}", "CASE WHEN p_brand > 'Brand#2' THEN 'rg' ELSE 'notrg' END")):
        text = text.replace(mark, f"' || {column} || '")
    return text


def dirty_pages(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("url_title"),
        F.expr(_filled(DIRTY)).alias("html"),
        F.array(F.concat(F.lit("p"), "p_partkey")).alias("ids"),
    )


@query("built_clean_bodies", f"SELECT p_partkey AS url_title, {_filled(CLEAN)} AS body FROM part")
def built_clean_bodies(spark, sf):
    brands = table(spark, sf, "part").filter("p_brand > 'Brand#2'").select(F.replace("p_brand", F.lit("#"), F.lit("")).alias("id"))
    return bodies.clean_bodies(dirty_pages(spark, sf), brands, source_ids="ids")


@query(
    "page_sections",
    """SELECT p_partkey AS url_title, 0::BIGINT AS section_no, 's' || p_partkey AS section_id, p_name AS heading,
              chr(10) || '<p>one &amp; two</p>' || chr(10) AS content FROM part""",
)
def page_sections(spark, sf):
    tokens = bodies.with_tokens(dirty_pages(spark, sf).drop("ids"))
    tokens = tokens.withColumn("tokens", M.drop("tokens", M.edit_link))
    return bodies.sections(tokens, "url_title")


@query("front_flags", "SELECT p_partkey AS id, p_size > 25 AS published_encyc FROM part")
def front_flags(spark, sf):
    html = F.when(F.col("p_size") > 25, "<div class='x'>a</div>").otherwise("<p><div class='x nopublish-encycfront'>a</div>")
    pages = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), html.alias("html"))
    return bodies.with_tokens(pages).select("id", (~M.not_published_encyc("tokens")).alias("published_encyc"))


@query(
    "scrubbed_bodies",
    "SELECT p_partkey AS url_title, '<p>' || p_name || '</p><div class=\"alert\">keep</div>' AS body FROM part",
)
def scrubbed_bodies(spark, sf):
    body = F.concat(F.lit("<p>"), "p_name", F.lit('</p><div class="alert published"><p>x</p></div><div class="alert">keep</div>'))
    return bodies.scrub_bodies(table(spark, sf, "part").select(F.col("p_partkey").alias("url_title"), body.alias("body")))


BOX = """'<div id="databox-Books" style="display:none;"><p>Title:' || p_name || ': ' || p_brand || ';\\nSize: ' || p_size
         || '\\n' || (CASE WHEN p_size > 25 THEN 'odd\\n' ELSE '' END) || 'Illustrator:;\\nTITLE:' || p_type || ' ; ' || p_name || ';\\n</p></div>'"""


def boxed(spark, sf):
    pages = table(spark, sf, "part").select(F.col("p_partkey").alias("url_title"), F.expr(BOX).alias("html"))
    return bodies.with_tokens(pages)


@query(
    "databoxes",
    """SELECT p_partkey AS url_title, 'databox-Books' AS databox, unnest([0, 1, 2]) AS pos, unnest(['title', 'size', 'illustrator']) AS name,
              unnest([p_type || ' ; ' || p_name || ';', ' ' || p_size, ';']) AS raw, unnest([p_type || '|' || p_name, NULL, '']) AS parts FROM part""",
)
def databoxes(spark, sf):
    return bodies.databox_table(boxed(spark, sf), "url_title").withColumn("parts", F.array_join("parts", "|"))


@query(
    "databox_shape",
    """SELECT p_partkey AS url_title, 'databox-Books' AS databox, 2 AS n_cells, 4 AS n_rows FROM part
       UNION ALL SELECT p_partkey, 'databox-Books', 1, 1 FROM part WHERE p_size > 25""",
)
def databox_shape(spark, sf):
    return bodies.row_shapes(bodies.raw_box_rows(boxed(spark, sf), "url_title"), ["url_title", "databox"])


@query(
    "databox_anomalies",
    "SELECT p_partkey AS url_title, 'databox-Books' AS databox, p_size > 25 AS anomalous FROM part",
)
def databox_anomalies(spark, sf):
    return bodies.anomalies(bodies.raw_box_rows(boxed(spark, sf), "url_title"), ["url_title", "databox"])


@query(
    "databox_report",
    """SELECT 'name' AS kind, NULL AS url_title, 'databox-Books' AS databox
       UNION ALL SELECT 'anomaly', p_partkey, 'databox-Books' FROM part WHERE p_size > 25""",
)
def databox_report(spark, sf):
    names, odd, errors = bodies.databox_report(boxed(spark, sf), "url_title")
    none = F.lit(None).cast("bigint").alias("url_title")
    return (
        names.select(F.lit("name").alias("kind"), none, "databox")
        .unionByName(odd.select(F.lit("anomaly").alias("kind"), "url_title", "databox"))
        .unionByName(errors.select(F.lit("error").alias("kind"), "url_title", "databox"))
    )


@query(
    "bylines",
    """SELECT s_suppkey AS url_title, s_name || '|<i>X</i>' AS display, 'Sur' || s_suppkey || ',Given|Solo' AS parsed FROM supplier""",
)
def bylines(spark, sf):
    from folioflow.functions.people import names_sql

    html = F.concat(
        F.lit('<div id="authorByline"><b>Authored by <a href="/a">'), "s_name", F.lit('</a> and <a href="/b"><i>X</i> Y</a><a></a></b></div>'),
        F.lit('<div id="citationAuthor" style="display:none;"> Sur'), "s_suppkey", F.lit(", Given; Solo</div>"),
    )
    tokens = bodies.with_tokens(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("url_title"), html.alias("html")))
    names = F.expr(f"flatten(transform({M.citation_texts('tokens')}, x -> {names_sql('x')}))")
    return tokens.select(
        "url_title",
        F.array_join(M.byline_names("tokens"), "|").alias("display"),
        F.array_join(F.transform(names, lambda n: F.array_join(F.transform(n, lambda x: F.trim(x)), ",")), "|").alias("parsed"),
    )
