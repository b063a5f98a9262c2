"""Raw wiki pages to article and author documents.

What other tables know about a page is first gathered by key on narrow rows, which are written once. The page text is
joined to these facts once and tokenized after that, so neither tokens nor bodies are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import flags, markup as M, people
from folioflow.functions.text import absolute_url, default_sort, none_strip, title_sort
from folioflow.operators import bodies, diff, index, links
from folioflow.operators.links import flag_members
from folioflow.session import cut
from folioflow.settings import Site

NO_STRINGS = "array<string>"


def page_facts(pages: DataFrame, members: DataFrame, revisions: DataFrame, sources: DataFrame) -> DataFrame:
    """(url_title, lastmod, is_article, is_author, prev_page, next_page, categories, source_ids)."""
    published = diff.published_pages(members, revisions)
    authors = members.filter((F.col("category") == "Authors") & ~F.col("is_category")).select("title").distinct()
    beside = index.neighbours(index.articles_a_z(published, authors))
    # The page records are read once for all narrow joins, and once more for their text.
    found = cut(
        pages.filter("status_code = 200").select(
            "url_title", F.transform("categories", lambda c: c["*"]).alias("categories"), "images"
        )
    )
    shown = index.whitelisted_categories(found.select("url_title", "categories"), index.category_names(members))
    lists = shown.groupBy("url_title").agg(F.array_sort(F.collect_list(F.struct("pos", "category"))).alias("_c"))
    categories = lists.select("url_title", F.transform("_c", lambda x: x["category"]).alias("categories"))
    ids = links.source_id_lists(links.primary_sources(found.select("url_title", "images"), sources))
    # The wiki's lists name pages by their key; a display title may differ from it.
    facts = flag_members(found.select("url_title"), published, "url_title", "is_article", "title")
    facts = flag_members(facts, authors, "url_title", "is_author", "title")
    facts = facts.join(beside.withColumnRenamed("title", "url_title"), "url_title", "left")
    facts = facts.join(diff.latest_revision(revisions).withColumnRenamed("title", "url_title"), "url_title", "left")
    return facts.join(categories, "url_title", "left").join(ids, "url_title", "left")


def box_json(rows: str) -> Column:
    """Databox rows as one JSON object; values are text, or lists where they had semicolons.

    `rows` is the SQL of an array of rows (key, raw, parts).
    """
    return F.expr(_box_json(rows))


def _box_json(rows: str) -> str:
    def quoted(text):
        return f"regexp_replace(to_json(array({text})), r'^\\[|\\]$', '')"

    pairs = f"transform({rows}, r -> concat({quoted('r.key')}, ':', coalesce(to_json(r.parts), {quoted('r.raw')})))"
    return f"concat('{{', array_join({pairs}, ','), '}}')"


def _field(boxes: str, box: str, name: str) -> Column:
    """Values of one databox field: its parts, or its text as a list of one; null if not there."""
    rows = f"flatten(filter({boxes}, b -> b.databox = '{box}').rows)"
    values = f"transform(filter({rows}, r -> r.key = '{name}'), r -> coalesce(r.parts, array(r.raw)))"
    return F.expr(f"try_element_at({values}, 1)")


def flatten_databoxes(articles: DataFrame, site: Site, boxes: str = "boxes") -> DataFrame:
    """Databoxes as text columns: `BOX|json` strings, and `<prefix>_<field>` for prefixed boxes."""
    names = ", ".join(f"'{name}'" for name in site.databoxes)
    kept = f"filter({boxes}, b -> b.databox IN ({names}) AND size(b.rows) > 0)"
    texts = F.expr(f"transform({kept}, b -> concat(b.databox, '|', {_box_json('b.rows')}))")
    columns = {"databoxes": texts}
    for box, prefix in site.databoxes.items():
        if prefix:
            columns.update({f"{prefix}_{name}": _field(boxes, box, name) for name in site.rg_fields})
    return articles.withColumns(columns)


def published_rg(boxes: str) -> Column:
    """The core databox names a media type."""
    values = _field(boxes, "rgdatabox-Core", "rgmediatype")
    return F.coalesce(F.exists(values, lambda v: v != ""), F.lit(False))


def build_pages(
    pages: DataFrame, members: DataFrame, revisions: DataFrame, sources: DataFrame,
    guide=(), site: Site | None = None, migration: bool = False, where: str = "true",
) -> DataFrame:
    """Every found page with all columns that article and author documents are made of.

    `where` is a condition on the facts about a page; it is applied before any page text is read.
    """
    site = site or Site()
    facts = page_facts(pages, members, revisions, sources)
    rows = pages.filter("status_code = 200").select(
        "url_title",
        flags.is_published("categories").alias("published"),
        F.col("title").alias("displaytitle"),
        title_sort(default_sort("properties"), "title").alias("title_sort"),
        "html",
    )
    if not isinstance(guide, DataFrame) and len(list(guide)) > bodies.LITERAL_TITLES:
        guide = pages.sparkSession.createDataFrame([(t,) for t in guide], "id string")
    rows = rows.join(facts.filter(where), "url_title").withColumn("guide", _guide_titles(guide))
    if isinstance(guide, DataFrame):
        found = bodies.linked_titles(pages, "url_title", site.guide_base)
        known = bodies.guide_titles_per_page(found, guide, "url_title")
        rows = rows.drop("guide").join(known, "url_title", "left").withColumn("guide", F.coalesce("guide", _guide_titles(())))
    text = rows.withColumn("coordinates", flags.coordinates("html"))
    df = bodies.with_tokens(text)
    df = df.withColumns(
        {
            "published_encyc": ~M.not_published_encyc("tokens"),
            "boxes": M.databoxes("tokens", list(site.databoxes)),
            "authors_data": F.struct(
                M.byline_names("tokens").alias("display"),
                F.expr(f"flatten(transform({M.citation_texts('tokens')}, x -> {people.names_sql('x')}))").alias("parsed"),
            ),
        }
    )
    df = bodies.clean_tokens(df, site, migration=migration)
    df = df.withColumns({"description": M.description("tokens"), "body": none_strip(bodies.body_text("tokens"))}).drop("tokens")
    return df.withColumns(
        {
            "public": F.lit(False),
            "published_rg": published_rg("boxes"),
            "mw_api_url": absolute_url("page", "url_title"),
            "title": none_strip("displaytitle"),
        }
    )


def _guide_titles(guide):
    if isinstance(guide, DataFrame):
        guide = ()
    return F.array(*[F.lit(t) for t in guide]).cast(NO_STRINGS)


def build_articles(
    pages: DataFrame, members: DataFrame, revisions: DataFrame, sources: DataFrame,
    guide=(), site: Site | None = None, migration: bool = False,
) -> DataFrame:
    """Article documents; what only articles have is empty for other pages."""
    site = site or Site()
    df = flatten_databoxes(build_pages(pages, members, revisions, sources, guide, site, migration), site)
    article, empty = F.col("is_article"), F.array().cast(NO_STRINGS)
    nobody = F.struct(empty.alias("display"), F.array().cast("array<array<string>>").alias("parsed"))
    prefixed = [c for c in df.columns if any(p and c.startswith(p + "_") for p in site.databoxes.values())]
    return df.select(
        "url_title", "public", "published", "published_encyc", "published_rg",
        F.col("lastmod").alias("modified"),
        "mw_api_url", "title_sort", "title",
        F.when(article, F.col("description")).alias("description"),
        "body",
        F.when(article, F.coalesce("prev_page", F.lit(""))).alias("prev_page"),
        F.when(article, F.coalesce("next_page", F.lit(""))).alias("next_page"),
        F.coalesce(F.when(article, F.col("categories")), empty).alias("categories"),
        F.when(article, F.col("coordinates")).alias("coordinates"),
        F.coalesce("source_ids", empty).alias("source_ids"),
        F.when(article, F.col("authors_data")).otherwise(nobody).alias("authors_data"),
        "databoxes",
        *prefixed,
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Edges (source, target) from the link lists of the page records."""
    return pages.filter("status_code = 200").select(
        F.col("url_title").alias("source"), F.explode("links").alias("link")
    ).select("source", F.col("link")["*"].alias("target"))


def build_authors(
    pages: DataFrame, members: DataFrame, revisions: DataFrame, sources: DataFrame,
    edges: DataFrame | None, guide=(), site: Site | None = None, migration: bool = False, counts: DataFrame | None = None,
) -> DataFrame:
    """Author documents. `article_titles` holds all titles that link to the author, `n_articles` their number;
    `links.author_titles` has the same as rows. With `counts` (target, n_articles) in place of `edges` the list stays empty.
    """
    df = build_pages(pages, members, revisions, sources, guide, site, migration, where="is_author")
    if counts is None:
        wanted = pages.select(F.col("url_title").alias("target"))
        lists = links.whole_lists(links.backlink_lists(edges.join(wanted, "target", "left_semi")))
        titles = lists.select(F.col("target").alias("url_title"), F.col("titles").alias("article_titles"), F.col("n").alias("n_articles"))
    else:
        titles = counts.select(F.col("target").alias("url_title"), F.lit(None).cast(NO_STRINGS).alias("article_titles"), "n_articles")
    return df.join(titles, "url_title", "left").select(
        "url_title", "public", "published", F.col("lastmod").alias("modified"), "mw_api_url",
        "title_sort", "title", "body",
        F.coalesce("article_titles", F.array().cast(NO_STRINGS)).alias("article_titles"),
        F.coalesce("n_articles", F.lit(0).cast("bigint")).alias("n_articles"),
    )


def article_records(articles: DataFrame) -> DataFrame:
    """The fields of an article that are handed out as a plain record."""
    from folioflow.sources.schemas import ARTICLE_RECORD_FIELDS

    return articles.select(*ARTICLE_RECORD_FIELDS)
