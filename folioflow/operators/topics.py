"""Vocabulary terms, the pages they name, and the objects shared out among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.functions.text import join_path, url_title, url_unquote
from folioflow.operators.positions import top_per_group, with_position
from folioflow.session import spread

# Vocabulary names of either kind.
TOPICS = ["topics", "topic"]
FACILITIES = ["facilities", "facility"]


def _truthy_int(name: str):
    text = F.col(name)
    number = text.try_cast("bigint")
    return F.when((text != "") & ~text.isin("0"), number)


def build_terms(terms: DataFrame) -> DataFrame:
    """Raw vocabulary terms to facet term documents."""
    topic, facility = F.col("facet_id").isin(TOPICS), F.col("facet_id").isin(FACILITIES)
    none = F.array().cast("array<struct<url_title: string, title: string>>")
    named = F.transform(
        F.transform("encyc_urls", url_title),
        lambda u: F.struct(u.alias("url_title"), url_unquote(u).alias("title")),
    )
    labelled = F.transform(
        "elinks", lambda e: F.struct(url_title(e["url"]).alias("url_title"), e["label"].alias("title"))
    )
    key = F.concat_ws("-", "facet_id", F.col("id").cast("string"))
    only_topics = {c: F.when(topic, F.col(c)) for c in ("_title", "description", "path", "ancestors", "siblings", "children")}
    return spread(terms).select(
        key.alias("id"),
        "facet_id",
        F.col("id").alias("term_id"),
        "title",
        *[only_topics[c].alias(c) for c in ("_title", "description", "path")],
        F.when(topic, _truthy_int("parent_id")).alias("parent_id"),
        *[only_topics[c].alias(c) for c in ("ancestors", "siblings", "children")],
        F.when(topic, _truthy_int("weight")).alias("weight"),
        F.when(topic, F.coalesce(named, none)).when(facility, F.coalesce(labelled, none)).alias("encyc_urls"),
        F.when(facility, F.col("type")).alias("type"),
        F.when(facility, F.array("location")).alias("locations"),
    )


def terms(facet_terms: DataFrame, facet_id: str | None = None, limit: int | None = None) -> DataFrame:
    """Light terms of one vocabulary or of all, in id order."""
    rows = facet_terms if facet_id is None else facet_terms.filter(F.col("facet_id") == facet_id)
    rows = rows.select("id", "facet_id", "title", "type").orderBy("id")
    return rows if limit is None else rows.limit(limit)


def facets(facet_table: DataFrame, limit: int | None = None) -> DataFrame:
    rows = facet_table.select("id", "title", "description").orderBy("id")
    return rows if limit is None else rows.limit(limit)


def topics_by_url(facet_terms: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Rows (url_title, pos, term): the terms that name a page, in vocabulary order."""
    order = order or ["term_id"]
    edges = facet_terms.select(
        F.explode("encyc_urls").alias("_url"), "term_id", "title", "_title", *[c for c in order if c != "term_id"]
    )
    rows = edges.select(F.col("_url.url_title").alias("url_title"), *[c for c in edges.columns if c != "_url"])
    return with_position(rows, order, ["url_title"])


def article_topics(articles: DataFrame, by_url: DataFrame, topics_base: str) -> DataFrame:
    """Terms of each article with the address of the term's page."""
    url = F.format_string("%s/%s/", F.lit(topics_base), F.col("term_id"))
    return articles.select("url_title").join(by_url, "url_title").withColumn("ddr_topic_url", url)


def related_objects(objects: DataFrame, size: int, media_base: str, order: list[str] | None = None) -> DataFrame:
    """The first `size` objects of every term, with the address of their image."""
    top = top_per_group(objects, ["term_id"], order or ["pos"], size)
    return top.withColumn("img_url_local", join_path(F.lit(media_base), "img_path"))


def objects_by_term(topics: DataFrame, related: DataFrame) -> DataFrame:
    """Topics with a nested list of their related objects, at most `size` each."""
    nested = related.groupBy("term_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "obj_id", "img_url_local"))).alias("objects")
    )
    return topics.join(nested, "term_id", "left")


def article_term_objects(topics_of: DataFrame, related: DataFrame) -> DataFrame:
    """Rows (url_title, pos, term_id, …, rank, obj_id, img_url_local): the related objects of every
    term of every article, in order; a term without objects has one row with nulls.
    """
    return topics_of.join(related.select("term_id", "rank", "obj_id", "img_url_local"), "term_id", "left")


def article_objects(topics_of: DataFrame, related: DataFrame, size: int) -> DataFrame:
    """One object for every term of an article: the last of the term's related ones.

    That object is the same for all articles, so it is picked once per term before the join.
    """
    last = related.groupBy("term_id").agg(F.max_by(F.struct("obj_id", "img_url_local"), "rank").alias("_o"))
    picked = last.select("term_id", "_o.obj_id", "_o.img_url_local")
    rows = topics_of.select("url_title", "pos", "term_id").join(picked, "term_id")
    return rows if size >= 1 else rows.filter(F.lit(False))


def distribute(objects: DataFrame, terms: DataFrame, limit: int, by: list[str] | None = None) -> DataFrame:
    """Share out up to `limit` objects evenly: one of each term in turn, from the front.

    `terms` has (*by, term_id, term_pos) for every term, also empty ones; `objects` has
    (*by, term_id, pos, obj_id). `by` sets apart several sharings, such as one per article.
    The result has (*by, term_id, term_pos, round, place, obj_id), `place` from 1.

    Passes over the terms end at `limit` objects, and also before a pass that starts with
    `limit` or more empty-handed visits already counted.
    """
    kept = list(by or [])
    if not by:
        # One sharing for the whole table.
        by = ["_all"]
        objects, terms = objects.withColumn("_all", F.lit(0)), terms.withColumn("_all", F.lit(0))
    # Rounds past `limit` can never be reached, whatever the number of terms.
    drawn = top_per_group(objects, by + ["term_id"], ["pos"], limit, rank="round")
    drawn = drawn.join(terms.select(*by, "term_id", "term_pos"), by + ["term_id"])
    # One row per round and sharing, at most `limit` of them, after one (round 0) that counts the terms.
    hits = drawn.groupBy(*by, "round").agg(F.count("*").alias("_n"))
    counted = terms.groupBy(*by).agg(F.lit(0).alias("round"), F.count("*").alias("_n"))
    rounds = counted.unionByName(hits)
    sharing = Window.partitionBy(*by).orderBy("round")
    n_terms = F.first("_n").over(sharing)
    earlier = F.sum("_n").over(sharing.rowsBetween(Window.unboundedPreceding, -1)) - n_terms
    misses = n_terms * (F.col("round") - 1) - earlier
    open_rounds = rounds.withColumn("_misses", misses).filter((F.col("round") > 0) & (F.col("_misses") < limit)).select(*by, "round")
    reached = drawn.join(open_rounds, by + ["round"], "left_semi")
    placed = top_per_group(reached, by, ["round", "term_pos"], limit, rank="place")
    return placed.select(*kept, "term_id", "term_pos", "round", "place", "obj_id")


def distribute_nested(objects: DataFrame, terms: DataFrame, limit: int, by: list[str] | None = None) -> DataFrame:
    """Every term with the list of its shared-out objects, empty for a term without any."""
    by = by or []
    shared = distribute(objects, terms, limit, by)
    lists = shared.groupBy(*by, "term_id").agg(F.array_sort(F.collect_list(F.struct("round", "obj_id"))).alias("_drawn"))
    return terms.join(lists, by + ["term_id"], "left").select(
        *terms.columns,
        F.coalesce(F.transform("_drawn", lambda x: x["obj_id"]), F.array().cast("array<string>")).alias("objects"),
    )


def balance(objects: DataFrame, terms: DataFrame, size: int, by: list[str] | None = None) -> DataFrame:
    """The last object of every term that has any, in term order; nothing for a size below 1."""
    by = by or []
    last = objects.groupBy(*by, "term_id").agg(F.max_by("obj_id", "pos").alias("obj_id"))
    picked = last.join(terms.select(*by, "term_id", "term_pos"), by + ["term_id"])
    return picked if size >= 1 else picked.filter(F.lit(False))


def page_slice(items: DataFrame, order: list[str], start: int = 0, num: int | None = None) -> DataFrame:
    """Items after the one at index `start`: `posted` marks the first `num` published ones, all without `num`.

    Published items beyond `num` are left out, as are unpublished ones after the last posted
    item has filled the quota.
    """
    placed = with_position(items, order, name="idx").filter(F.col("idx") > start)
    if num is None:
        return placed.withColumn("posted", F.coalesce("published", F.lit(False)))
    # Quota by position among the published ones: a second numbering over the published rows only.
    published = with_position(placed.filter("published").select("idx"), ["idx"], name="_nth")
    posted = published.filter(F.col("_nth") < num)
    last = published.filter(F.col("_nth") == num - 1).select(F.col("idx").alias("_last"))
    marked = placed.join(posted.select("idx", F.lit(True).alias("_posted")), "idx", "left")
    full = last.agg(F.max("_last").alias("_last")).first()[0] if num >= 1 else -1
    if full is not None:
        marked = marked.filter(F.col("idx") <= full)
    return marked.withColumn("posted", F.coalesce("_posted", F.lit(False))).drop("_posted")
