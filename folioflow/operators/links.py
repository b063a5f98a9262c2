"""Matching pages, authors, sources and files with one another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import image_id
from folioflow.operators.positions import with_position
from folioflow.session import spread

# Titles in one list row; longer lists go on in further rows.
LIST_SIZE = 10_000


def backlinks(links: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """Distinct (target, source) edges: which pages link to a page."""
    return links.select(target, source).distinct()


def backlink_lists(edges: DataFrame, target: str = "target", source: str = "source", size: int = LIST_SIZE) -> DataFrame:
    """Rows (target, part, n, titles): sorted lists of linking pages, `size` at most in a row.

    Part 0 is the whole list of any page with up to `size` links to it; a page with more has
    further parts, so that no task ever holds an unbounded list.
    """
    placed = with_position(edges.select(target, source), [source], [target], name="_pos", total="_total")
    part = F.floor(F.col("_pos") / F.lit(size)).cast("int").alias("part")
    return placed.groupBy(target, part).agg(
        F.max("_total").alias("n"), F.array_sort(F.collect_list(source)).alias("titles")
    )


def whole_lists(lists: DataFrame, target: str = "target") -> DataFrame:
    """(target, n, titles): the rows of `backlink_lists` of each page put together, as a document holds them."""
    parts = F.array_sort(F.collect_list(F.struct("part", "titles")))
    return lists.groupBy(target).agg(F.max("n").alias("n"), F.flatten(F.transform(parts, lambda x: x["titles"])).alias("titles"))


def author_titles(edges: DataFrame, target: str = "target", source: str = "source") -> DataFrame:
    """Rows (target, pos, source): the pages that link to a page, in order, however many."""
    return with_position(edges.select(target, source), [source], [target])


def primary_sources(pages: DataFrame, sources: DataFrame, key: str = "url_title") -> DataFrame:
    """Rows (key, pos, encyclopedia_id): page images that are media sources, in page order."""
    # Ids are made inside the array: a filter on them would otherwise make them twice.
    found = spread(pages.select(key, "images")).select(key, F.posexplode(F.transform("images", image_id)).alias("pos", "encyclopedia_id"))
    ids = found.filter(F.col("encyclopedia_id") != "")
    first = ids.groupBy(key, "encyclopedia_id").agg(F.min("pos").alias("pos"))
    return first.join(sources.select("encyclopedia_id"), "encyclopedia_id", "left_semi").select(key, "pos", "encyclopedia_id")


def source_id_lists(primary: DataFrame, key: str = "url_title") -> DataFrame:
    """(key, source_ids): bounded by the number of images on one page."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "encyclopedia_id")))
    return primary.groupBy(key).agg(F.transform(ordered, lambda x: x["encyclopedia_id"]).alias("source_ids"))


def author_articles(edges: DataFrame, articles: DataFrame, author: str = "target", page: str = "source") -> DataFrame:
    """Articles of each author, over the edges of `backlinks`."""
    return edges.join(articles, F.col(page) == articles["url_title"]).drop(page).withColumnRenamed(author, "author")


def article_authors(articles: DataFrame, authors: DataFrame, key: str = "url_title") -> DataFrame:
    """Rows (key, pos, display, author): the author document's key, else the bare name."""
    names = articles.select(key, F.posexplode("authors_data.display").alias("pos", "display"))
    known = authors.select(F.col("url_title").alias("_author"), F.col("title").alias("author_title"))
    return names.join(known, F.col("display") == F.col("_author"), "left").select(
        key, "pos", "display", F.coalesce("_author", "display").alias("author"),
        F.col("_author").isNotNull().alias("has_document"), "author_title",
    )


def article_sources(articles: DataFrame, sources: DataFrame, key: str = "url_title") -> DataFrame:
    """Source rows of each article; `found` is false for an id without a source."""
    ids = articles.select(F.col(key), F.posexplode("source_ids").alias("pos", "source_id"))
    return ids.join(sources, F.col("source_id") == F.col("encyclopedia_id"), "left").withColumn(
        "found", F.col("encyclopedia_id").isNotNull()
    )


def source_article(sources: DataFrame, articles: DataFrame) -> DataFrame:
    """The article each source belongs to by its headword; null if it has none."""
    pages = articles.select(F.col("url_title").alias("article"), F.col("title").alias("article_title"))
    return sources.join(pages, (F.col("headword") != "") & (F.col("headword") == F.col("article")), "left")


def with_presence(plan: DataFrame, files: DataFrame) -> DataFrame:
    """Planned files with a flag telling whether the file is there."""
    have = files.select("path").distinct().withColumn("present", F.lit(True))
    return plan.join(have, "path", "left").withColumn("present", F.coalesce("present", F.lit(False)))


def flag_members(rows: DataFrame, members: DataFrame, key: str, flag: str, member_key: str | None = None) -> DataFrame:
    """Add `flag`: whether the row's key is among `members`."""
    have = members.select(F.col(member_key or key).alias("_member")).distinct().withColumn("_there", F.lit(True))
    return rows.join(have, F.col(key) == F.col("_member"), "left").withColumn(
        flag, F.coalesce("_there", F.lit(False))
    ).drop("_member", "_there")
