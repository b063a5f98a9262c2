"""What changed between a source snapshot and a published snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEW, UPDATED, SAME, DELETED = "new", "updated", "same", "deleted"


def latest_per_key(rows: DataFrame, key: str, by: list[str]) -> DataFrame:
    """The last row of each key in the order of `by`; works key by key before the shuffle."""
    others = [c for c in rows.columns if c != key]
    picked = F.max_by(F.struct(*others), F.struct(*by))
    return rows.groupBy(key).agg(picked.alias("_row")).select(
        *[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in rows.columns]
    )


def latest_revision(revisions: DataFrame, key: str = "title", ts: str = "ts", name: str = "lastmod") -> DataFrame:
    """Time of the newest revision of each page."""
    return revisions.groupBy(key).agg(F.max(ts).alias(name))


def published_pages(members: DataFrame, revisions: DataFrame, category: str = "Published") -> DataFrame:
    """Published pages that are not categories themselves, with their newest revision."""
    published = members.filter((F.col("category") == category) & ~F.col("is_category")).select("title").distinct()
    return latest_revision(revisions).join(published, "title", "left_semi")


def published_authors(members: DataFrame, category: str = "Published", authors: str = "Authors") -> DataFrame:
    """Members of the author category that are published."""
    published = members.filter(F.col("category") == category).select("title")
    return members.filter(F.col("category") == authors).select("title").distinct().join(published, "title", "left_semi")


def new_keys(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    return source.select(key).join(target.select(key), key, "left_anti")


def deleted_keys(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    return target.select(key).join(source.select(key), key, "left_anti")


def updated_keys(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    newer = source.select(key, "lastmod").join(target.select(key, "modified"), key)
    return newer.filter(F.col("lastmod") > F.col("modified")).select(key)


def classify(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Every key of either side with its change, in one shuffle of the two key lists.

    `source` has `key, lastmod`, `target` has `key, modified`, each key once.
    """
    left = source.select(key, "lastmod", F.lit(True).alias("_in_source"))
    right = target.select(key, "modified", F.lit(True).alias("_in_target"))
    change = (
        F.when(F.col("_in_target").isNull(), NEW)
        .when(F.col("_in_source").isNull(), DELETED)
        .when(F.col("lastmod") > F.col("modified"), UPDATED)
        .otherwise(SAME)
    )
    return left.join(right, key, "full_outer").select(key, "lastmod", "modified", change.alias("change"))


def to_update(changes: DataFrame) -> DataFrame:
    """New and updated keys together."""
    return changes.filter(F.col("change").isin(NEW, UPDATED))


def split_authors(pages: DataFrame, author_titles: DataFrame, key: str = "title") -> tuple[DataFrame, DataFrame]:
    """(pages that are not authors, pages that are)."""
    names = author_titles.select(key)
    return pages.join(names, key, "left_anti"), pages.join(names, key, "left_semi")


def articles_to_update(author_titles: DataFrame, wiki_pages: DataFrame, stored: DataFrame, key: str = "title") -> DataFrame:
    return classify(split_authors(wiki_pages, author_titles, key)[0], stored, key)


def authors_to_update(author_titles: DataFrame, wiki_pages: DataFrame, stored: DataFrame, key: str = "title") -> DataFrame:
    return classify(split_authors(wiki_pages, author_titles, key)[1], stored, key)


def sources_to_update(records: DataFrame, stored: DataFrame, key: str = "encyclopedia_id") -> DataFrame:
    source = records.select(key, F.col("modified").alias("lastmod"))
    return classify(source, stored.select(key, "modified"), key)


def change_report(changes: DataFrame) -> DataFrame:
    """Number of keys of each change, without writing anything."""
    return changes.groupBy("change").agg(F.count("*").alias("n"))


def coverage(sides: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per document type: documents stored, documents at the source, and their ratio."""
    parts = []
    for doctype, (source, target) in sides.items():
        stored = target.agg(F.count("*").alias("stored"))
        total = source.agg(F.count("*").alias("total")) if source is not None else None
        row = stored.select(F.lit(doctype).alias("doctype"), "stored", F.lit(0).cast("bigint").alias("total"))
        parts.append(row)
        if total is not None:
            parts.append(total.select(F.lit(doctype).alias("doctype"), F.lit(0).cast("bigint").alias("stored"), "total"))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    sums = rows.groupBy("doctype").agg(F.sum("stored").alias("stored"), F.sum("total").alias("total"))
    return sums.withColumn("ratio", F.try_divide(F.col("stored").cast("double"), F.col("total")))
