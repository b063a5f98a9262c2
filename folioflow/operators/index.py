"""Navigation and index tables: A–Z list, neighbours, columns, categories, letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import first_letter
from folioflow.operators.positions import with_neighbours, with_position


def articles_a_z(published: DataFrame, author_titles: DataFrame, key: str = "title") -> DataFrame:
    """Published titles that are not authors; sort by `key` for the list itself."""
    return published.select(key).distinct().join(author_titles.select(key), key, "left_anti")


def neighbours(titles: DataFrame, key: str = "title") -> DataFrame:
    """Previous and next title in the A–Z list; the first title's previous is the last one."""
    return with_neighbours(titles.select(key).distinct(), key, "prev_page", "next_page", wrap=True)


def columns_layout(items: DataFrame, order: list[str], columns: int) -> DataFrame:
    """Column number and place of each item when a sorted list is set in `columns` columns."""
    placed = with_position(items, order, name="_pos", total="_total")
    length = F.bround(F.col("_total") / F.lit(float(columns))).cast("bigint") + 1
    return placed.select(
        *items.columns,
        F.floor(F.col("_pos") / length).cast("bigint").alias("column_no"),
        (F.col("_pos") % length).cast("bigint").alias("row_no"),
    )


def pages_by_category(pages: DataFrame, hidden: list[str], page: str = "url_title", order: list[str] | None = None) -> DataFrame:
    """Rows (category, pos, page): the pages of each category, once each, in listing order."""
    order = order or [page]
    edges = pages.select(page, *[c for c in order if c != page], F.explode("categories").alias("category"))
    return with_position(edges.filter(~F.col("category").isin(hidden)).distinct(), order, ["category"])


def category_sizes(pages: DataFrame, hidden: list[str], page: str = "url_title") -> DataFrame:
    """How many pages each shown category has."""
    edges = pages.select(F.col(page).alias("_page"), F.explode(F.array_distinct("categories")).alias("category"))
    return edges.filter(~F.col("category").isin(hidden)).groupBy("category").agg(F.count("*").alias("n_pages"))


def letter_index(titles: DataFrame, sort_key: str, key: str) -> DataFrame:
    """Rows (letter, pos, key): titles under the upper-cased first letter of their sort key."""
    rows = titles.select(first_letter(sort_key).alias("letter"), F.col(sort_key).alias("sort_key"), F.col(key).alias("title"))
    return with_position(rows, ["sort_key", "title"], ["letter"])


def letter_counts(titles: DataFrame, sort_key: str) -> DataFrame:
    return titles.groupBy(first_letter(sort_key).alias("letter")).agg(F.count("*").alias("n"))


def category_names(members: DataFrame, parent: str = "Articles") -> DataFrame:
    """Names of the sub-categories of `parent`: the second colon-separated piece of the title."""
    rows = members.filter((F.col("category") == parent) & F.col("is_category"))
    return rows.select(F.try_element_at(F.split("title", ":"), F.lit(2)).alias("name")).filter("name is not null").distinct()


def whitelisted_categories(pages: DataFrame, names: DataFrame, key: str = "url_title") -> DataFrame:
    """Rows (key, pos, category): page categories that are among `names`, underscores read as spaces."""
    rows = pages.select(key, F.posexplode("categories").alias("pos", "category"))
    plain = names.select(F.translate("name", "_", " ").alias("_name")).distinct()
    return rows.join(plain, F.translate("category", "_", " ") == F.col("_name"), "left_semi")
