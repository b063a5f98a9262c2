"""Citations of articles in all styles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.people import STYLES, cite
from folioflow.functions.text import absolute_url
from folioflow.session import spread
from folioflow.settings import Site


def _first_of(df: DataFrame, *names: str):
    have = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*have) if have else F.lit(None)


def cite_articles(articles: DataFrame, site: Site | None = None, retrieved=None) -> DataFrame:
    """Title, dates and author lists of every article; `retrieved` defaults to now."""
    site = site or Site()
    filled = [c for c in ("title", "caption") if c in articles.columns]
    title = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in filled])
    return spread(articles).select(
        "url_title",
        absolute_url("page", "url_title").alias("uri"),
        title.alias("title"),
        _first_of(articles, "lastmod", "modified").alias("lastmod"),
        (F.localtimestamp() if retrieved is None else F.lit(retrieved)).alias("retrieved"),
        *[cite(style, "authors_data.parsed", site.default_authors).alias(style) for style in STYLES],
    )
