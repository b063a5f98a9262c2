"""Paths and urls of media files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.text import basename, col, join_path


def _filled(c) -> Column:
    c = col(c)
    return c.isNotNull() & (c != "")


def relative_url(url, base: str) -> Column:
    return F.replace(col(url), F.lit(base), F.lit(""))


def absolute_path(url, base_url: str, base_dir: str) -> Column:
    """Local path of a file published under `base_url`; a doubled folder name is undone."""
    joined = join_path(F.lit(base_dir), relative_url(url, base_url))
    return F.replace(joined, F.lit("sources/sources"), F.lit("sources"))


def media_columns(name: str, site) -> dict[str, Column]:
    """Columns `<name>`, `_url`, `_path`, `_path_abs` for `original` or `display`."""
    url = F.coalesce(F.col(name), F.lit(""))
    have = _filled(name)
    return {
        name: basename(url),
        name + "_url": url,
        name + "_path": F.when(have, relative_url(url, site.sources_url)).otherwise(F.lit("")),
        name + "_path_abs": F.when(have, absolute_path(url, site.sources_url, site.sources_base)).otherwise(F.lit("")),
    }


def streaming_path_of(url, streamer: str) -> Column:
    """Streaming url relative to the streamer; empty when there is none."""
    return F.when(_filled(url), relative_url(url, streamer)).otherwise(F.lit(""))


def thumbnail_name(display, original) -> Column:
    """File name to make a thumbnail of: the display file, else the original."""
    return (
        F.when(_filled(display), basename(display))
        .when(_filled(original), basename(original))
        .otherwise(F.lit(""))
    )


def bucket_path(name, bucket: str) -> Column:
    return F.when(_filled(name), join_path(F.lit(bucket), name)).otherwise(F.lit(""))


def media_urls(site) -> dict[str, Column]:
    """Read-side urls of a source row; null where the file is absent."""
    stream = F.when(_filled("streaming_url"), join_path(F.lit(site.media_bucket), basename("streaming_url")))
    transcript = F.when(_filled("transcript"), join_path(F.lit(site.media_bucket), basename("transcript")))
    return {
        "img_url": join_path(F.lit(site.media_url), F.col("img_path")),
        "img_url_local": join_path(F.lit(site.media_url_local), F.col("img_path")),
        "rtmp_path": F.col("streaming_url"),
        "streaming_path": stream,
        "transcript_path": transcript,
        "transcript_url": join_path(F.lit(site.media_url), transcript),
    }
