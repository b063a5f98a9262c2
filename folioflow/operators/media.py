"""Media source records to documents, exports and file plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions import media as X
from folioflow.functions.dates import lenient_ts, record_text
from folioflow.functions.text import fix_external_url, none_strip, str_to_bool
from folioflow.operators.diff import latest_per_key
from folioflow.settings import Site
from folioflow.sources.schemas import SOURCE_EXPORT_FIELDS

TEXTS = ["caption", "caption_extended", "transcript", "courtesy"]
SAME = ["encyclopedia_id", "repository_id", "institution_id", "collection_name", "published", "headword"]


def build_sources(records: DataFrame, site: Site | None = None) -> DataFrame:
    """Raw media records to source documents.

    A record whose `creative_commons` is no truth word gets null there; see `unreadable_sources`.
    """
    site = site or Site()
    name = X.thumbnail_name("display", "original")
    size = F.when(F.col("original_size") != "", F.col("original_size").try_cast("bigint"))
    columns = {
        **{c: F.col(c) for c in SAME},
        "psms_id": F.col("id").try_cast("bigint"),
        "psms_api_uri": F.col("resource_uri"),
        "created": lenient_ts("created"),
        "modified": lenient_ts("modified"),
        "creative_commons": str_to_bool("creative_commons"),
        **X.media_columns("original", site),
        "original_size": size,
        **X.media_columns("display", site),
        "display_size": F.col("display_size"),
        "streaming_url": X.streaming_path_of("streaming_url", site.streamer),
        "external_url": fix_external_url("external_url", site.repository_url),
        "media_format": F.col("media_format"),
        "aspect_ratio": F.col("aspect_ratio"),
        **{c: none_strip(c) for c in TEXTS},
        "filename": name,
        "img_path": X.bucket_path(name, site.media_bucket),
    }
    return records.select(*[c.alias(n) for n, c in columns.items()])


def newest_keys(records: DataFrame) -> DataFrame:
    """(encyclopedia_id, modified, psms_id) of the newest record of each source, from these columns alone."""
    places = records.select(
        "encyclopedia_id", F.struct(lenient_ts("modified").alias("modified"), F.col("id").try_cast("bigint").alias("psms_id")).alias("place")
    )
    return places.groupBy("encyclopedia_id").agg(F.max("place").alias("place")).select("encyclopedia_id", "place.*")


def newest_sources(records: DataFrame, newest: DataFrame, site: Site | None = None) -> DataFrame:
    """Documents of the sources in `newest` (rows of `newest_keys`), one for each.

    Records are matched by key and place before anything is made of them: only those that will be documents are built, and
    of several at the same place one is taken.
    """
    own = newest.select(F.col("encyclopedia_id").alias("_key"), F.col("modified").alias("_modified"), F.col("psms_id").alias("_id"))
    same = (
        (F.col("encyclopedia_id") == F.col("_key"))
        & lenient_ts("modified").eqNullSafe(F.col("_modified"))
        & F.col("id").try_cast("bigint").eqNullSafe(F.col("_id"))
    )
    return latest_per_key(build_sources(records.join(own, same, "left_semi"), site), "encyclopedia_id", ["modified", "psms_id"])


def unreadable_sources(records: DataFrame) -> DataFrame:
    """Records set aside because a value cannot be read, with the reason."""
    reason = (
        F.when(str_to_bool("creative_commons").isNull(), "creative_commons")
        .when(F.col("id").try_cast("bigint").isNull(), "id")
        .when(lenient_ts("created").isNull(), "created")
        .when(lenient_ts("modified").isNull(), "modified")
    )
    return records.withColumn("reason", reason).filter("reason is not null")


def build_page_sources(edges: DataFrame, records: DataFrame, site: Site | None = None) -> DataFrame:
    """Documents of the sources shown on a page: headword is the page, values as in the record.

    `edges` has (url_title, encyclopedia_id).
    """
    site = site or Site()
    name = X.thumbnail_name("display", "original")
    same = ["encyclopedia_id", "repository_id", "institution_id", "collection_name", "created", "modified", "published",
            "creative_commons", "external_url", "media_format", "aspect_ratio", "original_size", "display_size", "display"]
    rows = edges.select("url_title", "encyclopedia_id").join(records, "encyclopedia_id")
    return rows.select(
        *same,
        F.col("id").alias("psms_id"),
        F.col("resource_uri").alias("psms_api_uri"),
        F.col("url_title").alias("headword"),
        F.col("original").alias("original_url"),
        X.streaming_path_of("streaming_url", site.streamer).alias("streaming_url"),
        *[none_strip(c).alias(c) for c in TEXTS],
        name.alias("filename"),
        X.bucket_path(name, site.media_bucket).alias("img_path"),
    )


def export_sources(sources: DataFrame) -> DataFrame:
    """Source documents as text records: truth values and times are written out."""
    rows = sources.withColumnRenamed("psms_id", "id").withColumnRenamed("psms_api_uri", "resource_uri")
    kinds = dict(rows.dtypes)

    def written(c):
        if kinds[c] == "boolean":
            return F.when(F.col(c), "true").when(~F.col(c), "false").alias(c)
        if kinds[c].startswith("timestamp"):
            return record_text(c).alias(c)
        return F.col(c)

    return rows.select(*[written(c) for c in SOURCE_EXPORT_FIELDS if c in kinds])


def with_media_urls(sources: DataFrame, site: Site | None = None) -> DataFrame:
    return sources.withColumns(X.media_urls(site or Site()))


def transfer_plan(sources: DataFrame) -> DataFrame:
    """Rows (encyclopedia_id, path): the files of every published source."""
    paths = F.array_compact(
        F.array(
            F.when(F.col("original") != "", F.col("original_path_abs")),
            F.when(F.col("display") != "", F.col("display_path_abs")),
        )
    )
    return sources.filter("published").select("encyclopedia_id", F.explode(paths).alias("path"))
