"""Media records to source documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioflow.operators import links, media
from folioflow.session import work_dir
from folioflow.settings import Site
from folioflow.sources import readers
from workload.registry import query, table

SITE = Site()

RECORD = {
    "id": "cast(p_partkey as string)",
    "encyclopedia_id": "'en-' || p_partkey",
    "repository_id": "'ddr-' || p_size",
    "resource_uri": "'/api/sources/' || p_partkey || '/'",
    "institution_id": "p_brand",
    "collection_name": "p_type",
    "created": "'2012-08-' || lpad(cast(1 + p_size / 2 as string), 2, '0') || ' 10:11:12'",
    "modified": "'2013-08-' || lpad(cast(1 + p_size / 2 as string), 2, '0') || 'T10:11:12.5'",
    "published": "p_size > 5",
    "creative_commons": "case p_type when 'SMALL' then 'Yes' when 'LARGE' then 'perhaps' else 'false' end",
    "headword": "p_name",
    "original": "case when p_size > 45 then '' else 'https://sources.example.org/media/sources/2012/en-' || p_partkey || '.tif' end",
    "original_size": "case when p_size > 45 then '' else cast(p_size * 1000 as string) end",
    "display": "case when p_size > 25 then '' else 'https://sources.example.org/media/sources/sources/en-' || p_partkey || '.jpg' end",
    "display_size": "cast(p_size as string)",
    "streaming_url": "case when p_type = 'PROMO' then 'rtmp://streaming.example.org/stream/mp4:' || p_partkey end",
    "external_url": "'http://repository.example.org/ddr/test/' || p_partkey || '/' || p_size || '/'",
    "media_format": "'image'",
    "aspect_ratio": "'hd'",
    "caption": "' ' || p_name || ' '",
    "caption_extended": "cast(null as string)",
    "transcript": "case when p_type = 'PROMO' then 'https://x.example.org/t/' || p_partkey || '.htm' end",
    "courtesy": "'Courtesy of ' || p_brand || chr(10)",
}

# The same records for SQL: whole-number division is written differently there.
RAW = "SELECT " + ", ".join(f"{e.replace('p_size / 2', 'p_size // 2')} AS {n}" for n, e in RECORD.items()) + " FROM part"

STORED = f"""
  WITH r AS ({RAW}), s AS (
    SELECT encyclopedia_id, repository_id, institution_id, collection_name, published, headword, id::BIGINT AS psms_id,
           resource_uri AS psms_api_uri, created::TIMESTAMP AS created, modified::TIMESTAMP AS modified,
           CASE lower(creative_commons) WHEN 'yes' THEN true WHEN 'false' THEN false END AS creative_commons,
           regexp_extract(original, '[^/]*$') AS original, original AS original_url,
           replace(original, 'https://sources.example.org/media/sources/', '') AS original_path,
           CASE WHEN original = '' THEN '' ELSE '/var/www/media/sources/2012/' || regexp_extract(original, '[^/]*$') END AS original_path_abs,
           TRY_CAST(nullif(original_size, '') AS BIGINT) AS original_size,
           regexp_extract(display, '[^/]*$') AS display, display AS display_url,
           replace(display, 'https://sources.example.org/media/sources/', '') AS display_path,
           CASE WHEN display = '' THEN '' ELSE '/var/www/media/sources/' || regexp_extract(display, '[^/]*$') END AS display_path_abs,
           display_size, coalesce(replace(streaming_url, 'rtmp://streaming.example.org/stream', ''), '') AS streaming_url,
           regexp_replace(external_url, '/ddr/test/([0-9]+)/([0-9]+)/', '/ddr-test-\\1-\\2/') AS external_url,
           media_format, aspect_ratio, trim(caption) AS caption, '' AS caption_extended, coalesce(transcript, '') AS transcript,
           trim(courtesy, ' ' || chr(10)) AS courtesy
    FROM r),
  src AS (SELECT *, CASE WHEN display <> '' THEN display ELSE original END AS filename FROM s)
"""


def records(spark, sf):
    part = table(spark, sf, "part")
    return part.select(*[F.expr(e.replace("p_size / 2", "p_size div 2")).alias(n) for n, e in RECORD.items()])


DOCUMENTS = STORED + "SELECT *, CASE WHEN filename = '' THEN '' ELSE 'sources/' || filename END AS img_path FROM src"


@query("source_documents", DOCUMENTS)
def source_documents(spark, sf):
    return media.build_sources(records(spark, sf), SITE)


@query("source_files", DOCUMENTS)
def source_files(spark, sf):
    """The same records from feed files that name the repository's id in their own way."""
    path = work_dir(spark, "source-files")
    records(spark, sf).withColumnRenamed("repository_id", "partner_id").write.json(path)
    return media.build_sources(readers.read_sources(spark, path, repository_id="partner_id"), SITE)


@query(
    "whole_numbers",
    "SELECT p_partkey::BIGINT AS id, CASE WHEN p_size <= 45 THEN p_size::BIGINT * 1000 END AS original_size FROM part",
)
def whole_numbers(spark, sf):
    return media.build_sources(records(spark, sf), SITE).select(F.col("psms_id").alias("id"), "original_size")


@query(
    "published_sources",
    f"WITH r AS ({RAW}) SELECT encyclopedia_id, headword FROM r WHERE published",
)
def published_sources(spark, sf):
    return readers.published_sources(records(spark, sf)).select("encyclopedia_id", "headword")


@query(
    "unreadable_sources",
    f"WITH r AS ({RAW}) SELECT encyclopedia_id, 'creative_commons' AS reason FROM r WHERE creative_commons = 'perhaps'",
)
def unreadable_sources(spark, sf):
    return media.unreadable_sources(records(spark, sf)).select("encyclopedia_id", "reason")


@query(
    "source_export",
    STORED + """SELECT psms_id AS id, encyclopedia_id, repository_id, psms_api_uri AS resource_uri, institution_id, collection_name,
                       strftime(created, '%Y-%m-%dT%H:%M:%S') AS created, strftime(modified, '%Y-%m-%dT%H:%M:%S') AS modified,
                       CASE WHEN published THEN 'true' ELSE 'false' END AS published,
                       CASE WHEN creative_commons THEN 'true' WHEN NOT creative_commons THEN 'false' END AS creative_commons,
                       headword, original, original_size, original_url, original_path, original_path_abs,
                       display, display_size, display_url, display_path, display_path_abs, external_url, media_format,
                       aspect_ratio, caption, caption_extended, transcript, courtesy FROM src""",
)
def source_export(spark, sf):
    return media.export_sources(media.build_sources(records(spark, sf), SITE))


@query(
    "media_plan",
    STORED + """, p AS (SELECT encyclopedia_id, unnest([CASE WHEN original <> '' THEN original_path_abs END,
                                                        CASE WHEN display <> '' THEN display_path_abs END]) AS path
                        FROM src WHERE published)
                SELECT encyclopedia_id, path, path LIKE '%.jpg' AS present FROM p WHERE path IS NOT NULL""",
)
def media_plan(spark, sf):
    plan = media.transfer_plan(media.build_sources(records(spark, sf), SITE))
    files = plan.filter("path like '%.jpg'").select("path")
    return links.with_presence(plan, files)


@query(
    "media_urls",
    STORED + """SELECT encyclopedia_id, 'https://www.example.org/media/' || CASE WHEN filename = '' THEN '' ELSE 'sources/' || filename END AS img_url,
                       'http://media.example.org/media/' || CASE WHEN filename = '' THEN '' ELSE 'sources/' || filename END AS img_url_local,
                       streaming_url AS rtmp_path,
                       CASE WHEN streaming_url <> '' THEN 'sources/' || regexp_extract(streaming_url, '[^/]*$') END AS streaming_path,
                       CASE WHEN transcript <> '' THEN 'sources/' || regexp_extract(transcript, '[^/]*$') END AS transcript_path,
                       CASE WHEN transcript <> '' THEN 'https://www.example.org/media/sources/' || regexp_extract(transcript, '[^/]*$') END AS transcript_url
                FROM src""",
)
def media_urls(spark, sf):
    rows = media.with_media_urls(media.build_sources(records(spark, sf), SITE), SITE)
    return rows.select("encyclopedia_id", "img_url", "img_url_local", "rtmp_path", "streaming_path", "transcript_path", "transcript_url")


@query(
    "page_sources",
    f"""WITH r AS ({RAW}), e AS (SELECT DISTINCT 'Order ' || o_orderkey AS url_title, 'en-' || o_custkey AS encyclopedia_id FROM orders)
        SELECT e.url_title AS headword, encyclopedia_id, id AS psms_id, resource_uri AS psms_api_uri, original AS original_url, display,
               trim(caption) AS caption,
               CASE WHEN display <> '' THEN regexp_extract(display, '[^/]*$') ELSE regexp_extract(original, '[^/]*$') END AS filename
        FROM e JOIN r USING (encyclopedia_id)""",
)
def page_sources(spark, sf):
    edges = table(spark, sf, "orders").select(
        F.concat(F.lit("Order "), "o_orderkey").alias("url_title"), F.concat(F.lit("en-"), "o_custkey").alias("encyclopedia_id")
    ).distinct()
    rows = media.build_page_sources(edges, records(spark, sf), SITE)
    return rows.select("headword", "encyclopedia_id", "psms_id", "psms_api_uri", "original_url", "display", "caption", "filename")
