"""Schemas of what is read and of the document tables that are written."""

from __future__ import annotations

from pyspark.sql import types as T

PAGE_JSON = """
  error struct<code: string>,
  parse struct<
    title: string,
    displaytitle: string,
    revid: bigint,
    categories: array<struct<`*`: string, sortkey: string, hidden: string>>,
    images: array<string>,
    properties: array<struct<name: string, `*`: string>>,
    links: array<struct<ns: int, `*`: string, exists: string>>,
    templates: array<struct<ns: int, `*`: string, exists: string>>,
    sections: array<struct<toclevel: int, level: string, line: string, number: string,
                           index: string, fromtitle: string, byteoffset: bigint, anchor: string>>,
    externallinks: array<string>,
    langlinks: array<struct<lang: string, url: string, `*`: string>>,
    text: struct<`*`: string>>
"""

# The record of the media feed; `repository_id` can be renamed on reading.
SOURCE_JSON = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in [
            ("id", T.StringType()),
            ("encyclopedia_id", T.StringType()),
            ("repository_id", T.StringType()),
            ("resource_uri", T.StringType()),
            ("institution_id", T.StringType()),
            ("collection_name", T.StringType()),
            ("created", T.StringType()),
            ("modified", T.StringType()),
            ("published", T.BooleanType()),
            ("creative_commons", T.StringType()),
            ("headword", T.StringType()),
            ("original", T.StringType()),
            ("original_size", T.StringType()),
            ("display", T.StringType()),
            ("display_size", T.StringType()),
            ("streaming_url", T.StringType()),
            ("external_url", T.StringType()),
            ("media_format", T.StringType()),
            ("aspect_ratio", T.StringType()),
            ("caption", T.StringType()),
            ("caption_extended", T.StringType()),
            ("transcript", T.StringType()),
            ("courtesy", T.StringType()),
        ]
    ]
)

VOCAB_JSON = """
  id string,
  title string,
  description string,
  terms array<struct<
    id: string, title: string, _title: string, description: string, path: string,
    ancestors: array<bigint>, children: array<bigint>, siblings: array<bigint>,
    encyc_urls: array<string>, parent_id: string, weight: string,
    type: string, elinks: array<struct<label: string, url: string>>,
    location: struct<label: string, geopoint: struct<lat: double, lng: double>>>>
"""

REVISIONS = "title string, ts timestamp_ntz"
CATEGORY_MEMBERS = "category string, title string, is_category boolean"
MEDIA_FILES = "path string"

AUTHOR = """
  url_title string, public boolean, published boolean, modified timestamp_ntz, mw_api_url string,
  title_sort string, title string, body string, article_titles array<string>, n_articles bigint
"""

ARTICLE = """
  url_title string, public boolean, published boolean, published_encyc boolean, published_rg boolean,
  modified timestamp_ntz, mw_api_url string, title_sort string, title string, description string,
  body string, prev_page string, next_page string, categories array<string>,
  coordinates struct<lng: double, lat: double>, source_ids array<string>,
  authors_data struct<display: array<string>, parsed: array<array<string>>>, databoxes array<string>
"""

SOURCE = """
  encyclopedia_id string, repository_id string, psms_id bigint, psms_api_uri string, institution_id string,
  collection_name string, created timestamp_ntz, modified timestamp_ntz, published boolean,
  creative_commons boolean, headword string, original string, original_size bigint, original_url string,
  original_path string, original_path_abs string, display string, display_size string, display_url string,
  display_path string, display_path_abs string, streaming_url string, external_url string,
  media_format string, aspect_ratio string, caption string, caption_extended string, transcript string,
  courtesy string, filename string, img_path string
"""

FACET = "id string, title string, description string"

FACETTERM = """
  id string, facet_id string, term_id string, title string, _title string, description string, path string,
  parent_id bigint, ancestors array<bigint>, siblings array<bigint>, children array<bigint>, weight bigint,
  encyc_urls array<struct<url_title: string, title: string>>, type string,
  locations array<struct<label: string, geopoint: struct<lat: double, lng: double>>>
"""

# Document type -> (schema, key column).
TABLES = {
    "author": (AUTHOR, "url_title"),
    "article": (ARTICLE, "url_title"),
    "source": (SOURCE, "encyclopedia_id"),
    "facet": (FACET, "id"),
    "facetterm": (FACETTERM, "id"),
}

# The fields of a source export, in order.
SOURCE_EXPORT_FIELDS = [
    "id",
    "encyclopedia_id",
    "repository_id",
    "resource_uri",
    "institution_id",
    "collection_name",
    "created",
    "modified",
    "published",
    "creative_commons",
    "headword",
    "original",
    "original_size",
    "original_url",
    "original_path",
    "original_path_abs",
    "display",
    "display_size",
    "display_url",
    "display_path",
    "display_path_abs",
    "external_url",
    "media_format",
    "aspect_ratio",
    "caption",
    "caption_extended",
    "transcript",
    "courtesy",
]

# The fields that document listings return.
LISTING_FIELDS = [
    "id",
    "model",
    "links_html",
    "links_json",
    "links_img",
    "links_thumb",
    "links_children",
    "url_title",
    "public",
    "published",
    "modified",
    "mw_api_url",
    "title_sort",
    "title",
    "description",
    "body",
    "prev_page",
    "next_page",
    "categories",
    "coordinates",
    "source_ids",
    "authors_data",
    "encyclopedia_id",
]

# The parameters that a listing may be filtered by.
SEARCH_PARAMS = [
    "published_encyc",
    "published_rg",
    "fulltext",
    "sort",
    "categories",
    "topics",
    "facility",
    "model",
    "models",
    "parent",
    "status",
    "public",
    "contributor",
    "creators",
    "format",
    "genre",
    "geography",
    "language",
    "location",
    "mimetype",
    "persons",
    "rights",
    "facet_id",
]

# The fields of an article handed out as a plain record.
ARTICLE_RECORD_FIELDS = [
    "title",
    "title_sort",
    "url_title",
    "mw_api_url",
    "modified",
    "public",
    "published",
    "published_encyc",
    "published_rg",
    "prev_page",
    "next_page",
    "authors_data",
    "categories",
    "coordinates",
    "source_ids",
    "description",
    "body",
]
