"""Publish flags, coordinates and other one-row facts about a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.text import col

# Fixed value: the category that marks a page as published.
PUBLISHED = "Published"

# Where the coordinates of a place are written.
PLACE_BOX = "databox-Camps"
LONGITUDE = "GISLo*ng: (-*[0-9]+.[0-9]+)"
LATITUDE = "GISLat: (-*[0-9]+.[0-9]+)"


def is_published(categories) -> Column:
    """True when one of the page's categories is exactly `Published`."""
    return F.coalesce(F.exists(col(categories), lambda c: c["*"] == PUBLISHED), F.lit(False))


def publishable(published, show_unpublished: bool = False) -> Column:
    return F.coalesce(col(published), F.lit(False)) | F.lit(show_unpublished)


def coordinates(text) -> Column:
    """Last longitude and latitude of a place page, null unless both are there and not zero."""
    text = col(text)

    def last(pattern):
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        return F.try_element_at(found, F.lit(-1)).try_cast("double")

    lng, lat = last(LONGITUDE), last(LATITUDE)
    there = F.contains(text, F.lit(PLACE_BOX)) & (lng != 0) & (lat != 0)
    return F.when(there, F.struct(lng.alias("lng"), lat.alias("lat")))
