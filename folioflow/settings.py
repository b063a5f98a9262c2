"""Settings of one publishing site, passed to the operators that need them."""

from __future__ import annotations

from dataclasses import dataclass, field

# The databox divs whose fields are kept, with the column prefix of each.
DATABOXES = {
    "rgdatabox-Core": "rg",
    "databox-Articles": "",
    "databox-Books": "",
    "databox-Exhibitions": "",
    "databox-Films": "",
    "databox-Magazines": "",
    "databox-Plays": "",
    "databox-Websites": "",
}

# Editorial categories that the category index leaves out.
HIDDEN_CATEGORIES = [
    "Articles_Needing_Primary_Source_Video",
    "CAL60",
    "In_Camp",
    "NeedMoreInfo",
    "Status_2",
    "Status_3",
]

# Fixed values: "attribute=value" of the tags that a published body hides.
HIDDEN_TAGS = ["id=rgdatabox-CoreDisplay"]

# Databox fields that have a column of their own. A site adds its own with `rg_fields`.
RG_FIELDS = [
    "rgmediatype",
    "title",
    "creators",
    "interestlevel",
    "readinglevel",
    "theme",
    "genre",
    "pov",
    "relatedevents",
    "availability",
    "freewebversion",
    "geography",
    "facility",
    "chronology",
    "hasteachingaids",
    "warnings",
]


@dataclass(frozen=True)
class Site:
    """Where things live and what is shown; every default can be replaced."""

    databoxes: dict = field(default_factory=lambda: dict(DATABOXES))
    rg_fields: list = field(default_factory=lambda: list(RG_FIELDS))
    hidden_categories: list = field(default_factory=lambda: list(HIDDEN_CATEGORIES))
    hidden_tags: list = field(default_factory=lambda: list(HIDDEN_TAGS))
    hidden_tag_comments: bool = True
    show_unpublished: bool = False
    default_authors: str = "Encyclopedia contributors."
    guide_base: str = "/wiki"
    sources_url: str = "https://sources.example.org/media/sources/"
    sources_base: str = "/var/www/media/sources"
    media_url: str = "https://www.example.org/media/"
    media_url_local: str = "http://media.example.org/media/"
    media_bucket: str = "sources"
    streamer: str = "rtmp://streaming.example.org/stream"
    repository_url: str = "http://repository.example.org"
    topics_base: str = "https://repository.example.org/browse/topics"
    objects_media_url_local: str = "http://media.example.org/media/"
    vocabs: tuple = ("topics", "facility")
