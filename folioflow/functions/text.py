"""Titles, names of files and urls, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The paths of author, source and article pages.
URL_PATTERNS = {
    "author": "/authors/%s/",
    "source": "/sources/%s/",
    "page": "/%s/",
}

# Words that read as true and as false.
TRUE_WORDS = ["y", "yes", "t", "true", "on", "1"]
FALSE_WORDS = ["n", "no", "f", "false", "off", "0"]

# Whitespace at either end, with the control characters that regex \s leaves out.
EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

# The folder that a thumbnail lies in, and a file name less its last extension.
THUMBNAIL_FOLDER = "([^/]*)/+[^/]*$"
IMAGE_EXTENSION = r"(?s)^(\.*[^.].*)\.[^.]*$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, use) -> Column:
    """`use(value)` with `value` worked out once, also where `use` needs it several times."""
    return F.transform(F.array(value), use)[0]


def let(name: str, value: str, use: str) -> str:
    """The same in SQL: `use` with `name` standing for `value`."""
    return f"transform(array({value}), {name} -> {use})[0]"


def literal(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def strip_sql(value: str) -> str:
    return f"regexp_replace({value}, r'{EDGE_SPACE}', '')"


def strip(text) -> Column:
    return F.regexp_replace(col(text), EDGE_SPACE, "")


def none_strip(text) -> Column:
    """Null becomes the empty string; whitespace of any kind is cut at both ends."""
    return strip(F.coalesce(col(text), F.lit("")))


def title_sort(sort_key, title) -> Column:
    """The given sort key, else the title less a leading article; letters and digits only."""
    sort_key, title = col(sort_key), col(title)
    text = F.when(F.coalesce(sort_key, F.lit("")) != "", sort_key).otherwise(
        F.regexp_replace(title, "^(a|an|the) ", "")
    )
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]", "")


def default_sort(properties) -> Column:
    """Value of the last page property named `defaultsort`, in any letter case."""
    named = F.filter(col(properties), lambda p: F.lower(p["name"]) == "defaultsort")
    return F.coalesce(F.try_element_at(named, F.lit(-1))["*"], F.lit(""))


def absolute_url(kind: str, key) -> Column:
    return F.format_string(URL_PATTERNS[kind], col(key))


def basename(path) -> Column:
    return F.substring_index(col(path), "/", -1)


def join_path(base, path) -> Column:
    """Join two path parts; an absolute second part stands alone."""
    base, path = col(base), col(path)
    return (
        F.when(path.startswith("/"), path)
        .when(base.endswith("/") | (base == ""), F.concat(base, path))
        .otherwise(F.concat(base, F.lit("/"), path))
    )


def image_id(uri) -> Column:
    """Id of a media file: its name without extension, or for a thumbnail its folder's."""

    def name(uri):
        folder = F.regexp_extract(uri, THUMBNAIL_FOLDER, 1)
        return F.when(F.contains(uri, F.lit("thumb")), folder).otherwise(F.substring_index(uri, "/", -1))

    return F.regexp_replace(name(col(uri)), IMAGE_EXTENSION, "$1")


def fix_external_url(url, base: str) -> Column:
    """Repository urls of the old form base/a/b/1/2/ become base/a-b-1-2/."""
    url = col(url)
    old = base.rstrip("/").replace(".", r"\.") + r"/(\w+)/(\w+)/(\d+)/(\d+)/"
    new = base.rstrip("/") + "/$1-$2-$3-$4/"
    return F.when(url.rlike("(?U)^" + old), F.regexp_replace(url, "(?U)" + old, new)).otherwise(url)


def str_to_bool(text, strict: bool = False) -> Column:
    """True or false for the known words; null for any other, or an error if `strict`."""
    word = F.lower(col(text))
    known = F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))
    if not strict:
        return known
    return known.otherwise(
        F.raise_error(F.concat(F.lit("invalid truth value "), F.coalesce(word, F.lit("null")))).cast("boolean")
    )


def url_title(url) -> Column:
    """Path of a url with every slash removed: the title part, still percent-encoded."""
    rest = F.regexp_replace(col(url), "^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?", "")
    path = F.regexp_replace(F.regexp_replace(rest, "(?s)[?#].*$", ""), ";[^/]*$", "")
    return F.replace(path, F.lit("/"), F.lit(""))


def url_unquote(text) -> Column:
    """Percent-decode; a plus sign and a stray percent sign stay as they are."""
    safe = F.regexp_replace(F.replace(col(text), F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.try_url_decode(safe)


def replace_domain(df, old: str, new: str, fields=("display", "original", "streaming_url", "thumbnail_lg", "thumbnail_sm")):
    """Replace a media domain in the url columns that `df` has; a port in `new` is cut."""
    host = new.split(":")[0]
    if not (old and host):
        return df
    return df.withColumns(
        {f: F.replace(F.col(f), F.lit(old), F.lit(host)) for f in fields if f in df.columns}
    )


def href_title(href, base: str) -> Column:
    """Page title that a link points at: outer slashes and the wiki base removed."""
    text = F.regexp_replace(col(href), "/$", "")
    if base:
        text = F.replace(text, F.lit(base), F.lit(""))
    return F.regexp_replace(text, "^/", "")


def unwrap_single(values) -> Column:
    """First item of an array; an empty array gives null."""
    return F.try_element_at(col(values), F.lit(1))


def first_letter(sort_key) -> Column:
    return F.upper(F.left(col(sort_key), F.lit(1)))
