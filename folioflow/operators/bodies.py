"""Page bodies set-wise: cleaning, links, sections, databoxes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions import markup as M
from folioflow.functions.text import strip
from folioflow.session import spread
from folioflow.settings import Site

# A guide list up to this long may travel as a literal inside the plan.
LITERAL_TITLES = 1000


def with_tokens(pages: DataFrame, html: str = "html", tokens: str = "tokens") -> DataFrame:
    """Replace the html column by its tokens; small inputs are spread over all cores first."""
    return spread(pages).withColumn(tokens, M.html_tokens(html)).drop(html)


def page_links(tokens: DataFrame, key: str, base: str) -> DataFrame:
    """Rows (key, pos, href, title): every link of every page."""
    light = F.expr(
        f"""transform(filter(tokens, t -> {M.is_start('t', 'a')} AND t.attrs['href'] IS NOT NULL),
                      t -> named_struct('pos', t.pos, 'href', t.attrs['href']))"""
    )
    rows = tokens.select(key, F.explode(light).alias("link")).select(key, "link.pos", "link.href")
    return rows.withColumn("title", M.link_title("href", base))


def linked_titles(pages: DataFrame, key: str, base: str, html: str = "html") -> DataFrame:
    """Rows (key, href, title): every link of every page, read from the text without making tokens."""
    rows = spread(pages.select(key, html)).select(key, F.explode(M.html_hrefs(html)).alias("href"))
    return rows.withColumn("title", M.link_title("href", base))


def classify_links(links: DataFrame, guide_titles: DataFrame, title: str = "id") -> DataFrame:
    """Add `in_guide` and the marker `class` to the rows of `page_links` or `linked_titles`.

    A title counts as in the guide as written or with its underscores as spaces.
    """
    # One row per title with its underscores as spaces, so that one join answers both questions.
    given = guide_titles.select(F.col(title).alias("_given"), F.translate(title, "_", " ").alias("_spaced"))
    guide = given.groupBy("_spaced").agg(
        F.max(F.col("_given") == F.col("_spaced")).alias("_plain"),
        # Only the ways one title is written with underscores.
        F.collect_set(F.when(F.col("_given") != F.col("_spaced"), F.col("_given"))).alias("_written"),
    )
    joined = links.join(guide, F.translate("title", "_", " ") == F.col("_spaced"), "left")
    known = (F.col("title") != "") & (F.col("_plain") | F.array_contains("_written", F.col("title")))
    out = joined.withColumn("in_guide", F.coalesce(known, F.lit(False))).select(*links.columns, "in_guide")
    return out.withColumn("class", F.array_join(M.link_marks("href", "in_guide"), ","))


def guide_titles_per_page(links: DataFrame, guide_titles: DataFrame, key: str) -> DataFrame:
    """(key, guide): the guide titles that each page links to, bounded by the page's own links."""
    known = classify_links(links, guide_titles).filter("in_guide")
    return known.groupBy(key).agg(F.collect_set("title").alias("guide"))


def short_titles(guide: DataFrame, title: str = "id") -> list[str] | None:
    """The distinct titles of a guide table if there are at most LITERAL_TITLES, else None; no more than that is fetched."""
    found = guide.select(title).filter(F.col(title).isNotNull()).distinct().limit(LITERAL_TITLES + 1).collect()
    return sorted(r[0] for r in found) if len(found) <= LITERAL_TITLES else None


def clean_bodies(
    pages: DataFrame,
    guide=(),
    site: Site | None = None,
    key: str = "url_title",
    source_ids: str | None = None,
    printed: bool = False,
    migration: bool = False,
) -> DataFrame:
    """(key, body): page bodies made ready for readers.

    `pages` has (key, html) and may have a column of the page's source ids. `guide` is the list
    of resource guide titles: a Python list of up to 1,000, or a table (column `id`) of any size;
    what a longer one has of each page's links is looked up by a join.
    """
    site = site or Site()
    ids = F.col(source_ids) if source_ids else F.array().cast("array<string>")
    rows = pages.select(key, "html", ids.alias("source_ids"))
    if not isinstance(guide, DataFrame) and len(list(guide)) > LITERAL_TITLES:
        guide = pages.sparkSession.createDataFrame([(t,) for t in guide], "id string")
    short = short_titles(guide) if isinstance(guide, DataFrame) else None
    if short is not None:
        # A page without a key has no part in a guide that is a table.
        titles = F.array(*[F.lit(t) for t in short]).cast("array<string>")
        rows = rows.withColumn("guide", F.when(F.col(key).isNotNull(), titles).otherwise(F.array().cast("array<string>")))
    elif isinstance(guide, DataFrame):
        links = linked_titles(rows, key, site.guide_base)
        rows = rows.join(guide_titles_per_page(links, guide, key), key, "left")
        rows = rows.withColumn("guide", F.coalesce("guide", F.array().cast("array<string>")))
    else:
        rows = rows.withColumn("guide", F.array(*[F.lit(t) for t in guide]).cast("array<string>"))
    df = with_tokens(rows)
    return clean_tokens(df, site, printed, migration).select(key, body_text("tokens").alias("body"))


def clean_tokens(df: DataFrame, site: Site, printed: bool = False, migration: bool = False) -> DataFrame:
    """The cleaning steps on columns `tokens`, `guide`, `source_ids`.

    The steps have the effect of their fixed order: empty paragraphs, link marks, page titles,
    edit links, sections, new-page and paging links, status markers, top links, hidden tags,
    front-hidden divs, source images, upload links. Removals that do not see each other's work
    share one pass. Every pass is a projection of its own: it uses the tokens several times
    over, and Catalyst keeps such projections apart instead of copying one into the next.
    """

    def step(frame: DataFrame, column) -> DataFrame:
        return frame.withColumn("tokens", column)

    early = [M.empty_paragraph("tokens"), M.page_title, M.edit_link] + ([] if migration else [M.status_marker])
    df = step(df, M.drop("tokens", *early))
    df = step(df, M.mark_links("tokens", site.guide_base, "guide"))
    df = df.withColumn("sections", M.section_bounds("tokens"))
    df = step(df, M.wrap_sections("tokens", "sections")).drop("sections")
    if not printed:
        df = step(df, M.add_top_links("tokens"))
    for selector in site.hidden_tags:
        df = step(df, M.hide_tags("tokens", selector, site.hidden_tag_comments))
    return step(df, M.drop("tokens", M.front_hidden, M.source_image("tokens", "source_ids"), M.upload_link))


def body_text(tokens):
    return M.strip_bare_tags(M.strip_wiki_paths(M.render(tokens)))


def scrub_bodies(docs: DataFrame, body: str = "body") -> DataFrame:
    """Stored documents with the status markers taken out of their bodies."""
    cleaned = spread(docs).withColumn("tokens", M.html_tokens(body))
    cleaned = cleaned.withColumn("tokens", M.drop("tokens", M.status_marker))
    return cleaned.withColumn(body, F.when(F.col(body).isNotNull(), M.render("tokens"))).select(*docs.columns)


def sections(tokens: DataFrame, key: str) -> DataFrame:
    """Rows (key, section_no, section_id, heading, content) of every section."""
    df = tokens.withColumn("sections", M.section_bounds("tokens"))
    cut = df.select(key, "tokens", F.posexplode("sections").alias("section_no", "s"))
    return cut.select(
        key,
        F.col("section_no").cast("bigint").alias("section_no"),
        F.col("s.id").alias("section_id"),
        M.plain_text(M.between("tokens", "s.start", "s.header_end")).alias("heading"),
        M.render(M.between("tokens", "s.header_end", "s.stop")).alias("content"),
    )


def databox_table(tokens: DataFrame, key: str, ids=None) -> DataFrame:
    """Rows (key, databox, pos, name, raw, parts): every line of every databox."""
    boxes = tokens.select(key, F.explode(M.databoxes("tokens", ids)).alias("box"))
    rows = boxes.select(key, "box.databox", F.posexplode_outer("box.rows").alias("pos", "row"))
    return rows.select(
        key, "databox", F.col("pos").cast("bigint").alias("pos"),
        F.col("row.key").alias("name"), F.col("row.raw").alias("raw"), F.col("row.parts").alias("parts"),
    )


def row_shapes(box_rows: DataFrame, keys: list[str], cells: str = "n_cells") -> DataFrame:
    """How many rows of each databox have how many cells."""
    return box_rows.groupBy(*keys, cells).agg(F.count("*").alias("n_rows"))


def anomalies(box_rows: DataFrame, keys: list[str], cells: str = "n_cells") -> DataFrame:
    """Whether a databox has a row of other than two cells; one without rows has none."""
    return box_rows.groupBy(*keys).agg(F.coalesce(F.bool_or(F.col(cells) != 2), F.lit(False)).alias("anomalous"))


def raw_box_rows(tokens: DataFrame, key: str, ids=None) -> DataFrame:
    """Rows (key, databox, pos, n_cells) of the written lines: cells are set apart by colons.

    A line with a key and a value counts two cells, whatever colons the value holds; one
    without a colon counts one.
    """
    boxes = tokens.select(key, F.explode(M.databox_texts("tokens", ids)).alias("box"))
    lines = boxes.select(key, "box.databox", F.posexplode(F.split("box.text", "\n")).alias("pos", "line"))
    lines = lines.withColumn("line", strip("line")).filter(F.col("line") != "")
    return lines.select(
        key, "databox", F.col("pos").cast("bigint").alias("pos"), F.size(F.split("line", ":", 2)).alias("n_cells")
    )


def databox_report(tokens: DataFrame, key: str, ids=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(distinct databox names, databoxes with odd rows, pages whose databoxes cannot be read)."""
    rows = raw_box_rows(tokens, key, ids)
    names = tokens.select(F.explode(M.databox_texts("tokens", ids)).alias("box")).select("box.databox").distinct()
    odd = anomalies(rows, [key, "databox"]).filter("anomalous").select(key, "databox")
    unread = tokens.select(key, F.explode(M.databox_texts("tokens", ids)).alias("box")).filter(
        F.col("box.text").isNull()
    ).select(key, F.col("box.databox").alias("databox"), F.lit("no paragraph").alias("error"))
    return names.orderBy("databox"), odd, unread
