"""Publishing jobs: find what changed, build the documents, write them by key, verify.

Each job is lazy up to its one write. Built documents are first written to the shared checkpoint
folder, so the upsert, the unpublishing and the verification all read the same finished rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.flags import publishable
from folioflow.operators import diff, index, links
from folioflow.operators.media import newest_keys, newest_sources, transfer_plan
from folioflow.operators.topics import build_terms
from folioflow.plans import build
from folioflow.session import cut, work_dir
from folioflow.settings import Site
from folioflow.sources import linkindex, sinks
from folioflow.sources.readers import parse_pages


# What the change test needs of a stored page.
STORED_PAGE = "url_title string, modified timestamp_ntz"


@dataclass
class Wiki:
    """The wiki's tables: parsed pages, category members, revisions, media records.

    With `raw`, the records (url_title, json) that `pages` comes from, a job picks the changed records first and parses
    only these, once.
    """

    pages: DataFrame
    members: DataFrame
    revisions: DataFrame
    sources: DataFrame
    raw: DataFrame | None = None


@dataclass
class Outcome:
    """What a job planned and did. Every part is a table."""

    changes: DataFrame
    posted: DataFrame
    unpublished: DataFrame
    could_not_post: DataFrame
    errors: DataFrame
    transfers: DataFrame | None = None
    relinked: DataFrame | None = None


def _planned(changes: DataFrame, stored: DataFrame, key: str, force: bool, only) -> DataFrame:
    """Keys to work on: one given key, all stored keys, or the new and updated ones."""
    if only is not None:
        return changes.sparkSession.createDataFrame([(only,)], f"{key} string")
    if force:
        return stored.select(key)
    return diff.to_update(changes).select(key)


def _staged(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.parquet(path)


def newest_revisions(spark: SparkSession, wiki: Wiki) -> Wiki:
    """The wiki with its newest revision of each page alone, stored: a job asks for them many times and reads all revisions once."""
    newest = diff.latest_revision(wiki.revisions, name="ts")
    return replace(wiki, revisions=_staged(spark, newest, "revisions"))


def changed_pages(raw: DataFrame, keys: DataFrame) -> DataFrame:
    """Parsed pages of the given keys: the records are joined as text and parsed after that."""
    return parse_pages(cut(raw.join(keys, "url_title", "left_semi")))


def _wanted(spark: SparkSession, wiki: Wiki, keys: DataFrame) -> DataFrame:
    if wiki.raw is None:
        return wiki.pages.join(keys, "url_title", "left_semi")
    return _staged(spark, changed_pages(wiki.raw, keys), "pages")


def _write(spark, path, key, posted, gone, dryrun) -> DataFrame:
    """Upsert and delete by key; returns the keys that did not arrive."""
    if dryrun:
        return posted.select(key).limit(0)
    # One pass over each touched bucket, which counts what it writes: it raises if a row did not arrive.
    sinks.apply_changes(spark, path, sinks.change_set(posted, gone, [key]), key, schema=posted.schema)
    lost = posted.select(key) if gone is None else posted.select(key).join(gone.select(key), key, "left_anti")
    return sinks.verify_published(lost, sinks.read_table(spark, path, f"{key} string"), key)


LINKS = "url_title string, prev_page string, next_page string"


def stale_neighbours(spark: SparkSession, path: str, beside: DataFrame, keys: DataFrame) -> DataFrame:
    """(url_title, prev_page, next_page) of the stored pages, other than `keys`, that stand beside other pages now:
    `beside` (title, prev_page, next_page) has all published pages' neighbours. Titles and links alone are read."""
    now = beside.select(F.col("title").alias("url_title"), F.col("prev_page").alias("_prev"), F.col("next_page").alias("_next"))
    both = sinks.read_table(spark, path, LINKS).join(keys, "url_title", "left_anti").join(now, "url_title")
    moved = ~F.col("prev_page").eqNullSafe(F.col("_prev")) | ~F.col("next_page").eqNullSafe(F.col("_next"))
    return both.filter(moved).select("url_title", F.col("_prev").alias("prev_page"), F.col("_next").alias("next_page"))


def publish_articles(
    spark: SparkSession, wiki: Wiki, path: str, guide=(), site: Site | None = None,
    force: bool = False, title: str | None = None, dryrun: bool = False, apply_deletes: bool = False, relink: bool = False,
) -> Outcome:
    """Bring the article table up to date; pages no longer publishable are taken out of it.

    With `relink`, unchanged pages beside added or removed ones get their new neighbours too: their stored rows are taken
    as they are, no text is read or built, and the links of the whole table are those of a full build.
    """
    site, wiki = site or Site(), newest_revisions(spark, wiki)
    stored = sinks.read_table(spark, path, STORED_PAGE)
    authors = diff.published_authors(wiki.members)
    published = diff.published_pages(wiki.members, wiki.revisions)
    changes = _staged(spark, diff.articles_to_update(authors, published, stored.select(F.col("url_title").alias("title"), "modified")), "changes")
    plan = _planned(changes, stored.select(F.col("url_title").alias("title")), "title", force, title)
    wanted = _wanted(spark, wiki, plan.select(F.col("title").alias("url_title")))
    built = build.build_articles(wanted, wiki.members, wiki.revisions, wiki.sources, guide, site)
    docs = _staged(spark, built, "articles")
    shown = publishable("published", site.show_unpublished)
    posted = docs.filter(shown)
    unpublished = docs.filter(~shown).select("url_title").join(stored.select("url_title"), "url_title", "left_semi")
    gone = unpublished = _staged(spark, unpublished, "unpublished")
    if apply_deletes:
        deleted = changes.filter(F.col("change") == diff.DELETED).select(F.col("title").alias("url_title"))
        gone = gone.unionByName(_staged(spark, stored.select("url_title").join(deleted, "url_title", "left_semi"), "deleted"))
    missing = plan.select(F.col("title").alias("url_title")).join(docs.select("url_title"), "url_title", "left_anti")
    missing = _staged(spark, missing, "missing")
    relinked = None
    if relink:
        titles = wiki.members.filter((F.col("category") == "Authors") & ~F.col("is_category")).select("title").distinct()
        beside = index.neighbours(index.articles_a_z(published, titles))
        worked_on = docs.select("url_title").unionByName(gone)
        moved = _staged(spark, stale_neighbours(spark, path, beside, worked_on), "neighbours")
        old = sinks.read_keys(spark, path, moved, "url_title", docs.schema).drop("prev_page", "next_page")
        relinked = _staged(spark, old.join(moved, "url_title").select(docs.columns), "relinked")
    errors = _write(spark, path, "url_title", posted if relinked is None else posted.unionByName(relinked), gone, dryrun)
    return Outcome(changes, posted, unpublished, missing, errors, relinked=relinked)


def move_links(spark: SparkSession, wiki: Wiki, links_path: str) -> linkindex.Moves:
    """Bring the edges of the link index at `links_path` up to the wiki's pages; `linkindex.settle` ends the refresh.

    Only pages that are new or changed since they were last indexed are read. Pages without a revision are read once.
    """
    keys = (wiki.raw if wiki.raw is not None else wiki.pages).select(F.col("url_title").alias("source")).distinct()
    newest = diff.latest_revision(wiki.revisions).withColumnRenamed("title", "source")
    changes = _staged(spark, linkindex.changed(spark, links_path, keys.join(newest, "source", "left")), "link-changes")
    wanted = _wanted(spark, wiki, diff.to_update(changes).select(F.col("source").alias("url_title")))
    return linkindex.move(spark, links_path, changes, build.page_links(wanted))


def publish_authors(
    spark: SparkSession, wiki: Wiki, path: str, guide=(), site: Site | None = None,
    force: bool = False, title: str | None = None, dryrun: bool = False, apply_deletes: bool = False,
    links_path: str | None = None,
) -> Outcome:
    """Bring the author table up to date; every author page counts as publishable.

    With `links_path`, a link index (`linkindex.create`), the index is refreshed first and the authors whose links changed
    are worked on too; documents then hold the number of titles and an empty list, and `linkindex.titles` has the titles as
    rows. Without it the links of all pages are read and every document holds its whole list. A dry run leaves the index alone.
    """
    wiki = newest_revisions(spark, wiki)
    stored = sinks.read_table(spark, path, STORED_PAGE)
    authors = diff.published_authors(wiki.members)
    published = diff.published_pages(wiki.members, wiki.revisions)
    changes = _staged(spark, diff.authors_to_update(authors, published, stored.select(F.col("url_title").alias("title"), "modified")), "changes")
    plan = _planned(changes, stored.select(F.col("url_title").alias("title")), "title", force, title)
    counts = edges = moves = None
    if links_path is None:
        edges = links.backlinks(build.page_links(wiki.pages))
    else:
        if not dryrun:
            moves = move_links(spark, wiki, links_path)
            moved = moves.edges.select(F.col("target").alias("title")).distinct()
            known = changes.filter(F.col("change") != diff.DELETED).select("title")
            plan = _staged(spark, plan.union(moved.join(known, "title", "left_semi")).distinct(), "plan")
        counts = linkindex.edges_to(spark, links_path, plan.select(F.col("title").alias("target"))).groupBy("target").agg(F.count("*").alias("n_articles"))
    wanted = _wanted(spark, wiki, plan.select(F.col("title").alias("url_title")))
    built = build.build_authors(wanted, wiki.members, wiki.revisions, wiki.sources, edges, guide, site, counts=counts)
    docs = _staged(spark, built, "authors")
    gone = None
    if apply_deletes:
        deleted = changes.filter(F.col("change") == diff.DELETED).select(F.col("title").alias("url_title"))
        gone = _staged(spark, stored.select("url_title").join(deleted, "url_title", "left_semi"), "deleted")
    missing = plan.select(F.col("title").alias("url_title")).join(docs.select("url_title"), "url_title", "left_anti")
    missing = _staged(spark, missing, "missing")
    errors = _write(spark, path, "url_title", docs, gone, dryrun)
    if moves is not None:
        # Only now: a job that stops before works on the same authors again.
        linkindex.settle(spark, links_path, moves)
    return Outcome(changes, docs, docs.select("url_title").limit(0), missing, errors)


def publish_sources(
    spark: SparkSession, records: DataFrame, path: str, files: DataFrame | None = None, site: Site | None = None,
    force: bool = False, source_id: str | None = None, dryrun: bool = False, apply_deletes: bool = False,
) -> Outcome:
    """Bring the source table up to date and plan the transfer of its files.

    Sources without an id are passed over. `files` lists the files there are. What changed is found from keys and times
    alone; records are built once they are known to be wanted.
    """
    key = "encyclopedia_id"
    newest = _staged(spark, newest_keys(records), "newest")
    stored = sinks.read_table(spark, path, f"{key} string, modified timestamp_ntz")
    changes = _staged(spark, diff.sources_to_update(newest, stored), "changes")
    everything = newest if force else stored
    plan = _planned(changes, everything, key, force, source_id).filter(F.coalesce(key, F.lit("")) != "")
    docs = _staged(spark, newest_sources(records, newest.join(plan, key, "left_semi"), site), "sources")
    posted = docs.filter(F.coalesce("published", F.lit(False)))
    unpublished = docs.filter(~F.coalesce("published", F.lit(False))).select(key).join(stored.select(key), key, "left_semi")
    gone = unpublished = _staged(spark, unpublished, "unpublished")
    if apply_deletes:
        gone = gone.unionByName(changes.filter(F.col("change") == diff.DELETED).select(key))
    missing = _staged(spark, plan.join(docs.select(key), key, "left_anti"), "missing")
    errors = _write(spark, path, key, posted, gone, dryrun)
    transfers = transfer_plan(posted)
    if files is not None:
        transfers = links.with_presence(transfers, files)
    return Outcome(changes, posted, unpublished, missing, errors, transfers)


def publish_vocabs(
    spark: SparkSession, facets: DataFrame, terms: DataFrame, facet_path: str, term_path: str, vocabs=None
) -> DataFrame:
    """Write the facet rows and terms of the site's vocabularies; returns keys that did not arrive."""
    names = list(vocabs or Site().vocabs)
    rows = facets.filter(F.col("id").isin(names))
    docs = _staged(spark, build_terms(terms.filter(F.col("facet_id").isin(names))), "terms")
    sinks.save_docs(spark, facet_path, rows, "id")
    sinks.save_docs(spark, term_path, docs, "id")
    lost = sinks.verify_published(rows, sinks.read_table(spark, facet_path, "id string"), "id")
    return lost.unionByName(sinks.verify_published(docs, sinks.read_table(spark, term_path, "id string"), "id"))


def publish_all(
    spark: SparkSession, wiki: Wiki, author_path: str, article_path: str, guide=(), site: Site | None = None
) -> tuple[Outcome, Outcome]:
    """Authors, then articles: removed pages are deleted, changed ones written."""
    authors = publish_authors(spark, wiki, author_path, guide, site, apply_deletes=True)
    articles = publish_articles(spark, wiki, article_path, guide, site, apply_deletes=True)
    return authors, articles


def status(wiki: Wiki, authors: DataFrame, articles: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents stored against documents at the source, per type."""
    published = diff.published_pages(wiki.members, wiki.revisions)
    return diff.coverage(
        {
            "author": (diff.published_authors(wiki.members), authors),
            "article": (published, articles),
            "source": (None, sources),
        }
    )
