"""Reading wiki pages, media records, vocabularies and CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.dates import iso_text
from folioflow.operators.positions import with_position
from folioflow.sources import schemas


def parse_pages(pages: DataFrame, json: str = "json") -> DataFrame:
    """Typed columns of raw page records (`url_title`, `json`); missing pages get status 404."""
    doc = F.from_json(F.col(json), schemas.PAGE_JSON)
    missing = F.col("doc.error.code") == "missingtitle"
    return pages.withColumn("doc", doc).select(
        *[c for c in pages.columns if c != json],
        F.when(missing, 404).otherwise(200).alias("status_code"),
        F.when(missing, F.col("doc.error.code")).alias("error"),
        F.col("doc.parse.displaytitle").alias("title"),
        F.col("doc.parse.categories").alias("categories"),
        F.col("doc.parse.images").alias("images"),
        F.col("doc.parse.properties").alias("properties"),
        F.col("doc.parse.links").alias("links"),
        F.col("doc.parse.text.`*`").alias("html"),
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Raw page files, one JSON record per line: `{"url_title": ..., "json": "..."}`."""
    return parse_pages(spark.read.schema("url_title string, json string").json(path))


def read_revisions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REVISIONS).parquet(path)


def read_sources(spark: SparkSession, path: str, repository_id: str = "repository_id", multiline: bool = False) -> DataFrame:
    """Media records; `repository_id` names the feed's field for the id in the repository."""
    fields = [f if f.name != "repository_id" else type(f)(repository_id, f.dataType) for f in schemas.SOURCE_JSON]
    raw = spark.read.schema(type(schemas.SOURCE_JSON)(fields)).json(path, multiLine=multiline)
    return raw.withColumnRenamed(repository_id, "repository_id")


def published_sources(sources: DataFrame) -> DataFrame:
    return sources.filter(F.col("published"))


def split_vocab(vocab: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vocabulary records to (facet headers, one row per raw term)."""
    facets = vocab.select("id", "title", "description")
    terms = vocab.select(F.col("id").alias("facet_id"), F.posexplode("terms").alias("pos", "term")).select(
        "facet_id", "pos", "term.*"
    )
    return facets, terms


def read_vocab(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return split_vocab(spark.read.schema(schemas.VOCAB_JSON).json(path, multiLine=True))


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON document files of a known schema."""
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, row_start: int = 0, row_end: int | None = None,
             schema: str | None = None, multiline: bool = True) -> DataFrame:
    """CSV with a header row, optionally only rows `row_start` to `row_end` (exclusive) in file order.

    Quoted values may hold line breaks. Where they do not, `multiline=False` lets Spark split
    large files.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multiline)
    df = (reader.schema(schema) if schema else reader).csv(path)
    if row_start == 0 and row_end is None:
        return df
    return slice_rows(df, row_start, row_end)


def slice_rows(df: DataFrame, row_start: int, row_end: int | None) -> DataFrame:
    """Rows of a file scan by position in the files, taken in name order.

    Rows are numbered inside each split of each file. Only the per-split counts are summed up
    across splits, so the rows themselves are not shuffled. Both scans lay out the same file list
    in the same splits, which makes the two numberings agree.
    """
    split = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    rows = df.select("*", *split, F.monotonically_increasing_id().alias("_id"))
    sizes = rows.groupBy("_file", "_block").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    starts = sizes.select(
        "_file", "_block", "_first", F.expr("sum(_n) over (order by _file, _block) - _n").alias("_start")
    )
    position = F.col("_start") + F.col("_id") - F.col("_first")
    kept = position >= row_start
    if row_end is not None:
        kept = kept & (position < row_end)
    return rows.join(starts, ["_file", "_block"]).filter(kept).select(*df.columns)


def list_docs(docs: DataFrame, fields=None, limit: int | None = None) -> DataFrame:
    """The listing fields that a document table has; no cap unless one is given."""
    fields = fields or schemas.LISTING_FIELDS
    out = docs.select(*[c for c in fields if c in docs.columns])
    return out if limit is None else out.limit(limit)


def search_docs(docs: DataFrame, params: dict) -> DataFrame:
    """Listing filtered by the whitelisted parameters; any other parameter is ignored."""
    kinds = dict(docs.dtypes)
    for name, value in params.items():
        if name not in schemas.SEARCH_PARAMS or name not in kinds:
            continue
        docs = docs.filter(_matches(F.col(name), kinds[name], value))
    return list_docs(docs)


def listing_lines(docs: DataFrame, key: str) -> DataFrame:
    """Lines `n/total| key` of a document table in key order, numbered from 0."""
    placed = with_position(docs.select(key), [key], name="_n", total="_total")
    return placed.select(key, F.concat(F.col("_n"), F.lit("/"), F.col("_total"), F.lit("| "), F.col(key)).alias("line"))


def _matches(column: Column, kind: str, value) -> Column:
    values = list(value) if isinstance(value, (list, tuple, set)) else [value]
    if kind.startswith("array"):
        return F.arrays_overlap(column, F.array(*[F.lit(v) for v in values]))
    return column.isin(values)


def rg_titles(guide_articles: DataFrame, limit: int | None = None) -> DataFrame:
    """Ids of the resource guide's articles: all, or the first `limit` in id order."""
    ids = guide_articles.select("id")
    return ids if limit is None else ids.orderBy("id").limit(limit)


def get_doc(docs: DataFrame, key_column: str, key, body: bool = False) -> DataFrame:
    """One document by key, without its body unless asked; timestamps as ISO text."""
    found = docs.filter(F.col(key_column) == F.lit(key))
    if not body and "body" in found.columns:
        found = found.drop("body")
    times = {name: iso_text(name) for name, kind in found.dtypes if kind.startswith("timestamp")}
    return found.withColumns(times) if times else found


def get_document(tables: dict[str, DataFrame], doctype: str, key, body: bool = False):
    """Lookup by document type; an unknown type gives an error record."""
    if doctype not in ("article", "author", "source"):
        return {"error": f'Unknown doctype: "{doctype}"'}
    return get_doc(tables[doctype], schemas.TABLES[doctype][1], key, body)
