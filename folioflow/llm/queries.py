"""The operators of this package over the given tables, and the SQL that must agree where SQL can say it."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from folioflow.llm import decontaminate, exact, katz, merkle, mixing, near, packing, pii, quality, repeats, shards, tokens, whitening
from folioflow.llm.common import table
from folioflow.session import work_dir

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return keep


def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def fresh_index(spark: SparkSession) -> exact.DigestIndex:
    """An empty index of its own for each run of a query."""
    return exact.DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}", work_dir(spark, "digest-index"))


@query(
    "op1_exact_dedup",
    r"""
    WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
    """,
)
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return fresh_index(spark).add(table(spark, folder, "documents"), "documents").drop("row")


@query("op3_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), byte_bpe(), size=1024, end_id=2)


@query(
    "op4_decontamination",
    r"""
    WITH dw AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    iw AS (
      SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    win AS (
      SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS words
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT n FROM win),
    dwin AS (
      SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS words
      FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
    occ AS (SELECT d.doc_id, d.i, d.n, t.item_id FROM dwin d JOIN win t ON t.n = d.n AND t.words = d.words),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY 1),
    own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY 1)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)
    """,
)
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["first"])
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        (F.size("items") + F.col("unnamed").cast("int")).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@query("op9_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(table(spark, folder, "documents"), byte_bpe(), limit=512)


@query("op7_personal_data")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    field = pii.train(pii.labelled_words(spark))
    found = pii.personal_data(table(spark, folder, "documents"), field)
    joined = {c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",") for c in ("base", "spans")}
    counts = [F.expr(f"CAST(size(filter(base, x -> x.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined["base"], 256).alias("base_sha256"), joined["spans"].alias("spans"))


@query("op10_quality")
def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.train(docs, table(spark, folder, "labels"), held_out_fold=0)
    rows = quality.scored(docs.select("doc_id", "text"), model, threshold=0.3)
    return rows.select("doc_id", (quality.fold("doc_id") == 0).alias("held_out"), "score", "predicted")


@query("op8_near_duplicates")
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = near.near_duplicates(table(spark, folder, "documents"), percent=85, size=5)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)


@query("op5_balanced_shards")
def balanced_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.balanced_shards(table(spark, folder, "documents"), n_shards=16)
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))


@query("op6_katz_scores")
def katz_scores(spark: SparkSession, folder: str) -> DataFrame:
    return katz.katz_scores(table(spark, folder, "documents"), quality.fold("doc_id") == 1, order=3)


@query("op2_repeated_strings")
def repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, folder, "documents"), size=50)
    n_removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op11_merkle_manifest",
    """
    WITH RECURSIVE crc_table AS (
      SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
      FROM range(256) t(i)),
    d AS (SELECT row_number() OVER () AS r, doc_id, lang,
        coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
          || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
        n_chars, coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail,
        coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
          lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0, false) AS bad
      FROM documents, crc_table),
    l AS (SELECT r, doc_id, lang,
        sha256(head || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
        CASE WHEN bad THEN sha256(head || coalesce(length(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS forged
      FROM d),
    p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM l),
    tree AS (
      SELECT lang, 0 AS lvl, pos AS i, n, leaf AS h FROM p
      UNION ALL
      SELECT lang, lvl + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY lang, lvl, i // 2),
    subs AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS spot, count(*) OVER () AS m FROM tree WHERE n = 1),
    tops AS (
      SELECT 0 AS lvl, spot AS i, m AS n, subroot AS h FROM subs
      UNION ALL
      SELECT lvl + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY lvl, i // 2),
    steps AS (
      SELECT r, 0 AS tier, t.lvl, t.i, s.h AS sib
      FROM p JOIN tree t ON t.lang IS NOT DISTINCT FROM p.lang AND t.n > 1 AND t.i = p.pos >> t.lvl
        LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM t.lang AND s.lvl = t.lvl AND s.i = xor(t.i, 1)
      UNION ALL
      SELECT r, 1, t.lvl, t.i, s.h
      FROM p JOIN subs ON subs.lang IS NOT DISTINCT FROM p.lang JOIN tops t ON t.n > 1 AND t.i = spot >> t.lvl
        LEFT JOIN tops s ON s.lvl = t.lvl AND s.i = xor(t.i, 1)),
    way AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY tier, lvl) AS step FROM steps),
    climb AS (
      SELECT r, 0 AS step, coalesce(forged, leaf) AS h FROM l
      UNION ALL
      SELECT c.r, w.step, sha256(CASE WHEN sib IS NULL THEN c.h WHEN i % 2 = 1 THEN sib || c.h ELSE c.h || sib END)
      FROM climb c JOIN way w ON w.r = c.r AND w.step = c.step + 1),
    ends AS (SELECT r, arg_max(h, step) AS folded_root FROM climb GROUP BY r),
    proofs AS (SELECT r, string_agg(sib, '' ORDER BY step) AS sibs FROM way GROUP BY r),
    top AS (SELECT h AS root FROM tops WHERE n = 1)
    SELECT doc_id, leaf, subroot, root, sha256(coalesce(sibs, '')) AS proof_sha256, folded_root, folded_root = root AS verified
    FROM p JOIN subs ON subs.lang IS NOT DISTINCT FROM p.lang JOIN ends USING (r) LEFT JOIN proofs USING (r), top
    """,
)
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    bad = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.verified_manifest(
        table(spark, folder, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", bad, {"n_chars": F.col("n_chars").cast("bigint") + 1}
    )


@query("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"), most=4)


@query(
    "op13_source_mix",
    r"""
    WITH w AS (
      SELECT doc_id, max(CASE WHEN quality = 1 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END) AS weight FROM labels WHERE quality IS NOT NULL GROUP BY 1),
    d AS (
      SELECT row_number() OVER () AS r, d.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        -ln((CAST('0x' || substr(sha256('13:' || coalesce(CAST(d.doc_id AS VARCHAR), '-') || ':' || sha256(coalesce(text, ''))), 1, 13) AS BIGINT) + 1)
          / 4503599627370496.0::DOUBLE) / coalesce(weight, 1.0) AS draw
      FROM documents d LEFT JOIN w ON w.doc_id = d.doc_id),
    s AS (
      SELECT source, sum(size)::BIGINT AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
      FROM d GROUP BY 1),
    -- Sources become full in the order of cap over weight: those before one, and it itself, at the level it would be full at.
    f AS (
      SELECT *, coalesce(sum(3 * source_size) OVER before, 0) AS given, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open,
        sum(source_size) OVER () AS whole
      FROM s WINDOW before AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    g AS (SELECT *, (whole - given) * weight > 3 * source_size * open AS is_full FROM f),
    h AS (SELECT coalesce(sum(CASE WHEN is_full THEN 3 * source_size END), 0) AS given, sum(CASE WHEN NOT is_full THEN weight END) AS open FROM g),
    t AS (
      SELECT source, source_size,
        CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE) ELSE CAST((whole - h.given) * weight AS DOUBLE) / CAST(h.open AS DOUBLE) END AS target
      FROM g, h),
    b AS (SELECT *, least(CAST(round(target) AS BIGINT), 3 * source_size) AS budget FROM t),
    e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM b),
    c AS (
      SELECT d.*, source_size, target, epochs, budget - epochs * source_size AS rest,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN e ON e.source IS NOT DISTINCT FROM d.source)
    SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM c
    """,
)
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    good = table(spark, folder, "labels").filter("quality IS NOT NULL").select("doc_id", F.when(F.col("quality") == 1, 2.0).otherwise(0.5).alias("weight"))
    found = mixing.mixed(table(spark, folder, "documents"), weights=(5, 2, 1), most=3, quality=good)
    return found.select("doc_id", "size", "source_size", "target", "taken")
