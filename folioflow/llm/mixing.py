"""Mixing sources to target weights by weighted sampling without replacement.

Every document draws an exponential key, minus the logarithm of a number in (0, 1] over its quality weight: the order
of the keys is a weighted random order (Efraimidis and Spirakis). A source gives as many complete epochs as its target
holds; what is left of the target is taken in the order of the keys, up to the running sum of the words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import join_facts, plain_text, staged
from folioflow.operators.positions import with_position
from folioflow.session import range_partitions

WORD = "[^\\x20\\x09-\\x0D]+"

# Hex digits of the digest that a draw is made of: 52 bits, exact as a double.
DRAW_DIGITS = 13


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def draw(seed: int, *parts: Column) -> Column:
    """A number in (0, 1] that depends on the seed and the parts alone."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]), 256)
    whole = F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("bigint")
    return (whole + 1).cast("double") / float(16**DRAW_DIGITS)


def targets(sources: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """Sources (key, rank, source_size) with `target`: their share of all sizes by weight, at most `most` times their own
    size; what is above goes to the others by weight, until none is above.

    Sources in the order of `rank` weigh `weights` in turn. A round is one aggregation over the sources; only its sums
    reach the driver.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("bigint")
    rows = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most).withColumn("full", F.lit(False))
    while True:
        rows = staged(rows, "mix-targets")
        s = rows.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(F.col("full"), F.col("cap"))).alias("given"), F.sum(F.when(~F.col("full"), F.col("weight"))).alias("open")
        ).first()
        left, open_ = (s["all"] or 0) - (s["given"] or 0), s["open"] or 1
        share = F.lit(left) * F.col("weight") / F.lit(open_)
        above = ~F.col("full") & (share > F.col("cap"))
        if rows.filter(above).isEmpty():
            return rows.select("key", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"))
        rows = rows.withColumn("full", F.col("full") | above)


def running_sums(rows: DataFrame, group: str, order: list[str], value: str, name: str) -> DataFrame:
    """`rows` (staged) with `name`: the sum of `value` over the rows of the group before this one.

    A group is cut into ranges of its order; inside a range a window sums, and one row per range and group carries over.
    """
    by = [group, *order]
    ranged = rows.repartitionByRange(range_partitions(rows), *by).withColumn("_part", F.struct(F.spark_partition_id().alias("range"), F.col(group).alias("group")))
    ranged = staged(ranged, "mix-order")
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    across = Window.partitionBy(F.col("_part")["group"]).orderBy(F.col("_part")["range"]).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_part").agg(F.sum(value).alias("_sum")).select("_part", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_start"))
    return local.join(starts, "_part").withColumn(name, F.col("_start") + F.col("_local")).drop("_part", "_local", "_start")


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    most: int = 3,
    quality: DataFrame | None = None,
    seed: int = 13,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per row of `docs`: id, source, size (words), source_size, target (of its source), epochs, taken.

    `taken` counts the words that the mix takes from the row: `epochs` times its size, once more if the row lies wholly
    inside the rest of its source's target, and its first words if it is the row in which that rest ends. A source's
    taken words are its target, rounded. `quality` (id, weight) gives documents positive weights, such as the scores of a
    classifier; of several weights of one id the greatest counts, and a missing, null, zero, negative or non-finite one
    is 1. A heavier row is likelier to be in the rest. Sources go by code point, null is a source of its own and comes last.
    Null text has no words, and rows without words give none. Rows with the same id, text and source are drawn one after
    another. The draw depends on seed, id, text and weight alone, so reruns and other partitionings agree. Other columns
    are not read. An empty table gives an empty one.
    """
    text = plain_text(text_col)
    key = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("~")).alias("key")
    exponential = (-F.log(draw(seed, F.col(id_col), F.sha2(text, 256)))).alias("draw")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), key, n_words(text).alias("size"), exponential, F.monotonically_increasing_id().alias("row"))
    rows = staged(rows, "mix-rows")
    if quality is not None:
        weights_of = quality.toDF("id", "weight").filter("weight > 0 AND weight < DOUBLE('Infinity')")
        weights_of = weights_of.groupBy("id").agg(F.max(F.col("weight").cast("double")).alias("weight"))
        rows = rows.join(weights_of, "id", "left").withColumn("draw", F.col("draw") / F.coalesce("weight", F.lit(1.0))).drop("weight")
        rows = staged(rows, "mix-weighted")
    sources = staged(rows.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "mix-sources")
    ranked = with_position(sources.select("key", "source_size"), ["key"], name="rank")
    wanted = targets(ranked, weights, most)
    # A target is `epochs` times the whole source and `rest` words more.
    budget = F.least(F.round("target").cast("bigint"), F.col("source_size") * most)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    facts = wanted.withColumn("budget", budget).withColumn("epochs", epochs).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    facts = staged(facts.drop("budget").join(sources.select("key", "n"), "key"), "mix-facts")
    with_facts = staged(join_facts(rows, facts, "key", "n").drop("n"), "mix-facts-rows")
    drawn = running_sums(with_facts, "key", ["draw", "id", "row"], "size", "before")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    taken = (F.col("epochs") * F.col("size") + part).alias("taken")
    return drawn.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "epochs", taken)
