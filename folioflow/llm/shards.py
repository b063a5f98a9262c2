"""Shards by balanced label propagation.

Rows that share a link value are linked. Each round, linked rows look where most rows of their strongest link are and
move there, as far as the shards' quotas allow; rows without links fill what is left. The quotas are worked out on
counts by pair of shards; the rows move by joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import join_facts, numbered, plain_text, staged


def flows(wants: dict[tuple[int, int], int], inside: list[int], quota: list[int]) -> dict[tuple[int, int], int]:
    """How many of the rows that want from one shard to another may go, so that none ends above its quota.

    `inside` counts the linked rows of each shard. What leaves a shard makes room in it; where too much wants in, the
    flows into that shard shrink in proportion, until all shards hold.
    """
    allowed = dict(wants)
    while True:
        over = None
        for j in range(len(quota)):
            into = sum(n for (_, b), n in allowed.items() if b == j)
            out = sum(n for (a, _), n in allowed.items() if a == j)
            if into and inside[j] + into - out > quota[j]:
                over = (j, into, max(0, quota[j] - inside[j] + out))
                break
        if over is None:
            return {k: n for k, n in allowed.items() if n}
        j, into, most = over
        left = most
        for k in sorted(k for k in allowed if k[1] == j):
            share = min(left, allowed[k] * most // into)
            allowed[k] = share
            left -= share


def balanced_shards(docs: DataFrame, n_shards: int = 16, links: DataFrame | None = None, rounds: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id, size (UTF-8 bytes and 1), text_crc32, law (`rows`), shard, slot (from 0 in each shard).

    Row counts of the shards are at most one apart. `links` (id, link) says which rows are linked, by id; without it,
    rows of equal text are. A set of linked rows larger than a shard spreads over as few shards as can hold it, if the
    others leave room. Null text counts as empty. Null and repeated ids are placed like any other row. Other columns
    are not read. An empty table gives an empty one.
    """
    text = plain_text(text_col)
    raw = text.cast("binary")
    columns = [F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32")]
    same = [] if links is not None else [F.unhex(F.sha2(raw, 256)).alias("link")]
    rows = staged(docs.select(*columns, *same), "shard-rows")
    edges = rows.select("row", "link") if links is None else rows.select("row", "id").join(links.toDF("id", "link"), "id").select("row", "link").distinct()
    edges = staged(edges, "shard-edges") if links is not None else edges
    sizes = staged(edges.groupBy("link").agg(F.count("*").alias("n")).filter("n > 1"), "shard-links")
    edges = staged(join_facts(edges, sizes, "link", "n"), "shard-edges")

    total = rows.count()
    quota = [total // n_shards + (j < total % n_shards) for j in range(n_shards)]
    placed = numbered(rows.select("row"), [], ["row"], "number").withColumn("shard", (F.col("number") % n_shards).cast("int")).drop("number")
    placed = staged(placed.join(edges.select("row", F.lit(True).alias("linked")).distinct(), "row", "left"), "shard-start")
    labels = placed.filter("linked").select("row", "shard")

    room = max(1, min(quota, default=1))

    def by_shard() -> dict[int, int]:
        return {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.count("*").alias("n")).collect()}

    inside = by_shard()
    for turn in range(rounds):
        spots = staged(edges.join(labels, "row"), "shard-spots")
        counts = spots.groupBy("link", "n", "shard").agg(F.count("*").alias("c"))
        tie = F.xxhash64("link", "shard", F.lit(turn))
        # At most one entry per shard.
        ranked = counts.groupBy("link", "n").agg(F.sort_array(F.collect_list(F.struct("c", tie.alias("tie"), "shard")), asc=False).alias("ranked"))
        # A set that fits looks for a shard with room. One that does not fit takes as many shards as it needs, and one
        # more every few rounds, should others hold places there.
        large = F.col("n") > room
        full = [j for j in range(n_shards) if inside.get(j, 0) >= quota[j]]
        open_ = F.filter("ranked", lambda g: ~g["shard"].isin(full)) if full else F.col("ranked")
        usable = F.when(large | (F.size("ranked") == 1) | (F.size(open_) == 0), F.col("ranked")).otherwise(open_)
        needed = F.when(large, F.ceil(F.col("n") / room) + turn // 3).otherwise(1).cast("int")
        goals = staged(ranked.select("link", "n", F.slice(usable, 1, F.least(F.size(usable), needed)).alias("goals")), "shard-goals")
        # Of several goals a row wishes for one with room, if there is one.
        roomy = F.filter("goals", lambda g: ~g["shard"].isin(full)) if full else F.col("goals")
        roomy = F.when(F.size(roomy) > 0, roomy).otherwise(F.col("goals"))
        wish = F.element_at(roomy, (F.pmod(F.xxhash64("row", F.lit(turn)), F.size(roomy)) + 1).cast("int"))
        stays = F.exists("goals", lambda g: g["shard"] == F.col("shard"))
        seen = join_facts(spots.drop("n"), goals, "link", "n")
        # A row with several links follows the one with most rows in one place.
        choice = seen.groupBy("row", "shard").agg(F.max(F.struct(F.element_at("goals", 1)["c"].alias("c"), stays.alias("stays"), wish["shard"].alias("to"))).alias("best"))
        movers = staged(choice.filter(~F.col("best.stays")).select("row", "shard", F.col("best.to").alias("to")), "shard-movers")
        # At most n_shards squared and n_shards rows.
        wants = {(r["shard"], r["to"]): r["n"] for r in movers.groupBy("shard", "to").agg(F.count("*").alias("n")).collect()}
        allowed = flows(wants, [inside.get(j, 0) for j in range(n_shards)], quota)
        if not wants:
            break
        if not allowed:
            continue
        limits = docs.sparkSession.createDataFrame([(a, b, n) for (a, b), n in sorted(allowed.items())], "shard int, to int, allowed bigint")
        turned = numbered(movers, ["shard", "to"], ["row"], "number").join(F.broadcast(limits), ["shard", "to"]).filter("number < allowed")
        moved = labels.join(turned.select("row", "to"), "row", "left")
        labels = staged(moved.select("row", F.coalesce("to", "shard").alias("shard")), "shard-labels")
        inside = by_shard()

    ends, end = [], 0
    for j in range(n_shards):
        end += quota[j] - inside.get(j, 0)
        ends.append(end)
    free = numbered(placed.filter("linked IS NULL").select("row"), [], ["row"], "number")
    filled = free.select("row", F.size(F.filter(F.array(*map(F.lit, ends)), lambda x: x <= F.col("number"))).alias("shard"))
    final = staged(labels.unionByName(filled), "shard-final")
    slots = numbered(final, ["shard"], ["row"], "slot")
    return rows.join(slots, "row").select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot")
