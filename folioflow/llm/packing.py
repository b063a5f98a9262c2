"""Packing documents into sequences of a fixed length by best-two-fit.

Pieces of equal length are interchangeable, so the packing is worked out on the histogram of lengths, which has at most
as many rows as a sequence has tokens. A bin is filled greedily with the longest piece that still fits; then its
smallest piece gives way to two unpacked ones that fill the widened gap better. A bin's make-up is used for as many
bins as the histogram allows. The pieces themselves never meet: each has a number among those of its length, and looks
its place up in the plan.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.common import plain_text, staged
from folioflow.llm.tokens import BATCH_BYTES, by_bytes, encoder, text_sizes

FULL_BASE = 1 << 61
PIECE = "id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint"


def bin_plan(counts: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """Bins as (lengths in the bin, how many such bins) that use up `counts` (length -> pieces), none over `size`.

    Lengths run from 1 to `size`. Every make-up uses up at least one length or all but a few of it, so there are about as
    many make-ups as lengths, however many pieces there are.
    """
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        if not 1 <= length <= size:
            raise ValueError(f"length {length} is not between 1 and {size}")
        left[length] = n
    lengths = np.arange(size + 1)
    plan = []
    while left.any():
        bin_, gap = [], size
        while gap:
            fits = np.flatnonzero(left[: gap + 1])
            if not len(fits):
                break
            longest = int(fits[-1])
            n = min(int(left[longest]), gap // longest)
            left[longest] -= n
            bin_ += [longest] * n
            gap -= longest * n
        while gap:
            smallest = bin_[-1]
            room = smallest + gap
            under = np.maximum.accumulate(np.where(left > 0, lengths, 0))
            first = np.flatnonzero(left[: room + 1])
            other = np.minimum(first, room - first)
            second = under[other]
            second = np.where((second == first) & (left[first] < 2), under[np.maximum(second - 1, 0)], second)
            total = np.where(second > 0, first + second, 0)
            best = int(np.argmax(total)) if len(total) else 0
            if not len(total) or total[best] <= smallest:
                break
            pair = [int(first[best]), int(second[best])]
            left[smallest] += 1
            left[pair] -= 1 if pair[0] != pair[1] else 0
            if pair[0] == pair[1]:
                left[pair[0]] -= 2
            bin_ = sorted(bin_[:-1] + pair, reverse=True)
            gap = room - sum(pair)
        own, times = np.unique(bin_, return_counts=True)
        more = int((left[own] // times).min())
        left[own] -= times * more
        plan.append((bin_, 1 + more))
    return plan


class Places:
    """The plan as arrays: from (length, number among the pieces of that length) to (sequence, offset)."""

    def __init__(self, plan: list[tuple[list[int], int]]):
        used: dict[int, int] = {}
        rows, base = [], 0
        for lengths, copies in plan:
            at: dict[int, list[int]] = {}
            offset = 0
            for length in lengths:
                at.setdefault(length, []).append(offset)
                offset += length
            for length, offsets in at.items():
                # Equal lengths lie side by side, so their offsets are an arithmetic row.
                rows.append((length, used.get(length, 0), base, len(offsets), offsets[0]))
                used[length] = used.get(length, 0) + copies * len(offsets)
            base += copies
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.keys = (table[:, 0] << 48) | table[:, 1]
        self.start, self.base, self.per_bin, self.offset = table[:, 1], table[:, 2], table[:, 3], table[:, 4]

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.keys, (length << 48) | rank, "right") - 1
        local = rank - self.start[row]
        return self.base[row] + local // self.per_bin[row], self.offset[row] + (local % self.per_bin[row]) * length


def token_pieces(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most `size` tokens, each document closed by `end_id`.

    Per piece: id, piece (from 0), start, length, ids_crc32; part and rank number the pieces of a length within a
    task; with `with_ids` also the ids as little-endian 32-bit bytes. Only documents of more than `size` tokens are cut; their
    first piece takes the remainder. Null text counts as empty: one piece with the end id.
    """

    def run(batches):
        encode = encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        names = ["id", "piece", "start", "length", "ids_crc32", "part", "rank"] + ["ids"] * with_ids
        for batch in batches:
            texts = batch.column(1)
            for lo, hi in by_bytes(text_sizes(texts), BATCH_BYTES):
                row, piece, start, length, crc, rank, kept = [], [], [], [], [], [], []
                for i, ids in enumerate(encode.encoded(texts.slice(lo, hi - lo).to_pylist()), lo):
                    ids += end
                    n = len(ids) // 4
                    begin, stop, k = 0, (n - 1) % size + 1, 0
                    while begin < n:
                        own = ids[4 * begin : 4 * stop]
                        row.append(i)
                        piece.append(k)
                        start.append(begin)
                        length.append(stop - begin)
                        crc.append(zlib.crc32(own))
                        rank.append(seen[stop - begin])
                        seen[stop - begin] += 1
                        if with_ids:
                            kept.append(own)
                        begin, stop, k = stop, stop + size, k + 1
                columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                columns += [pa.array([part] * len(row), pa.int32()), pa.array(np.array(rank, np.int64))]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * with_ids, names)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), plain_text(text_col).alias("text"))
    return rows.mapInArrow(run, PIECE.format(kind=kind) + ", ids binary" * with_ids)


def packed(docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Where each piece of each document goes: id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Every row of `docs` is packed, rows with null or repeated ids too; an empty table gives an empty one. Other columns
    are not read. Sequences hold at most `size` tokens; a piece of `size` tokens is a sequence of its own.
    """
    pieces = staged(token_pieces(docs, tokenizer_path, size, end_id, id_col, text_col, with_ids), "pieces")
    rest = pieces.filter(F.col("length") < size)
    sizes = staged(rest.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-sizes")
    # At most size - 1 rows.
    histogram = {int(r["length"]): int(r["n"]) for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(bin_plan(histogram, size))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = rest.join(starts, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("first")).select(pieces.columns)

    def place(batches):
        for batch in batches:
            at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            sequence, offset = places.find(at["length"].to_numpy(), at["rank"].to_numpy())
            out = [c for name, c in at.items() if name not in ("part", "rank")]
            names = [name for name in at if name not in ("part", "rank")]
            yield pa.RecordBatch.from_arrays([*out, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    kept = [f for f in pieces.schema.fields if f.name not in ("part", "rank")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", sequence_id bigint, offset bigint"
    mixed = ranked.mapInArrow(place, schema)
    number = F.lit(FULL_BASE) + F.shiftleft(F.col("part").cast("bigint"), 36) + F.col("rank")
    full = pieces.filter(F.col("length") == size).select(*[f.name for f in kept], number.alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return mixed.unionByName(full).withColumnRenamed("id", id_col)


def sequences(placed: DataFrame) -> DataFrame:
    """The sequences themselves, from `packed(..., with_ids=True)`: sequence_id, n_tokens, ids (little-endian 32-bit bytes).

    A sequence holds at most `size` tokens, so its group is bounded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda all_, x: F.concat(all_, x["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
