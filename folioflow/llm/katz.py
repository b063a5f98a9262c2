"""Scoring texts by a Katz model of any order: Good-Turing discounted counts, exactly normalised backoff weights.

Words enter as 64-bit hashes. Tasks gather their documents in blocks of a bounded number of tokens and ask for each
distinct word of a block once: requests are dealt into parts by word, counted there, and answered block by block. Then come
the pairs, the triples … up to the order, each level in the same way: a gram is a context, which is a gram of the level
below, and a word, and is dealt to the part of its context. Its request carries the two counts whose ratio is the probability
that the level below gives the word, so that the part can sum up what a context's followers take from it. A context that holds more than 1/1000
of the training tokens has its grams dealt by their last word, so that no part gathers a hot context.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from folioflow.llm.common import HOT_PARTS, bucketed, plain_text
from folioflow.llm.tokens import by_bytes, text_sizes
from folioflow.llm.words import batch_hashes
from folioflow.session import shuffle_partitions, work_dir

K = 5  # counts up to K are discounted
BLOCK_TOKENS = 2_000_000
PART_WORDS = 250_000  # requested words of a part, about
START, END = np.uint64(0), np.uint64(1)  # no word: START only stands before the first word
PART_BITS = 24  # of the number of a word within its part
GRAM_BITS = 32  # of the number of a longer gram within its part
HOT = np.uint64(1 << 62)  # marks a hot context in requests


def _pack(x: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(raw: bytes, dtype) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(data.reshape(size, -1).T).view(dtype).reshape(-1)


def _pack_steps(x: np.ndarray) -> bytes:
    """Like `_pack`, for numbers that mostly rise."""
    return _pack(np.diff(x, prepend=x.dtype.type(0)))


def _unpack_steps(raw: bytes, dtype) -> np.ndarray:
    return np.cumsum(_unpack(raw, dtype), dtype=dtype)


def _by_frequency(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and where each entry's is among them: frequent ones first, so that most places are small numbers,
    and rising among those about as frequent."""
    values, where, n = np.unique(x, return_inverse=True, return_counts=True)
    order = np.argsort(-np.frexp(n)[1], kind="stable")
    place = np.empty(len(values), np.uint32)
    place[order] = np.arange(len(values), dtype=np.uint32)
    return values[order], place[where]


def _pack_values(x: np.ndarray) -> bytes:
    """Like `_pack`, for wide numbers of which many are equal."""
    values, place = _by_frequency(x)
    first = _pack_steps(values)
    return len(first).to_bytes(8, "little") + first + _pack(place)


def _unpack_values(raw: bytes, dtype) -> np.ndarray:
    end = 8 + int.from_bytes(raw[:8], "little")
    return _unpack_steps(raw[8:end], dtype)[_unpack(raw[end:], np.uint32)]


def _column_bytes(values: list, kind: pa.DataType) -> bytes:
    """A column of any type as bytes."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.array(values, kind)], ["x"])
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _column_of(raw: bytes) -> pa.ChunkedArray:
    return pa.ipc.open_stream(raw).read_all().column(0)


def _blobs(items: list[bytes]) -> pa.Array:
    return pa.array(items, pa.binary())


# ---- the model's numbers


def discounts(n: list[int]) -> np.ndarray:
    """Factors d[r] for counts r = 0 .. K (d[0] unused) from n[r], the number of types with count r, r = 0 .. K + 1.

    Katz's Good-Turing factors; where the counts of counts are too irregular for them (a factor outside 0 to 1), absolute
    discounting by n1 / (n1 + 2 n2).
    """
    d = np.ones(K + 1)
    if all(n[r] > 0 for r in range(1, K + 1)):
        common = (K + 1) * n[K + 1] / n[1]
        if common < 1:
            for r in range(1, K + 1):
                d[r] = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
            if (d[1:] > 0).all() and (d[1:] <= 1).all() and (d[1:] < 1).any():
                return d
    off = min(max(n[1] / (n[1] + 2 * n[2]), 0.1), 0.9) if n[1] else 0.5
    d[1:] = 1 - off / np.arange(1, K + 1)
    return d


@dataclass(frozen=True)
class Unigrams:
    total: int
    types: int
    d: np.ndarray
    unknown: float
    below: int  # added to the total where nothing is discounted

    @classmethod
    def of(cls, total: int, n: list[int]) -> Unigrams:
        """n: types by count, 0 .. K + 1, the last entry all types."""
        types, n = n[-1], n[:-1]
        d = discounts(n)
        free = sum(n[r] * r * (1 - d[r]) for r in range(1, K + 1))
        below = 0 if free > 0 else 1
        return cls(total, types, d, (free or 1) / (total + below) if total else 1.0, below)

    def p(self, c: np.ndarray) -> np.ndarray:
        """Probability of a word with training count c; 0 means the one unknown word."""
        c = c.astype(np.float64)
        factor = np.where(c <= K, self.d[np.minimum(c, K).astype(int)], 1.0)
        return np.where(c > 0, factor * c / max(1, self.total + self.below), self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.total + 0.5 * (self.types + 1)))


def gram_bases(total: np.ndarray, low: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of contexts: the count that discounts leave free, and what the counts of their grams are divided by."""
    free = (low * (np.arange(1, K + 1) * (1 - d[1:]))).sum(1)
    return free, np.where(free > 0, total, total + 1)


def seen_probabilities(c: np.ndarray, below: np.ndarray, d: np.ndarray) -> np.ndarray:
    """P(w | context) of grams that were seen, by their counts and what these are divided by; 0 for a count of 0."""
    return np.where(c <= K, d[np.minimum(c, K).astype(int)], 1.0) * c / np.maximum(below, 1)


def gram_probabilities(c: np.ndarray, lower: np.ndarray, total: np.ndarray, low: np.ndarray, seen: np.ndarray, d: np.ndarray) -> np.ndarray:
    """P(w | context) by gram: its count c, P(w | shorter context), and of the context the total, the types by count 1 .. K
    (`low`, one column each) and what the level below gives its followers (`seen`). Unseen grams back off to that level."""
    free, below = gram_bases(total, low, d)
    left = np.where(free > 0, free, 1.0) / np.maximum(below, 1)
    alpha = np.where(total > 0, left / np.maximum(1 - seen, 1e-300), 1.0)
    return np.where(c > 0, seen_probabilities(c, below, d), alpha * lower)


# ---- blocks


BLOCK = "block bigint, ids binary, held binary, sizes binary, words binary, tokens binary, counts binary"


def _blocks(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    """Blocks of documents, with their ids: nothing has to be joined to them later."""

    def run(batches):
        part, n, kind = TaskContext.get().partitionId(), 0, None
        rows, held, hashes, size = [], [], [], 0

        def flush():
            nonlocal rows, held, hashes, size, n
            sizes = np.array([len(h) + 1 for h in hashes], np.uint32)
            every = np.full(int(sizes.sum()), END, np.uint64)
            ends = np.cumsum(sizes) - 1
            inside = np.ones(len(every), bool)
            inside[ends] = False
            every[inside] = np.concatenate(hashes)
            words, tokens = np.unique(np.concatenate([[START], every]).astype(np.uint64), return_inverse=True)
            tokens = tokens[1:].astype(np.uint32)
            training = np.repeat(~np.array(held), sizes)
            counts = np.bincount(tokens[training], minlength=len(words)).astype(np.uint32)
            out = pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + n]), *map(_blobs, ([_column_bytes(rows, kind)], [np.array(held, np.uint8).tobytes()], [_pack(sizes)], [words.tobytes()], [_pack(tokens)], [_pack(counts)]))],
                [c.split()[0] for c in BLOCK.split(", ")],
            )
            rows, held, hashes, size, n = [], [], [], 0, n + 1
            return out

        for batch in batches:
            texts, kind = batch.column(2), batch.column(0).type
            for lo, hi in by_bytes(text_sizes(texts)):
                every, before = batch_hashes(texts.slice(lo, hi - lo).to_pylist())
                for i, (a, b) in enumerate(zip(before[:-1], before[1:], strict=True), lo):
                    rows.append(batch.column(0)[i].as_py())
                    held.append(batch.column(1)[i].as_py())
                    hashes.append(every[a:b])
                    size += b - a + 1
                if size >= BLOCK_TOKENS:
                    yield flush()
        if rows:
            yield flush()

    chosen = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), plain_text(text_col).alias("text"))
    return chosen.mapInArrow(run, BLOCK)


def _edges(words: np.ndarray, parts: int) -> np.ndarray:
    """Where each part's words begin among sorted hashes: parts are equal ranges of hashes."""
    starts = [(p << 64) // parts for p in range(1, parts)]
    return np.concatenate([[0], np.searchsorted(words, np.array(starts, np.uint64)), [len(words)]]).astype(np.int64)


ASK_WORDS = "part int, block bigint, words binary, counts binary"
ANSWER = "kind int, part int, block bigint, a binary, b binary, c binary, d binary"
_NAMES = [c.split()[0] for c in ANSWER.split(", ")]


def _answer(kind, part, block, *blobs) -> list:
    return [kind, part, block, *blobs, *[None] * (4 - len(blobs))]


def _answers(rows: list[list]) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=_NAMES)


def _ask_words(parts: int):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                words, counts = np.frombuffer(r["words"], np.uint64), _unpack(r["counts"], np.uint32)
                at = _edges(words, parts)
                own = [p for p in range(parts) if at[p] < at[p + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), pa.array([r["block"]] * len(own), pa.int64()), _blobs([words[at[p] : at[p + 1]].tobytes() for p in own]), _blobs([_pack(counts[at[p] : at[p + 1]]) for p in own])],
                    ["part", "block", "words", "counts"],
                )

    return run


def _count_words(asked: pa.Table) -> pa.Table:
    """kind 0: the counts of the part's words; kind 1: to a block, the numbers in the part and the counts of its words."""
    rows = asked.to_pylist()
    part = rows[0]["part"]
    words = [np.frombuffer(r["words"], np.uint64) for r in rows]
    known, where = np.unique(np.concatenate(words), return_inverse=True)
    if len(known) >= 1 << PART_BITS:
        raise ValueError("too many words in a part: lower PART_WORDS")
    counts = np.zeros(len(known), np.int64)
    np.add.at(counts, where, np.concatenate([_unpack(r["counts"], np.uint32) for r in rows]).astype(np.int64))
    out, at = [_answer(0, part, None, _pack(counts))], 0
    for r, w in zip(rows, words, strict=True):
        own = where[at : at + len(w)]
        at += len(w)
        out.append(_answer(1, part, r["block"], _pack(own.astype(np.uint32)), _pack(counts[own])))
    return _answers(out)


@dataclass
class _Grams:
    """The distinct grams of one length in a block, and where each token's gram is among them."""

    at: np.ndarray
    start: int  # the gram of nothing but START
    part: np.ndarray
    # What only an answer says: number in all parts, training count, what that is divided by, whether hot as a context,
    # P(last word | the others).
    ids: np.ndarray | None = None
    counts: np.ndarray | None = None
    base: np.ndarray | None = None
    hot: np.ndarray | None = None
    p: np.ndarray | None = None
    # Of two words or more: context (a gram of the level below), last word, the gram without its first word; count in the block.
    left: np.ndarray | None = None
    right: np.ndarray | None = None
    suffix: np.ndarray | None = None
    n: np.ndarray | None = None

    def in_parts(self, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Grams in the order of their parts, and where each part begins."""
        order = np.argsort(self.part, kind="stable")
        return order, np.searchsorted(self.part[order], np.arange(parts + 1))


@dataclass(frozen=True)
class Level:
    """Of one length of grams: discounts; and of hot contexts id, total, types by count 1 .. K, what their followers have below."""

    d: np.ndarray
    hot: tuple[np.ndarray, ...]


@dataclass(frozen=True)
class Model:
    parts: int
    total: int
    uni: Unigrams
    order: int
    levels: tuple[Level, ...] = ()  # of pairs, triples …, as far as counted


def _words(block: dict, answers: list[dict], model: Model) -> _Grams:
    answers = sorted((a for a in answers if a["level"] == 1), key=lambda a: a["part"])
    own = [_unpack(a["a"], np.uint32) for a in answers]
    part = np.repeat(np.array([a["part"] for a in answers], np.int64), [len(x) for x in own])
    ids = (part.astype(np.uint64) << np.uint64(PART_BITS)) | np.concatenate(own).astype(np.uint64)
    counts = np.concatenate([_unpack(a["b"], np.int64) for a in answers])
    start = int(np.searchsorted(np.frombuffer(block["words"], np.uint64), START))
    # Every document begins at START.
    hot = counts * HOT_PARTS > model.total
    hot[start] = True
    base = np.full(len(counts), model.uni.total + model.uni.below, np.int64)
    return _Grams(_unpack(block["tokens"], np.uint32).astype(np.int32), start, part, ids, counts, base, hot, model.uni.p(counts))


def _longer(block: dict, below: _Grams, words: _Grams, last: bool) -> _Grams:
    """The grams of one word more than `below`; where they are contexts to come, also the one that documents begin at."""
    sizes = _unpack(block["sizes"], np.uint32)
    before = np.concatenate([[0], below.at[:-1]]).astype(np.int64)
    before[np.cumsum(sizes) - sizes] = below.start
    n_words, ends = len(words.ids), [] if last else [0]
    code = before * n_words + words.at
    code, at = np.unique(np.concatenate([code, [below.start * n_words + words.start for _ in ends]]).astype(np.int64), return_inverse=True)
    at, start = at[: len(words.at)].astype(np.int32), -1 if last else int(at[-1])
    left, right = (code // n_words).astype(np.int32), (code % n_words).astype(np.int32)
    suffix = np.full(len(code), below.start, np.int32)
    suffix[at] = below.at
    training = np.repeat(np.frombuffer(block["held"], np.uint8) == 0, sizes)
    n = np.bincount(at[training], minlength=len(code)).astype(np.uint32)
    part = np.where(below.hot[left], words.part[right], below.part[left])
    return _Grams(at, start, part, left=left, right=right, suffix=suffix, n=n)


def _answered(grams: _Grams, below: _Grams, answers: list[dict], level: Level, model: Model, last: bool) -> None:
    order, _ = grams.in_parts(model.parts)
    counted = sorted((a for a in answers if a["kind"] == 3), key=lambda a: a["part"])
    c = np.zeros(len(grams.n), np.int64)
    c[order] = np.concatenate([_unpack(a["a"], np.int64) for a in counted])
    if not last:
        ids = [(np.uint64(a["part"]) << np.uint64(GRAM_BITS)) | _unpack_steps(a["b"], np.uint32).astype(np.uint64) for a in counted]
        grams.ids = np.zeros(len(c), np.uint64)
        grams.ids[order] = np.concatenate(ids)
        grams.hot = c * HOT_PARTS > model.total
        grams.hot[grams.start] = True
    # Sums by context: of the part of a plain context, in the order of ids, or all parts' together of a hot one.
    size = len(below.ids)
    totals, low, mass = np.zeros(size, np.int64), np.zeros((size, K), np.uint32), np.zeros(size)
    contexts = np.zeros(size, bool)
    contexts[grams.left] = True
    plain = np.flatnonzero(contexts & ~below.hot)
    plain = plain[np.argsort(below.ids[plain])]
    sums = sorted((a for a in answers if a["kind"] == 4), key=lambda a: a["part"])
    # In training texts a word or the end follows every plain context: its total is its own count.
    totals[plain] = below.counts[plain]
    low[plain] = np.concatenate([_unpack(a["a"], np.uint32) for a in sums]).reshape(-1, K)
    mass[plain] = np.concatenate([_unpack(a["b"], np.float64) for a in sums])
    hot_ids, hot_totals, hot_low, hot_mass = level.hot
    i = np.flatnonzero(below.hot)
    j = np.searchsorted(hot_ids, below.ids[i])
    there = (j < len(hot_ids)) & (hot_ids[np.minimum(j, len(hot_ids) - 1)] == below.ids[i]) if len(hot_ids) else np.zeros(len(i), bool)
    i, j = i[there], j[there]
    totals[i], low[i], mass[i] = hot_totals[j], hot_low[j], hot_mass[j]
    grams.counts = c
    if not last:
        grams.base = gram_bases(totals, low, level.d)[1][grams.left]
    grams.p = np.empty(len(c))
    for a in range(0, len(c), 1 << 18):
        own = slice(a, a + (1 << 18))
        v = grams.left[own]
        grams.p[own] = gram_probabilities(c[own], below.p[grams.suffix[own]], totals[v], low[v], mass[v], level.d)


def _levels(block: dict, answers: list[dict], model: Model) -> tuple[_Grams, _Grams]:
    """The words of a block, and its grams of the greatest length that `model` has counts of; each level from the one below."""
    words = below = _words(block, answers, model)
    for k, level in enumerate(model.levels, 2):
        grams = _longer(block, below, words, k == model.order)
        _answered(grams, below, [a for a in answers if a["level"] == k], level, model, k == model.order)
        below = grams
    return words, below


ASK_GRAMS = "part int, block bigint, v binary, words binary, w binary, n binary, c binary, base binary"


def _ask_grams(model: Model):
    def run(key, block: pa.Table, answers: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in ASK_GRAMS.split(", ")]
        rows = []
        if block.num_rows:
            block = block.to_pylist()[0]
            words, below = _levels(block, answers.to_pylist(), model)
            own = _longer(block, below, words, len(model.levels) + 2 == model.order)
            order, at = own.in_parts(model.parts)
            for p in range(model.parts):
                i = order[at[p] : at[p + 1]]
                if len(i):
                    v, suffix = own.left[i], own.suffix[i]
                    # Each last word's id is sent once.
                    last, w = _by_frequency(own.right[i])
                    # Only grams that training texts of the block have add to their context's sums; the level below has seen
                    # them too. Without its first word a pair is its last word, whose count is sent once as well.
                    lower = np.where(own.n[i] > 0, below.counts[suffix], 0) if model.levels else below.counts[last]
                    # The grams of a context lie side by side; without their first word they have one context too.
                    starts = np.flatnonzero(np.diff(v, prepend=-1))
                    base = below.base[suffix[starts]]
                    if model.levels:
                        base = np.where(np.add.reduceat(own.n[i], starts) > 0, base, 0)  # of no use where all counts sent are 0
                    asked = [_pack_steps(below.ids[v] | np.where(below.hot[v], HOT, np.uint64(0))), _pack_steps(words.ids[last]), _pack(w), _pack(own.n[i])]
                    rows.append([p, block["block"], *asked, _pack(lower), _pack_values(base)])
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

    return run


def _sums(v: np.ndarray, c: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, ...]:
    """By context: id, total, types by count 1 .. K, what the level below gives its followers. Only grams that were seen."""
    seen = c > 0
    ids, where = np.unique(v[seen], return_inverse=True)
    c, mass = c[seen], mass[seen]
    low = np.stack([np.bincount(where, c == r, len(ids)) for r in range(1, K + 1)], 1).astype(np.uint32)
    return ids, np.bincount(where, c, len(ids)).astype(np.int64), low, np.bincount(where, mass, len(ids))


def _lower(v: np.ndarray, c: np.ndarray, base: np.ndarray, d: np.ndarray) -> np.ndarray:
    """What the level below, discounted by `d`, gives the last words of a request's grams; `base` has one number for each context."""
    first = np.ones(len(v), bool)
    first[1:] = v[1:] != v[:-1]
    return seen_probabilities(c, base[np.cumsum(first) - 1], d)


def _count_grams(last: bool, pairs: bool, d: np.ndarray):
    """kind 2: the counts of the part's grams; 3: to a block, counts and numbers of its grams; 4: to a block, sums
    of its plain contexts (types by count, exactly where the block backs off, and what the level below, discounted by `d`,
    gives their followers); 5: the part's share of the sums of hot contexts, which other parts have too."""

    def run(asked: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        part = rows[0]["part"]
        v = [_unpack_steps(r["v"], np.uint64) for r in rows]
        w = [_unpack(r["w"], np.uint32) for r in rows]
        c = [_unpack(r["c"], np.int64)[at if pairs else slice(None)] for at, r in zip(w, rows, strict=True)]
        p = np.concatenate([_lower(own, x, _unpack_values(r["base"], np.int64), d) for own, x, r in zip(v, c, rows, strict=True)])
        v = np.concatenate(v)
        w = np.concatenate([_unpack_steps(r["words"], np.uint64)[at] for at, r in zip(w, rows, strict=True)])
        n = [_unpack(r["n"], np.uint32) for r in rows]
        sizes = [len(x) for x in n]
        n = np.concatenate(n).astype(np.int64)
        order = np.lexsort((w, v))
        new = np.ones(len(v), bool)
        new[1:] = (np.diff(v[order]) != 0) | (np.diff(w[order]) != 0)
        where = np.empty(len(v), np.int64)
        where[order] = np.cumsum(new) - 1
        first = order[new]
        if len(first) >= 1 << GRAM_BITS:
            raise ValueError("too many grams in a part: lower PART_WORDS")
        c = np.bincount(where, n, len(first)).astype(np.int64)
        # Blocks with the gram in held-out texts only may send no probability.
        lower = np.zeros(len(first))
        np.maximum.at(lower, where, p)
        del p, n, w, order, new
        pv = v[first]
        out = [_answer(2, part, None, _pack(c[c > 0]))]
        ids, totals, low, mass = _sums(pv, c, lower)
        at = 0
        for r, size in zip(rows, sizes, strict=True):
            own = slice(at, at + size)
            at += size
            out.append(_answer(3, part, r["block"], _pack(c[where[own]]), None if last else _pack_steps(where[own].astype(np.uint32))))
            own_v, which = np.unique(v[own], return_inverse=True)
            # A block reads the sum of the followers only to back off from a context, and else of the types by count only
            # which there are: whether anything is discounted.
            backs_off = np.bincount(which, c[where[own]] == 0, len(own_v)) > 0
            plain = (own_v & HOT) == 0
            own_v, backs_off = own_v[plain], backs_off[plain]
            i = np.searchsorted(ids, own_v)
            found = (i < len(ids)) & (ids[np.minimum(i, len(ids) - 1)] == own_v) if len(ids) else np.zeros(len(own_v), bool)
            l, m = np.zeros((len(own_v), K), np.uint32), np.zeros(len(own_v))
            l[found], m[found] = low[i[found]], mass[i[found]]
            l = np.where(backs_off[:, None], l, np.minimum(l, 1))
            out.append(_answer(4, part, r["block"], _pack(l.reshape(-1)), _pack(np.where(backs_off, m, 0.0))))
        # A hot context is one of at most HOT_PARTS grams, or START; its grams lie in the parts of their last words.
        spread = (ids & HOT) > 0
        out.append(_answer(5, part, None, _pack(ids[spread] & ~HOT), _pack(totals[spread]), _pack(low[spread].reshape(-1)), _pack(mass[spread])))
        return _answers(out)

    return run


RESULT = "id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _score(model: Model, id_kind: T.DataType):
    arrow_kind = to_arrow_type(id_kind)

    def run(key, block: pa.Table, answers: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in RESULT.split(", ")]
        kinds = [arrow_kind, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        if not block.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        block = block.to_pylist()[0]
        words, grams = _levels(block, answers.to_pylist(), model)
        sizes = _unpack(block["sizes"], np.uint32).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        columns = [
            _column_of(block["ids"]).combine_chunks(),
            np.frombuffer(block["held"], np.uint8) > 0,
            sizes,
            np.add.reduceat((words.counts > 0).astype(np.int64)[words.at], starts),
            np.add.reduceat(model.uni.base(words.counts)[words.at], starts),
            np.add.reduceat(np.log10(grams.p)[grams.at], starts),
        ]
        return pa.table([columns[0].cast(kinds[0]), *[pa.array(x, k) for x, k in zip(columns[1:], kinds[1:], strict=True)]], names=names)

    return run


def _types_by_count(tables: DataFrame, column: str) -> tuple[int, list[int]]:
    """Sum of all counts; and types by count 0 .. K + 1, then all types."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                c = _unpack(r["x"], np.int64)
                c = c[c > 0]
                n = np.bincount(np.minimum(c, K + 2), minlength=K + 3)[: K + 2].tolist() + [len(c)]
                yield pa.RecordBatch.from_arrays([pa.array([int(c.sum())]), *[pa.array([x]) for x in n]], ["total", *[f"n{i}" for i in range(K + 3)]])

    schema = ", ".join(["total bigint", *[f"n{i} bigint" for i in range(K + 3)]])
    row = tables.select(F.col(column).alias("x")).mapInArrow(run, schema).agg(*[F.sum(c) for c in ["total", *[f"n{i}" for i in range(K + 3)]]]).first()
    return int(row[0] or 0), [int(x or 0) for x in row[1:]]


def _hot_sums(grams: DataFrame) -> tuple[np.ndarray, ...]:
    """Shares of at most HOT_PARTS + 1 hot contexts, put together."""

    def shares(batches):
        for batch in batches:
            for r in batch.to_pylist():
                low = _unpack(r["c"], np.uint32).reshape(-1, K).astype(np.int64)
                own = [_unpack(r["a"], np.uint64).astype(np.int64), _unpack(r["b"], np.int64), *low.T, _unpack(r["d"], np.float64)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in own], ["v", "t", *[f"n{i}" for i in range(K)], "m"])

    schema = ", ".join(["v bigint", "t bigint", *[f"n{i} bigint" for i in range(K)], "m double"])
    share = grams.mapInArrow(shares, schema).groupBy("v").agg(*[F.sum(c).alias(c) for c in ["t", *[f"n{i}" for i in range(K)], "m"]])
    hot = sorted(share.collect(), key=lambda r: r["v"])
    return (
        np.array([r["v"] for r in hot], np.uint64), np.array([r["t"] for r in hot], np.int64),
        np.array([[r[f"n{i}"] for i in range(K)] for r in hot], np.int64).reshape(-1, K), np.array([r["m"] for r in hot], np.float64),
    )


class _Answers:
    """All levels' answers in one table, bucketed by block and added to level by level: each is dealt to its block once,
    and a block's cogroup reads them where they lie. What belongs to a part and no block has a negative block."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, work_dir(spark, "katz-answers")
        self.name = f"katz_answers_{uuid.uuid4().hex}"

    def add(self, rows: DataFrame, level: int) -> None:
        buckets = shuffle_partitions(self.spark)
        dealt = rows.withColumn("block", F.coalesce("block", -1 - F.col("part").cast("bigint"))).withColumn("level", F.lit(level))
        # One file for each bucket and level.
        writer = dealt.repartition(buckets, "block").write.option("compression", "none").option("path", self.path)
        writer.mode("append").bucketBy(buckets, "block").format("parquet").saveAsTable(self.name)

    def of_parts(self, level: int, kind: int) -> DataFrame:
        return self.spark.table(self.name).filter((F.col("level") == level) & (F.col("kind") == kind) & (F.col("block") < 0))

    def of_blocks(self) -> DataFrame:
        return self.spark.table(self.name).filter("block >= 0")

    def close(self) -> None:
        """The catalog forgets the table; its files stay."""
        self.spark.sql(f"DROP TABLE {self.name}")


def katz_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> DataFrame:
    """Per row of `docs`: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows where `held_out` is not true (null counts as not). Tokens are the words (A-Z as a-z, parted by
    white space) and an end. `score` is the log10 probability of the text by the model of `order`: P(w | the order - 1
    tokens before) is the discounted relative frequency of a seen gram, else the backoff weight of the context times P(w |
    one token less), evaluated recursively down to P(w); before a text stand starts. Unknown words are one type that takes
    the mass which discounting leaves free. For every context the probabilities of all known words, the end and the unknown
    word add up to 1. `base_score`: the add-0.5 unigram model. Null and empty texts are one end. Without
    training rows every word is unknown with probability 1. Null and repeated ids are scored like any other row.
    Other columns are not read. An empty table gives an empty one.
    """
    if order < 1:
        raise ValueError("order must be 1 or more")
    spark = docs.sparkSession
    # Bucketed by block, so that the blocks are not shuffled when answers come in.
    blocks = bucketed(_blocks(docs, held_out, id_col, text_col), "block", "katz-blocks")
    buckets = shuffle_partitions(spark)
    asked = blocks.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    parts = max(1, buckets if asked else 1, -(-asked // 8 // PART_WORDS))
    answers, kind = _Answers(spark), docs.schema[id_col].dataType
    answers.add(blocks.select("block", "words", "counts").mapInArrow(_ask_words(parts), ASK_WORDS).groupBy("part").applyInArrow(_count_words, ANSWER), 1)
    total, n = _types_by_count(answers.of_parts(1, 0), "a")
    model = Model(parts, total, Unigrams.of(total, n), order)
    for k in range(2, order + 1):
        grams = blocks.groupBy("block").cogroup(answers.of_blocks().groupBy("block")).applyInArrow(_ask_grams(model), ASK_GRAMS)
        answers.add(grams.groupBy("part").applyInArrow(_count_grams(k == order, k == 2, (model.levels or (model.uni,))[-1].d), ANSWER), k)
        level = Level(discounts(_types_by_count(answers.of_parts(k, 2), "a")[1][:-1]), _hot_sums(answers.of_parts(k, 5)))
        model = replace(model, levels=(*model.levels, level))
    scored = blocks.groupBy("block").cogroup(answers.of_blocks().groupBy("block")).applyInArrow(_score(model, kind), RESULT.format(kind=kind.simpleString()))
    answers.close()
    train = F.lit(total).cast("bigint").alias("train_tokens")
    return scored.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", train, "base_score", "score")
