"""Removal of byte strings that an earlier document holds, by sorting suffixes.

Every string of `size` bytes holds an anchor: the piece of it with the smallest hash. Equal strings have equal anchors, so
strings meet in the part their anchor's hash says. Anchors that no second document has are settled first, by hash
alone; what is left goes to the parts with the bytes around it, each distinct stretch once a block of documents. A
part sorts all suffixes of its stretches that begin a string: multikey quicksort on 8-byte characters down to a shallow
depth, then a blind trie for each group that still shares its prefix. Equal neighbours in that order are equal strings.

An anchor with many distinct stretches around it, as of a line that comes in much different text, would fill a part. The
distinct stretches of each anchor are counted with its hash; those of a hot one are cut into their strings, and each string
goes where the hash of all its bytes says.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import bucketed, plain_text, staged
from folioflow.llm.tokens import text_sizes
from folioflow.llm.words import mixed
from folioflow.session import shuffle_partitions

BLOCK_BYTES = 4 << 20
CHUNK = 1 << 19
PART_ANCHORS = 1 << 18
HOT_SHARE = 4  # an anchor is hot above a 1/HOT_SHARE of the stretches that a part holds on average
SLICES = 16  # a part's stretches are sorted in so many turns, by anchor
SHALLOW = 24  # bytes; a multiple of 8

_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(2).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOW = np.uint64((1 << 24) - 1)


def _powers(base: int) -> np.ndarray:
    out = np.full(CHUNK + 4096, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS, _BACK = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def _squeeze(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _expand(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def anchors(data: np.ndarray, ends: np.ndarray, size: int, piece: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with one anchor, in texts laid end to end: hash of the anchor, first and last start of the strings.

    A string is `size` bytes inside one text. Its anchor is the leftmost of its pieces with the smallest hash, so equal strings
    have it at the same place.
    """
    width = size - piece + 1
    last_start = np.repeat(ends, np.diff(np.concatenate([[0], ends]))) - size  # of a string in the text of each byte
    found = []
    for begin in range(0, max(len(data) - size + 1, 0), CHUNK):
        raw = data[begin : begin + CHUNK + size - 1]
        n = len(raw) - size + 1
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * _POWERS[: len(raw)], out=sums[1:])
        hashes = mixed((sums[piece:] - sums[:-piece]) * _BACK[: len(raw) - piece + 1])
        low = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
        # Minimum of `width` neighbours, by doubling.
        have = 1
        while have < width:
            step = min(have, width - have)
            low = np.minimum(low[: len(low) - step], low[step:])
            have += step
        at = (low[:n] & _LOW).astype(np.int64)
        start = np.arange(begin, begin + n)
        valid = start <= last_start[begin : begin + n]
        at, start = at[valid], start[valid]
        if len(at):
            new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            # Anchors are small hashes: stirred again, they fill the parts evenly.
            found.append((mixed(~hashes[at[new]]), start[new], start[np.concatenate([new[1:] - 1, [len(start) - 1]])]))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# ---- deep-shallow sorting


def shallow_groups(text: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort by 8-byte characters: the order of `starts` by their first `depth` bytes, and the number of the
    group of equal ones at each place. Each pass sorts the open groups, those of more than one suffix, by their next character."""
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)
    end = len(text) - 1
    for at in range(0, depth, 8):
        size = np.bincount(group)
        places = np.flatnonzero(size[group] > 1)
        if not len(places):
            break
        own = starts[order[places]] + at
        character = np.zeros(len(own), np.uint64)
        for k in range(8):
            place = own + k
            character = (character << np.uint64(8)) | np.where(place <= end, text[np.minimum(place, end)], 0).astype(np.uint64)
        by = np.lexsort((character, group[places]))
        order[places] = order[places][by]
        after = character[by]
        new = np.zeros(len(starts), bool)
        new[places[1:]] = (after[1:] != after[:-1]) & (group[places[1:]] == group[places[:-1]])
        new[1:] |= group[1:] != group[:-1]
        group = np.cumsum(new)
    return order, group


class BlindTrie:
    """Strings of one length in a trie that keeps only the places where they branch: descend blindly, compare with the
    string found there once, branch where they first differ."""

    def __init__(self, first: bytes, name: int):
        self.root: list | tuple = (first, [name])  # leaf: (string, names); branch: [place, {byte: node}]

    def add(self, string: bytes, name: int) -> None:
        node = self.root
        while type(node) is list:
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        if node[0] == string:
            node[1].append(name)
            return
        other = node[0]
        low, high = 0, len(string)
        while high - low > 1:
            middle = (low + high) // 2
            if string[low:middle] == other[low:middle]:
                low = middle
            else:
                high = middle
        leaf = (string, [name])
        above, node = None, self.root
        while type(node) is list and node[0] < low:
            above, node = node, node[1][string[node[0]]]
        if type(node) is list and node[0] == low:
            node[1][string[low]] = leaf
            return
        branch = [low, {other[low]: node, string[low]: leaf}]
        if above is None:
            self.root = branch
        else:
            above[1][string[above[0]]] = branch

    def in_order(self):
        """Lists of names of equal strings, in the order of the strings."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if type(node) is list:
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
            else:
                yield node[1]


def sorted_classes(text: bytes, starts: np.ndarray, size: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at `starts` in the order of their first `size` bytes, and the number of equal ones' class at each place."""
    data = np.frombuffer(text, np.uint8)
    shallow = min(shallow, size // 8 * 8)
    order, group = shallow_groups(data, starts, shallow)
    if not len(starts):
        return order, group
    borders = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    new = np.zeros(len(starts), bool)
    new[borders[:-1]] = True
    for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        if b - a < 2:
            continue
        own = order[a:b].tolist()
        at = starts[own].tolist()
        trie = BlindTrie(text[at[0] + shallow : at[0] + size], own[0])
        for name, s in zip(own[1:], at[1:], strict=True):
            trie.add(text[s + shallow : s + size], name)
        place = a
        for names in trie.in_order():
            new[place] = True
            order[place : place + len(names)] = names
            place += len(names)
    return order, np.cumsum(new) - 1


# ---- blocks of documents and parts of anchors


BLOCK = "block bigint, ids binary, nulls binary, sizes binary, bytes binary"


def _blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def flush():
            nonlocal ids, texts, size, n
            nulls = np.array([i is None for i in ids], np.uint8)
            out = pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + n])]
                + [
                    pa.array([x], pa.binary())
                    for x in (np.array([0 if i is None else i for i in ids], np.int64).tobytes(), nulls.tobytes(), np.array([len(t) for t in texts], np.int64).tobytes(), _squeeze(b"".join(texts)))
                ],
                [c.split()[0] for c in BLOCK.split(", ")],
            )
            ids, texts, size, n = [], [], 0, n + 1
            return out

        for batch in batches:
            sizes = text_sizes(batch.column(1))
            own = batch.column(0).to_pylist()
            raw = batch.column(1).cast(pa.binary())
            for i, length in enumerate(sizes.tolist()):
                if size and size + length > BLOCK_BYTES:
                    yield flush()
                ids.append(own[i])
                texts.append(raw[i].as_py())
                size += length
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), plain_text(text_col).alias("text"))
    return rows.mapInArrow(run, BLOCK)


class _Block:
    def __init__(self, row: dict, size: int, piece: int):
        self.name = row["block"]
        self.ids, self.nulls = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["nulls"], np.uint8) > 0
        self.raw = _expand(row["bytes"])
        self.ends = np.cumsum(np.frombuffer(row["sizes"], np.int64))
        # A null id comes after all others; rows of one id take nothing from one another.
        self.key = np.where(self.nulls, np.iinfo(np.int64).max, self.ids)
        self.hash, self.first, self.last = anchors(np.frombuffer(self.raw, np.uint8), self.ends, size, piece)
        self.of = self.key[np.searchsorted(self.ends, self.first, "right")]

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes, where each anchor's is among them, and whether documents of two keys have it."""
        hashes, where = np.unique(self.hash, return_inverse=True)
        low = np.full(len(hashes), np.iinfo(np.int64).max)
        high = np.full(len(hashes), np.iinfo(np.int64).min)
        np.minimum.at(low, where, self.of)
        np.maximum.at(high, where, self.of)
        return hashes, where, low < high

    def times(self, hashes: np.ndarray, where: np.ndarray, size: int) -> np.ndarray:
        """How many distinct stretches each anchor has here."""
        times = np.bincount(where, minlength=len(hashes))
        runs = np.flatnonzero(times[where] > 1)
        raw = self.raw
        # Equal stretches have one anchor.
        anchor = {raw[a : b + size]: h for a, b, h in zip(self.first[runs].tolist(), self.last[runs].tolist(), where[runs].tolist(), strict=True)}
        own = np.bincount(np.fromiter(anchor.values(), np.int64, len(anchor)), minlength=len(hashes))
        return np.where(times > 1, own, times)

    def stretches(self, shared: np.ndarray, hot: np.ndarray, where: np.ndarray, size: int) -> _Stretches:
        runs = np.flatnonzero(shared[where]) if len(where) else np.zeros(0, np.int64)
        split = hot[where[runs]] if len(runs) else np.zeros(0, bool)
        runs, cut = runs[~split], runs[split]
        # Each string of a hot anchor is a stretch of its own.
        n = (self.last - self.first)[cut] + 1
        starts = np.repeat(self.first[cut], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        first, last = np.concatenate([self.first[runs], starts]), np.concatenate([self.last[runs], starts])
        of = np.concatenate([self.of[runs], np.repeat(self.of[cut], n)])
        index: dict[bytes, int] = {}
        raw = self.raw
        which = np.array([index.setdefault(raw[a : b + size], len(index)) for a, b in zip(first.tolist(), last.tolist(), strict=True)], np.int64)
        key = np.full(len(index), np.iinfo(np.int64).max)
        np.minimum.at(key, which, of)
        hashes = np.zeros(len(index), np.uint64)
        hashes[which[: len(runs)]] = self.hash[runs]
        texts = list(index)
        plain = int(which[: len(runs)].max()) + 1 if len(runs) else 0
        hashes[plain:] = whole_hashes(texts[plain:], size)
        return _Stretches(first, last, of, texts, key, hashes, which)


@dataclass
class _Stretches:
    """Runs with a shared anchor: first and last start, key; their distinct bytes, the smallest key and the hash of each; which run has which."""

    first: np.ndarray
    last: np.ndarray
    of: np.ndarray
    texts: list[bytes]
    key: np.ndarray
    hashes: np.ndarray
    which: np.ndarray


def whole_hashes(strings: list[bytes], size: int) -> np.ndarray:
    """Hashes of strings of `size` bytes."""
    out = np.zeros(len(strings), np.uint64)
    for a in range(0, len(strings), 1 << 14):
        own = strings[a : a + (1 << 14)]
        data = np.frombuffer(b"".join(own), np.uint8).reshape(-1, size)
        out[a : a + len(own)] = mixed(~mixed((_BYTE[data] * _POWERS[:size]).sum(1, dtype=np.uint64)))
    return out


def _edges(hashes: np.ndarray, parts: int) -> np.ndarray:
    starts = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, starts), [len(hashes)]]).astype(np.int64)


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    starts = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)
    return np.searchsorted(starts, hashes, "right")


ASK = "part int, block bigint, a binary, b binary, c binary"
_ASK = ["part", "block", "a", "b", "c"]


def _table(rows: list[list]) -> pa.Table:
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=_ASK)


def _ask_hashes(size: int, piece: int, parts: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own = _Block(row, size, piece)
                hashes, where, several = own.distinct()
                times = own.times(hashes, where, size).astype(np.uint32)
                at = _edges(hashes, parts)
                # Within a part 32 bits will do: two anchors that fall together are told apart by their bytes later.
                short = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                rows = [[p, row["block"], short[at[p] : at[p + 1]].tobytes(), np.packbits(several[at[p] : at[p + 1]]).tobytes(), _squeeze(times[at[p] : at[p + 1]].tobytes())] for p in range(parts) if at[p] < at[p + 1]]
                yield from _table(rows).to_batches()

    return run


def _shared_hashes(most: int):
    def run(asked: pa.Table) -> pa.Table:
        """For each block, a bit for each of its hashes: whether documents of two keys, or two blocks, have it; and another:
        whether it has more than `most` stretches. Also the number of hashes, and of the block's stretches of hot ones."""
        rows = asked.to_pylist()
        own = [np.frombuffer(r["a"], np.uint32) for r in rows]
        hashes, where, blocks = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        several = np.concatenate([np.unpackbits(np.frombuffer(r["b"], np.uint8), count=len(x)) for r, x in zip(rows, own, strict=True)])
        times = np.concatenate([np.frombuffer(_expand(r["c"]), np.uint32) for r in rows])
        shared = (blocks > 1) | (np.bincount(where, several, len(hashes)) > 0)
        hot = shared & (np.bincount(where, times, len(hashes)) > most)
        at, out = 0, []
        for r, x in zip(rows, own, strict=True):
            mine = where[at : at + len(x)]
            n_hot = int(times[at : at + len(x)][hot[mine]].sum())
            at += len(x)
            sizes = len(x).to_bytes(8, "little") + n_hot.to_bytes(8, "little")
            out.append([r["part"], r["block"], np.packbits(shared[mine]).tobytes(), sizes, np.packbits(hot[mine]).tobytes() if n_hot else None])
        return _table(out)

    return run


def _shared(answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """For each hash of a block, whether it is shared and whether it is hot."""
    own = sorted(answers, key=lambda r: r["part"])
    n = [int.from_bytes(r["b"][:8], "little") for r in own]
    bits = [np.unpackbits(np.frombuffer(r["a"], np.uint8), count=k) for r, k in zip(own, n, strict=True)]
    hot = [np.unpackbits(np.frombuffer(r["c"], np.uint8), count=k) if r["c"] else np.zeros(k, np.uint8) for r, k in zip(own, n, strict=True)]
    return tuple(np.concatenate(x).astype(bool) if x else np.zeros(0, bool) for x in (bits, hot))


def _hot_stretches(shared: DataFrame) -> int:
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(int.from_bytes(b[8:], "little") for b in batch.column(0).to_pylist())], pa.int64())], ["n"])

    return shared.select("b").mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0


def _ask_stretches(size: int, piece: int, parts: int):
    def run(key, block: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        for row in block.to_pylist():
            own = _Block(row, size, piece)
            _, where, _ = own.distinct()
            got = own.stretches(*_shared(answers.to_pylist()), where, size)
            texts, keys, hashes = got.texts, got.key, got.hashes
            dealt = _part_of(hashes, parts)
            order = np.argsort(dealt, kind="stable")
            at = np.searchsorted(dealt[order], np.arange(parts + 1))
            for p in range(parts):
                i = order[at[p] : at[p + 1]]
                if len(i):
                    mine = [texts[k] for k in i.tolist()]
                    turn = ((hashes[i] >> np.uint64(8)) % np.uint64(SLICES)).astype(np.uint8)
                    lengths = np.array([len(t) for t in mine], np.uint16)
                    rows.append([p, row["block"], _squeeze(b"".join(mine)), lengths.tobytes() + turn.tobytes(), _squeeze(keys[i].tobytes())])
        return _table(rows)

    return run


def _judge(size: int):
    def run(asked: pa.Table) -> pa.Table:
        """For each stretch, a bit for each of its strings: whether a document with a smaller key has that string."""
        rows = asked.to_pylist()
        lengths = [np.frombuffer(r["b"][: len(r["b"]) // 3 * 2], np.uint16).astype(np.int64) for r in rows]
        turns = np.concatenate([np.frombuffer(r["b"][len(r["b"]) // 3 * 2 :], np.uint8) for r in rows])
        keys = [np.frombuffer(_expand(r["c"]), np.int64) for r in rows]
        # Equal stretches of several blocks are one, with the smallest key.
        index: dict[bytes, int] = {}
        which = []
        for r, n in zip(rows, lengths, strict=True):
            text, ends = _expand(r["a"]), np.cumsum(n).tolist()
            which.append(np.array([index.setdefault(text[a:b], len(index)) for a, b in zip([0, *ends[:-1]], ends, strict=True)], np.int64))
        key = np.full(len(index), np.iinfo(np.int64).max)
        np.minimum.at(key, np.concatenate(which), np.concatenate(keys))
        text = b"".join(index)
        size_of = np.array([len(t) for t in index], np.int64)
        begin = np.cumsum(size_of) - size_of
        strings = size_of - size + 1
        first = np.cumsum(strings) - strings
        smallest = np.empty(int(strings.sum()), np.int64)
        turn = np.zeros(len(index), np.uint8)
        turn[np.concatenate(which)] = turns
        # Equal strings have one anchor, hot or not, so they meet in one turn.
        for k in range(SLICES):
            own = np.flatnonzero(turn == k)
            if not len(own):
                continue
            owner = np.repeat(own, strings[own])
            offset = np.arange(len(owner)) - np.repeat(np.cumsum(strings[own]) - strings[own], strings[own])
            order, group = sorted_classes(text, begin[owner] + offset, size)
            least = np.minimum.reduceat(key[owner[order]], np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])))
            smallest[(first[owner] + offset)[order]] = least[group]
        out = []
        for r, w, k in zip(rows, which, keys, strict=True):
            n = strings[w]
            mine = np.repeat(first[w] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            out.append([r["part"], r["block"], _squeeze(np.packbits(smallest[mine] < np.repeat(k, n)).tobytes()), int(n.sum()).to_bytes(8, "little"), None])
        return _table(out)

    return run


RESULT = "id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def _remove(size: int, piece: int, parts: int):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(key, block: pa.Table, answers: pa.Table) -> pa.Table:
        kinds = [pa.int64(), pa.int64(), spans_type, pa.binary()]
        names = ["id", "n_bytes", "spans", "kept"]
        rows = block.to_pylist()
        if not rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        own, answers = _Block(rows[0], size, piece), answers.to_pylist()
        _, where, _ = own.distinct()
        got = own.stretches(*_shared([a for a in answers if a["judged"] == 0]), where, size)
        keys, hashes, which = got.key, got.hashes, got.which
        raw = np.frombuffer(own.raw, np.uint8)
        change = np.zeros(len(raw) + 1, np.int32)
        if len(which):
            strings = got.last - got.first + 1
            judged = [a for a in answers if a["judged"] == 1]
            bits = {a["part"]: np.unpackbits(np.frombuffer(_expand(a["a"]), np.uint8), count=int.from_bytes(a["b"], "little")) for a in judged}
            every = np.concatenate([bits[p] for p in sorted(bits)]).astype(bool)
            # Where the bits of each distinct stretch begin: parts in order, stretches of a part in order.
            order = np.argsort(_part_of(hashes, parts), kind="stable")
            n = np.zeros(len(keys), np.int64)
            n[which] = strings
            begin = np.zeros(len(keys), np.int64)
            begin[order] = np.cumsum(n[order]) - n[order]
            total = int(strings.sum())
            step = np.arange(total) - np.repeat(np.cumsum(strings) - strings, strings)
            start = np.repeat(got.first, strings) + step
            # Of equal stretches in a block, those of a larger key than the smallest go whole.
            gone = every[np.repeat(begin[which], strings) + step] | np.repeat(got.of > keys[which], strings)
            np.add.at(change, start[gone], 1)
            np.add.at(change, start[gone] + size, -1)
        removed = np.cumsum(change[:-1]) > 0
        spans, kept = [], []
        for a, b in zip(np.concatenate([[0], own.ends[:-1]]).tolist(), own.ends.tolist(), strict=True):
            mask = removed[a:b]
            if mask.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))).tolist()
                spans.append([{"start": x, "end": y} for x, y in zip(edge[::2], edge[1::2], strict=True)])
                kept.append(raw[a:b][~mask].tobytes())
            else:
                spans.append([])
                kept.append(own.raw[a:b])
        sizes = np.diff(np.concatenate([[0], own.ends]))
        return pa.table([pa.array(own.ids, mask=own.nulls), pa.array(sizes), pa.array(spans, spans_type), pa.array(kept, pa.binary())], names=names)

    return run


def without_repeats(docs: DataFrame, size: int = 50, piece: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id, n_bytes, `spans` (maximal removed runs, byte offsets) and `kept` (the other bytes joined).

    A byte of a text's UTF-8 goes if a string of `size` bytes that covers it also starts in a text with a smaller id;
    strings are judged on the input, and never cross texts. Texts shorter than `size` stay whole; null text counts as
    empty. A null id comes after all others; rows with one id take nothing from one another. Other columns are not read.
    An empty table gives an empty one. Texts are kept once, in blocks, and never shuffled.
    """
    spark = docs.sparkSession
    blocks = bucketed(_blocks(docs, id_col, text_col), "block", "repeat-blocks")
    parts = shuffle_partitions(spark)
    # About one anchor in half of size - piece bytes.
    n_bytes = docs.select(F.sum(F.octet_length(plain_text(text_col)))).first()[0] or 0
    n_anchors = 2 * n_bytes // (size - piece)
    parts = max(parts, -(-n_anchors // PART_ANCHORS))
    asked = blocks.mapInArrow(_ask_hashes(size, piece, parts), ASK)
    most = max(1, n_anchors // parts // HOT_SHARE)
    shared = staged(asked.groupBy("part").applyInArrow(_shared_hashes(most), ASK), "repeat-anchors")
    # A stretch has about half of size - piece strings, one of a hot anchor at most size - piece + 1.
    n_strings = _hot_stretches(shared) * (size - piece + 1)
    dealt = parts + -(-2 * n_strings // (size - piece) // PART_ANCHORS)
    stretches = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_ask_stretches(size, piece, dealt), ASK)
    judged = staged(stretches.groupBy("part").applyInArrow(_judge(size), ASK), "repeat-judged")
    answers = shared.withColumn("judged", F.lit(0)).unionByName(judged.withColumn("judged", F.lit(1)))
    out = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_remove(size, piece, dealt), RESULT)
    return out.withColumnRenamed("id", id_col)
