"""Benchmark decontamination by a generalised suffix automaton of the test items' words.

Automatons are built in tasks, over blocks of items of a bounded number of words, and stored in the shared folder; one at a
time goes to the tasks. Documents are streamed through it word by word; at each word the state tells the longest stretch
of words, ending there, that some item holds. With several blocks the documents pass once for each, and every pass is
written before the next.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.common import plain_text, staged
from folioflow.llm.tokens import by_bytes, text_sizes

WINDOW = 10
# A block of items is what a task builds and what is sent to the tasks at once: its words, and so the automaton, are bounded.
BLOCK_WORDS = 200_000

# Words are runs of a-z, 0-9 and of all characters beyond ASCII; A-Z is lower-cased, everything else parts words.
_WORD_BYTES = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class Automaton:
    """Suffix automaton of several word sequences, with the items whose windows end in each state.

    A window is `window` consecutive words of an item; an item of fewer words, but not none, is one window.
    """

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, item in items:
            last = 0
            for word in item:
                last = self._extend(last, word)
        #: state -> (length of the window, items that hold it)
        own: dict[int, tuple[int, set]] = {}
        for name, item in items:
            state = 0
            short = len(item) < window
            for i, word in enumerate(item):
                state = self.next[state][word]
                # Each state of a prefix is shortened to the one that holds the last `window` words.
                while not short and self.length[self.link[state]] >= window:
                    state = self.link[state]
                if i + 1 >= window or short and i + 1 == len(item):
                    own.setdefault(state, (min(i + 1, window), set()))[1].add(name)
        self.windows = own
        #: state -> windows on its chain of suffix links, longest first
        self.ends: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            here = ((own[state][0], state),) if state in own else ()
            self.ends[state] = here + self.ends[self.link[state]]

    def _extend(self, last: int, word: bytes) -> int:
        after, link, length = self.next, self.link, self.length
        if word in after[last]:
            old = after[last][word]
            return old if length[old] == length[last] + 1 else self._split(last, word, old)
        new = len(after)
        after.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and word not in after[state]:
            after[state][word] = new
            state = link[state]
        if state >= 0:
            old = after[state][word]
            link[new] = old if length[old] == length[state] + 1 else self._split(state, word, old)
        return new

    def _split(self, state: int, word: bytes, old: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[old]))
        self.length.append(self.length[state] + 1)
        self.link.append(self.link[old])
        self.link[old] = copy
        while state >= 0 and self.next[state].get(word) == old:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def match(self, text: list[bytes]) -> tuple[list[list[int]], set]:
        """Maximal runs [first word, end) covered by windows, and the items whose windows occur."""
        after, link, length, ends = self.next, self.link, self.length, self.ends
        spans: list[list[int]] = []
        found: set[int] = set()
        state = matched = 0
        for i, word in enumerate(text):
            to = after[state].get(word)
            if to is None:
                while to is None and state:
                    state = link[state]
                    to = after[state].get(word)
                if to is None:
                    matched = 0
                    continue
                matched = length[state]
            state = to
            matched += 1
            if ends[state]:
                for size, window_state in ends[state]:
                    if size <= matched:
                        found.add(window_state)
                        begin = i + 1 - size
                        while spans and spans[-1][1] >= begin:
                            begin = min(begin, spans.pop()[0])
                        spans.append([begin, i + 1])
        items = set().union(*(self.windows[s][1] for s in found)) if found else set()
        return spans, items


def automatons(items: DataFrame, window: int, id_col: str, text_col: str, block_words: int) -> tuple[DataFrame, int]:
    """Staged rows (block, blob): automatons of about `block_words` words of items each, and their number."""
    text = plain_text(text_col)
    own = items.select(F.col(id_col).cast("string").alias("item"), text.alias("text"), (F.length(text) / 2 + 1).cast("bigint").alias("size"))
    rows = staged(own.filter("text <> ''").distinct(), "items")
    # Upper bounds of words by hashed part, at most PARTS numbers; neighbouring parts are joined up to blocks.
    part = F.pmod(F.xxhash64("item", "text"), F.lit(PARTS))
    sums = {int(r["part"]): int(r["size"]) for r in rows.groupBy(part.alias("part")).agg(F.sum("size").alias("size")).collect()}
    starts, total = [0], 0
    for k, n in sorted(sums.items()):
        if total and total + n > block_words:
            starts.append(k)
            total = 0
        total += n

    def build(group: pa.Table) -> pa.Table:
        named = zip(group.column("item").to_pylist(), group.column("text").to_pylist(), strict=True)
        blob = pickle.dumps(Automaton([(item, words(text)) for item, text in named], window), protocol=5)
        return pa.table({"block": group.column("block")[:1], "blob": pa.array([blob], pa.binary())})

    block = F.size(F.filter(F.array(*map(F.lit, starts)), lambda x: x <= part)) - 1
    built = rows.select("item", "text", block.alias("block")).groupBy("block").applyInArrow(build, "block int, blob binary")
    return staged(built, "automatons"), len(starts)


PARTS = 4096

# The automaton that this worker last used, by the name of its blob.
_held: dict[str, Automaton] = {}


def _loaded(name: str, blob: bytes) -> Automaton:
    if name not in _held:
        _held.clear()
        _held[name] = pickle.loads(blob)
    return _held[name]


def _sent(blobs: DataFrame, block: int, window: int):
    """Broadcast of one stored automaton, and a function that tasks get it by."""
    row = blobs.filter(F.col("block") == block).first()
    blob = bytes(row["blob"]) if row else pickle.dumps(Automaton([], window), protocol=5)
    sent, name = blobs.sparkSession.sparkContext.broadcast(blob), uuid.uuid4().hex
    return sent, lambda: _loaded(name, sent.value)


HITS = "id {kind}, row bigint, n_words bigint, spans array<struct<first:int,end:int>>, items array<string>, unnamed boolean"


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of `docs`: id, row, n_words, `spans` (maximal runs of hit words, end exclusive), `items` (ids as strings) and
    `unnamed` (whether a window of an item without id occurs).

    A document word is hit if it lies in an occurrence of a window of an item. Null texts and items have no words; items
    with a null id hit words but are not among `items`, and count as one item together. Repeated item ids count as one item. Empty tables give no hits, or no rows. Documents pass
    once for every block of items; benchmarks below `block_words` words are one block.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), plain_text(text_col).alias("text"))
    blobs, blocks = automatons(items, window, item_id, item_text, block_words)
    if blocks > 1:
        rows = staged(rows, "decontaminate-rows")

    def found_by(automaton_of: Callable[[], Automaton]):
        def run(batches):
            automaton = automaton_of()
            for batch in batches:
                n_words, spans, found, unnamed = [], [], [], []
                for text in batch.column(2):
                    own = words(text.as_py())
                    runs, names = automaton.match(own)
                    n_words.append(len(own))
                    spans.append([{"first": a, "end": b} for a, b in runs])
                    unnamed.append(None in names)
                    found.append(sorted(names - {None}))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))), pa.array(found, pa.list_(pa.string())), pa.array(unnamed, pa.bool_())],
                    ["id", "row", "n_words", "spans", "items", "unnamed"],
                )

        return run

    passes = []
    for block in range(blocks):
        sent, automaton_of = _sent(blobs, block, window)
        own = rows.mapInArrow(found_by(automaton_of), HITS.format(kind=kind))
        if blocks == 1:
            return own
        passes.append(staged(own, "decontaminate-hits"))
        sent.destroy()
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    # Each block finds its own runs; overlapping and touching ones are joined.
    ordered = F.array_sort(F.flatten(F.collect_list("spans")))
    merged = F.aggregate(
        ordered,
        F.array().cast("array<struct<first:int,end:int>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["first"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["first"].alias("first"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(x))),
    )
    return every.groupBy("id", "row", "n_words").agg(merged.alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.max("unnamed").alias("unnamed"))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """`text` without the given runs of words; what stood between two words of a run goes with them."""
    raw = text.encode("utf-8", "surrogatepass")
    flat = raw.translate(_WORD_BYTES)
    out, at, k, position = [], 0, 0, 0
    for first, end in spans:
        begin = None
        while k < end:
            while flat[position] == 0x20:
                position += 1
            if k == first:
                begin = position
            stop = flat.find(b" ", position)
            position = len(flat) if stop < 0 else stop
            k += 1
        out.append(raw[at:begin])
        at = position
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of `docs` without contamination: runs of hit words are cut out of the text; a document of which more than
    `max_coverage` of the words is hit goes altogether. All columns stay, `n_chars`, if there, follows the new text.

    Cutting can join two halves of a window, so a text is cut until no window occurs. Null texts stay null. Items with a
    null id count like others. What is cut does not depend on the number of blocks.
    """
    blobs, blocks = automatons(items, window, item_id, item_text, block_words)
    at, width = docs.columns.index(text_col), len(docs.columns)
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def with_texts(batch: pa.RecordBatch, old: list, new: list) -> list:
        """The columns of docs with the new texts and their lengths."""
        columns = list(batch.columns)[: width]
        columns[at] = pa.array(new, batch.schema.field(at).type)
        if chars is not None:
            lengths = [c if a == b else len(b or "") for a, b, c in zip(old, new, batch.column(chars).to_pylist(), strict=True)]
            columns[chars] = pa.array(lengths, batch.schema.field(chars).type)
        return columns

    if blocks == 1:
        _, automaton_of = _sent(blobs, 0, window)

        def clean(text: str, automaton: Automaton) -> str | None:
            total, lost = len(words(text)), 0
            while spans := automaton.match(words(text))[0]:
                lost += sum(b - a for a, b in spans)
                if lost > max_coverage * total:
                    return None
                text = without_spans(text, spans)
            return text

        def run(batches):
            automaton = automaton_of()
            for whole in batches:
                for lo, hi in by_bytes(text_sizes(whole.column(at).fill_null(""))):
                    batch = whole.slice(lo, hi - lo)
                    old = batch.column(at).to_pylist()
                    new = [clean(t, automaton) if t else t for t in old]
                    keep = pa.array([a is None or b is not None for a, b in zip(old, new, strict=True)], pa.bool_())
                    yield pa.RecordBatch.from_arrays(with_texts(batch, old, new), schema=batch.schema).filter(keep)

        return docs.mapInArrow(run, docs.schema)

    state = next(name for k in range(width + 1) if (name := f"_cut{k}") not in docs.columns)
    kind = "spans array<struct<first:int,end:int>>, total bigint, lost bigint, again boolean, gone boolean"
    schema = T.StructType([*docs.schema.fields, T.StructField(state, T.StructType.fromDDL(kind))])
    start = F.struct(F.array().cast("array<struct<first:int,end:int>>").alias("spans"), F.lit(-1).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("lost"), F.lit(False).alias("again"), F.lit(False).alias("gone"))

    def marked_by(automaton_of: Callable[[], Automaton]):
        def run(batches):
            automaton = automaton_of()
            for batch in batches:
                states = batch.column(width).to_pylist()
                for text, own in zip(batch.column(at).to_pylist(), states, strict=True):
                    if text:
                        split = words(text)
                        own["total"] = len(split) if own["total"] < 0 else own["total"]
                        own["spans"] += [{"first": a, "end": b} for a, b in automaton.match(split)[0]]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(states, batch.schema.field(width).type)], schema=batch.schema)

        return run

    def cut(batches):
        for batch in batches:
            old, new = batch.column(at).to_pylist(), []
            states = batch.column(width).to_pylist()
            for text, own in zip(old, states, strict=True):
                spans = joined([(x["first"], x["end"]) for x in own["spans"]])
                own["spans"], own["again"] = [], bool(spans)
                own["lost"] += sum(b - a for a, b in spans)
                own["gone"] = own["lost"] > max_coverage * max(own["total"], 0)
                new.append(without_spans(text, spans) if spans and not own["gone"] else text)
            yield pa.RecordBatch.from_arrays([*with_texts(batch, old, new), pa.array(states, batch.schema.field(width).type)], schema=batch.schema)

    pending, done = docs.withColumn(state, start), None
    while True:
        for block in range(blocks):
            sent, automaton_of = _sent(blobs, block, window)
            pending = staged(pending.mapInArrow(marked_by(automaton_of), schema), "decontaminate-marks")
            sent.destroy()
        pending = staged(pending.mapInArrow(cut, schema), "decontaminate-cut")
        kept = pending.filter(~F.col(f"{state}.again")).drop(state)
        done = kept if done is None else done.unionByName(kept)
        # Few texts are cut again: only those pass once more.
        pending = pending.filter(F.col(f"{state}.again") & ~F.col(f"{state}.gone"))
        if pending.isEmpty():
            return done


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching runs put together, in order."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and out[-1][1] >= first:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out
