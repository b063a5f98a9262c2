"""Token counts and ids of whole texts, by the tokenizers and sentencepiece libraries.

A byte-level BPE file treats each of its words on its own, so every word boundary is a safe one. A batch of texts is
cut there, and the library encodes in batches the pieces that this worker has not seen yet. Texts with characters
outside a plain range, or with a special token's string, go to the library in longer stretches cut at white space.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import plain_text

BATCH_BYTES = 1 << 20
STRETCH = 1 << 16
ROW_PIECES = 100  # words that the library encodes as one text
CACHE_PIECES = 300_000  # of a worker, about 250 bytes each; workers stay, and with them their pieces

# The splitting rule of the byte-level file, spelled out for plain characters; the commonest kind comes first.
LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
PIECES = re.compile(
    rf" ?[{LETTER}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^ \t\n\r{LETTER}0-9]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+"
)
NOT_PLAIN = re.compile("[^\t\n\r\x20-\x7e¡-©«-¬®-±´¶-¸»¿-ɏ‐-‧‰-⁞]")
LETTERS = re.compile(rf" [{LETTER}]+")
SPACE_AFTER_WORD = re.compile("(?<=[!-~À-ɏ])[ \t\n\r]")


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """Cut a text into parts of about `size` characters; a cut stands before white space that follows a word."""
    start = 0
    while len(text) - start > size:
        cut = SPACE_AFTER_WORD.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


class Encoder:
    """Ids as little-endian 32-bit bytes, or lengths only, of a text by a tokenizers .json file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else re.compile("(?!)")
        self.by_word = self._splits_like_pieces()
        vocab = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.spaced[[i for token, i in vocab.items() if token.startswith("Ġ")]] = True  # a space, as byte-level files write it
        self.ids: dict[str, bytes] = {}
        self.lengths: dict[str, int] = {}

    def _splits_like_pieces(self) -> bool:
        import json

        spec = json.loads(self.tokenizer.to_str())
        rule = spec.get("pre_tokenizer") or {}
        return spec.get("normalizer") is None and rule.get("type") == "ByteLevel" and rule.get("use_regex", True) and not rule.get("add_prefix_space")

    def encode(self, texts: list[str]):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _parts(self, text: str) -> list[str]:
        if not self.by_word:
            return [text]
        found = []
        for part in stretches(text):
            if NOT_PLAIN.search(part) or self.special.search(part):
                found.append(part)
            else:
                found += PIECES.findall(part)
        return found

    def _encoded_rows(self, words: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """Words of a space and letters, the ids of some of them in a row, and where each word's ids begin and end.

        A space after a letter begins a new word, so words side by side are encoded as each on its own, and each one's
        first id is the only one that begins with a space.
        """
        rows = [words[i : i + ROW_PIECES] for i in range(0, len(words), ROW_PIECES)]
        texts = list(map("".join, rows))
        for row, text, e in zip(rows, texts, self.encode(texts), strict=True):
            ids = np.array(e.ids, "<u4")
            at = np.flatnonzero(self.spaced[ids])
            if len(at) == len(row) and not self.special.search(text):
                yield row, ids, np.append(at, len(ids))
            else:
                alone = [np.array(x.ids, "<u4") for x in self.encode(row)]
                yield row, np.concatenate(alone), np.cumsum([0, *map(len, alone)])

    def _learn(self, pieces: set[str], known: dict, measure, measure_row) -> None:
        """`measure` is of a piece's encoding; `measure_row` of many pieces' ids in a row, and where each begins and ends."""
        if len(known) > CACHE_PIECES:
            # What the texts at hand use, frequent pieces among it, is not encoded again.
            used = {p: known[p] for p in pieces if p in known}
            known.clear()
            known.update(used)
        missing = list(pieces.difference(known))
        words = list(filter(LETTERS.fullmatch, missing)) if self.by_word else []
        missing = list(set(missing).difference(words)) if words else missing
        for i in range(0, len(words), 20_000):
            for row, ids, at in self._encoded_rows(words[i : i + 20_000]):
                known.update(zip(row, measure_row(ids, at), strict=True))
        for i in range(0, len(missing), 20_000):
            part = missing[i : i + 20_000]
            known.update(zip(part, map(measure, self.encode(part)), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        parts = [self._parts(t) for t in texts]
        self._learn(set().union(*parts), self.lengths, len, lambda ids, at: np.diff(at).tolist())
        of = self.lengths.__getitem__
        return [sum(map(of, p)) for p in parts]

    def encoded(self, texts: list[str]) -> list[bytes]:
        parts = [self._parts(t) for t in texts]
        self._learn(set().union(*parts), self.ids, lambda e: np.array(e.ids, "<u4").tobytes(), _slices)
        of = self.ids.__getitem__
        return [b"".join(map(of, p)) for p in parts]


def _slices(ids: np.ndarray, at: np.ndarray) -> list[bytes]:
    raw, at = ids.tobytes(), (4 * at).tolist()
    return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


class PieceModel:
    """Lengths by a sentencepiece .model file, whose pieces cross spaces: whole texts."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.processor.encode(texts, num_threads=1)]

    def encoded(self, texts: list[str]) -> list[bytes]:
        return [np.array(x, "<u4").tobytes() for x in self.processor.encode(texts, num_threads=1)]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder | PieceModel:
    """One per worker process."""
    return PieceModel(path) if path.endswith(".model") else Encoder(path)


def by_bytes(sizes: np.ndarray, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about `limit` bytes each; a larger row is a range of its own."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield start, end
        start = end


def text_sizes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Per row of `docs`: the id, `n_bytes` (UTF-8), `n_tokens`, `over_limit`.

    Null text counts as empty: no bytes, no tokens. Ids are passed on as they are, null and repeated ones too; an empty
    table gives an empty one. Other columns are not read. Only lengths leave the worker. No shuffle.
    """

    def run(batches):
        encode = encoder(tokenizer_path)
        for batch in batches:
            sizes = text_sizes(batch.column(1))
            counts = np.zeros(len(sizes), np.int64)
            for lo, hi in by_bytes(sizes, batch_bytes):
                counts[lo:hi] = encode.count(batch.column(1).slice(lo, hi - lo).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(counts)], ["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), plain_text(text_col).alias("text"))
    counted = rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
