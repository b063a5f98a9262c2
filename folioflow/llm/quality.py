"""Quality classifier by positive-unlabelled learning.

A linear model over the style of a text is fitted by minimising the non-negative unbiased risk: trusted positives stand
for the one class, unlabelled text for the mixture, and an estimated class prior ties the two. Fitting uses bounded
samples; scoring covers whole texts of all rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import plain_text
from folioflow.llm.tokens import stretches

# Character classes: 0 other mark, 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 part of a character beyond ASCII.
_CLASS = np.zeros(256, np.int64)
_CLASS[ord("a") : ord("z") + 1], _CLASS[ord("A") : ord("Z") + 1], _CLASS[ord("0") : ord("9") + 1] = 1, 2, 3
_CLASS[[9, 32]], _CLASS[[10, 11, 12, 13]], _CLASS[128:] = 4, 5, 6
_TRIPLES = 7**3
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
SIZE = _TRIPLES + len(_MARKS) + 10


def _stretch(raw: bytes) -> np.ndarray:
    codes = _CLASS[np.frombuffer(raw, np.uint8)]
    triples = np.bincount(codes[:-2] * 49 + codes[1:-1] * 7 + codes[2:], minlength=_TRIPLES) if len(codes) > 2 else np.zeros(_TRIPLES)
    marks = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)[_MARKS]
    words = raw.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    odd = sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n
    extra = [
        len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        len(set(lines)) / max(1, len(lines)),
        odd,
        sum(len(w) > 1 and w[-1] == w[-2] and w[-1] < 65 for w in words) / n,
        min(float(lengths.mean()) if len(words) else 0.0, 40.0) / 10,
        sum(w.isupper() for w in words) / n,
        len(zlib.compress(raw, 1)) / max(1, len(raw)),
        np.log1p(n) / 10,
        np.log1p(len(lines)) / 10,
    ]
    return np.concatenate([triples / max(1, len(raw)), marks / n, extra]).astype(np.float64)


def features(text: str) -> np.ndarray:
    """Style of a whole text: the mean over its stretches, weighted by bytes, so that memory is bounded."""
    total, weight = np.zeros(SIZE), 0
    for part in stretches(text):
        raw = part.encode("utf-8", "surrogatepass")
        total += _stretch(raw) * len(raw)
        weight += len(raw)
    return (total / max(1, weight)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.mean) / self.scale, -8, 8)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 300, batch: int = 1024, rate: float = 0.02, decay: float = 1e-5, seed: int = 7) -> Model:
    """Minimise prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive)) with the logistic loss, by Adam.

    Where the second part of a batch falls below zero, the step goes against it. Without positives or unlabelled rows
    the model gives the prior to every text.
    """
    every = np.concatenate([positive, unlabelled]) if len(positive) + len(unlabelled) else np.zeros((1, SIZE), np.float32)
    mean, scale = every.mean(0), np.maximum(every.std(0), 1e-3)
    share = min(max(prior, 1e-3), 1 - 1e-3)
    start = Model(np.zeros(every.shape[1]), float(np.log(share / (1 - share))), mean, scale, prior)
    if not len(positive) or not len(unlabelled):
        return start
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    draw = np.random.default_rng(seed)
    theta = np.zeros(p.shape[1] + 1)
    theta[-1] = start.bias
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    steps = max(1, len(u) // batch)
    t = 0
    for _ in range(rounds):
        order_p, order_u = draw.permutation(len(p)), draw.permutation(len(u))
        for k in range(steps):
            xp, xu = p[order_p[k::steps]], u[order_u[k::steps]]
            if not len(xp):
                xp = p
            zp, zu = xp @ theta[:-1] + theta[-1], xu @ theta[:-1] + theta[-1]
            sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            grad_negative = np.append(su @ xu, su.sum()) / len(xu) - prior * np.append(sp @ xp, sp.sum()) / len(xp)
            grad_positive = prior * np.append((sp - 1) @ xp, (sp - 1).sum()) / len(xp)
            grad = grad_positive + grad_negative if negative >= 0 else -grad_negative
            grad[:-1] += decay * theta[:-1]
            t += 1
            first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
            theta -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Model(theta[:-1], float(theta[-1]), mean, scale, prior)


def fold(id_col: str, folds: int = 5):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def _sample(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """Features of the rows of `docs` with the given ids, at most as many as there are ids."""

    def run(batches):
        for batch in batches:
            found = [features(t.as_py()).tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["x"])

    chosen = docs.join(F.broadcast(ids), id_col, "left_semi").dropDuplicates([id_col])
    rows = chosen.select(plain_text(text_col).alias("text")).mapInArrow(run, "x binary").collect()
    return np.array([np.frombuffer(bytes(r["x"]), np.float32) for r in rows]).reshape(-1, SIZE)


def train(docs: DataFrame, labels: DataFrame, bound: int = 6000, held_out_fold: int | None = 0, folds: int = 5, id_col: str = "doc_id", label_col: str = "quality", text_col: str = "text") -> Model:
    """Fit on rows outside the held-out fold: `bound` trusted positives and `bound` unlabelled texts at most, chosen by a
    hash of the id. The prior is the share of positives among all labelled rows of the training folds (1 without labels).

    Null ids and null labels are left out of the fit. Labels enter as the list of positives and the prior only.
    """
    def open_rows(df):
        known = df.filter(F.col(id_col).isNotNull())
        return known if held_out_fold is None else known.filter(fold(id_col, folds) != held_out_fold)

    known = open_rows(labels).select(id_col, F.col(label_col).cast("int").alias("label")).filter("label is not null")
    share = known.agg(F.avg("label")).first()[0]
    by_hash = F.xxhash64(F.col(id_col).cast("string"), F.lit("positives"))
    positives = known.filter("label = 1").select(id_col).distinct().orderBy(by_hash, id_col).limit(bound)
    others = open_rows(docs).select(id_col).orderBy(F.xxhash64(F.col(id_col).cast("string"), F.lit("unlabelled")), id_col).limit(bound)
    prior = 1.0 if share is None else float(share)
    rows = [_sample(docs, ids, id_col, text_col) for ids in (positives, others)]
    return fit(*(x[np.lexsort(x.T[::-1])] if len(x) else x for x in rows), prior)


def scored(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text", score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """All columns of `docs` (of equal names replaced) with `score` in 0 to 1 and `predicted` (1 if score >= threshold).

    Only the text is an input. Null text scores as the empty one. Rows with null or repeated ids are scored alike.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop(score_col, predicted_col)
    at = rest.columns.index(text_col)

    def run(batches):
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for lo in range(0, batch.num_rows, 256):
                own = np.array([features(t.as_py() or "") for t in batch.column(at).slice(lo, 256)]).reshape(-1, SIZE)
                score[lo : lo + 256] = sent.value.score(own)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], [*batch.schema.names, score_col, predicted_col]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    return rest.mapInArrow(run, f"{schema}, {score_col} double, {predicted_col} int")
