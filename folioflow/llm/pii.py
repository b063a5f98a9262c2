"""Personal data: fixed patterns, and a linear-chain conditional random field for forms that the patterns miss.

The field labels white-space separated words by their shapes and their neighbours'. It is trained from a small
labelled table and decoded by Viterbi over numpy batches of word runs around words with a digit, an at sign or a
bracketed stand-in for one; words farther away belong to no span.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.common import plain_text
from folioflow.llm.tokens import by_bytes, text_sizes

KINDS = ("email", "ip", "card", "phone")
STATES = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
NEAR = 3  # words on either side of a marked word that belong to its run
GRID = 2048 * 256  # words, with those that fill up shorter runs, of the runs decoded side by side; a longer run is decoded alone

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match begins where a run of digits does: from inside a run the rest would match or fail alike.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    own = [int(c) for c in reversed(digits)]
    return sum(own[::2]) % 10 == -sum(sum(divmod(2 * d, 10)) for d in own[1::2]) % 10


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the fixed patterns, by kind as in KINDS, then start; code points, end exclusive."""
    spans = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            spans.append(("email", start, done))
        else:
            # What lies before this sign can be part of no later address.
            done = at + 1
        at = text.find("@", at + 1)
    if not _DIGIT.search(text):
        return spans
    spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
    spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return spans


# ---- word shapes

_AT = re.compile(r"[(\[{<]\s?at\s?[)\]}>]", re.I)
_DOT = re.compile(r"[(\[{<]\s?dot\s?[)\]}>]", re.I)
_CUES = {
    "email": "email", "e-mail": "email", "mail": "email", "mailto": "email", "contact": "email", "phone": "phone", "tel": "phone", "telephone": "phone", "call": "phone",
    "mobile": "phone", "fax": "phone", "card": "card", "visa": "card", "mastercard": "card", "credit": "card", "ip": "ip", "host": "ip", "address": "address",
}
_DOTTED = re.compile(r"^\W*[\w-]+(\.[\w-]+)+\W*$")
_QUAD = re.compile(r"^\W*\d{1,3}(\.\d{1,3}){3}(:\d+)?(/\d+)?\W*$")


def shape(word: str) -> tuple[str, ...]:
    """Names of the features of one word."""
    digits = sum(c.isdigit() for c in word)
    letters = sum(c.isalpha() for c in word)
    inner = word.strip(".,;:!?\"'")
    pattern = re.sub("A+", "A", re.sub("a+", "a", re.sub("9{5,}", "9+", "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in inner[:40]))))
    found = [
        f"digits={digits if digits < 5 else '5-7' if digits < 8 else '8-11' if digits < 12 else '12-15' if digits < 16 else '16-19' if digits < 20 else '20'}",
        f"letters={min(letters, 2)}", f"dots={min(inner.count('.'), 4)}", f"hyphens={min(inner.count('-'), 4)}", f"cue={_CUES.get(inner.strip('()').lower(), '')}",
    ]
    found += ["@"] * ("@" in word) + ["at"] * bool(_AT.search(word)) + ["dot"] * bool(_DOT.search(word)) + ["+"] * inner.startswith("+") + ["("] * ("(" in word) + [")"] * (")" in word)
    found += ["quad"] * bool(_QUAD.match(word)) + ["dotted"] * bool(_DOTTED.match(word) and letters) + ["colon"] * (":" in inner) + ["slash"] * ("/" in inner) + ["money"] * any(c in word for c in "$€£%")
    found += [f"shape={pattern}"] if len(pattern) < 16 and digits else []
    return tuple(found)


_MARK = re.compile(r"[0-9@]|[(\[{<]\s?(?:at|dot)\s?[)\]}>]", re.I)
_WORD = re.compile(r"[^ \t-\r]+")


# ---- the field


@dataclass(frozen=True)
class Field:
    features: dict[str, int]
    emit: np.ndarray  # 3 (word before, word, word after) x features x states
    move: np.ndarray  # states x states
    first: np.ndarray

    def rows(self, word: str, known: dict) -> np.ndarray:
        """Scores of a word for the states of the word after it, of itself and of the word before it."""
        got = known.get(word)
        if got is None:
            own = [self.features[f] for f in shape(word) if f in self.features]
            got = self.emit[:, own].sum(1)
            if len(known) < 200_000:
                known[word] = got
        return got

    def scores(self, words: list[str], known: dict) -> np.ndarray:
        rows = np.array([self.rows(w, known) for w in words]).reshape(-1, 3, len(STATES))
        out = rows[:, 1].copy()
        out[1:] += rows[:-1, 0]
        out[:-1] += rows[1:, 2]
        return out

    def decode(self, runs: list[np.ndarray]) -> list[np.ndarray]:
        """Best states of each run by Viterbi, all runs of a batch side by side."""
        out: list[np.ndarray] = [np.zeros(0, int)] * len(runs)
        order = sorted(range(len(runs)), key=lambda i: len(runs[i]))
        lo = 0
        while lo < len(order):
            hi = lo + 1
            while hi < min(lo + 2048, len(order)) and (hi + 1 - lo) * len(runs[order[hi]]) <= GRID:
                hi += 1
            own, lo = order[lo:hi], hi
            sizes = np.array([len(runs[i]) for i in own])
            top = int(sizes.max(initial=0))
            grid = np.zeros((len(own), top, len(STATES)))
            for k, i in enumerate(own):
                grid[k, : len(runs[i])] = runs[i]
            best, back = self.first + grid[:, 0], np.zeros((len(own), top, len(STATES)), np.int8)
            last = best.copy()
            for t in range(1, top):
                ways = best[:, :, None] + self.move
                back[:, t] = ways.argmax(1)
                best = ways.max(1) + grid[:, t]
                last[sizes > t] = best[sizes > t]
            state = last.argmax(1)
            path = np.zeros((len(own), top), np.int64)
            for t in range(top - 1, -1, -1):
                inside = sizes > t
                path[inside, t] = state[inside]
                state[inside] = back[inside, t, state[inside]]
            for k, i in enumerate(own):
                out[i] = path[k, : sizes[k]]
        return out


_FORBIDDEN = np.array([[b.startswith("I-") and a[2:] != b[2:] for b in STATES] for a in STATES])


def train(labelled: DataFrame, rounds: int = 100, rate: float = 0.1, decay: float = 0.002) -> Field:
    """Fit the field to a small table (words array<string>, states array<string>) by maximum likelihood.

    Rows with a null, empty sequences and unequal lengths are left out. An empty table gives a field that finds nothing.
    """
    rows = [(list(r["words"]), list(r["states"])) for r in labelled.orderBy("words").collect() if r["words"] and r["states"] and len(r["words"]) == len(r["states"])]
    names = sorted({f for words, _ in rows for w in words for f in shape(w)})
    features = {f: i for i, f in enumerate(names)}
    n, k, top = len(rows), len(STATES), max((len(w) for w, _ in rows), default=0)
    sizes = np.array([len(w) for w, _ in rows])
    if not rows:
        quiet = np.where(np.arange(k) == 0, 0.0, -1e4)
        return Field({}, np.zeros((3, 0, k)), np.tile(quiet, (k, 1)), quiet)
    x = np.zeros((n, top + 2, len(names)), np.float32)
    gold = np.zeros((n, top), np.int64)
    for i, (words, states) in enumerate(rows):
        for t, word in enumerate(words):
            x[i, t + 1, [features[f] for f in shape(word)]] = 1
        gold[i, : len(words)] = [STATES.index(s) for s in states]
    inside = np.arange(top) < sizes[:, None]
    near = np.concatenate([x[:, :-2], x[:, 1:-1], x[:, 2:]], 2).reshape(n * top, -1)
    barred = np.where(_FORBIDDEN, -1e4, 0.0)
    start_bar = np.where([s.startswith("I-") for s in STATES], -1e4, 0.0)
    one = np.eye(k)[gold] * inside[..., None]
    gold_moves = np.einsum("nta,ntb->ab", one[:, :-1], one[:, 1:])
    theta = [np.zeros((near.shape[1], k)), np.zeros((k, k)), np.zeros(k)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in theta]

    def log_sum(values, axis):
        high = values.max(axis, keepdims=True)
        return (high + np.log(np.exp(values - high).sum(axis, keepdims=True))).squeeze(axis)

    for step in range(1, rounds + 1):
        emit = (near @ theta[0]).reshape(n, top, k)
        move, first = theta[1] + barred, theta[2] + start_bar
        ahead, behind = np.zeros((n, top, k)), np.zeros((n, top, k))
        ahead[:, 0] = first + emit[:, 0]
        for t in range(1, top):
            ahead[:, t] = log_sum(ahead[:, t - 1, :, None] + move, 1) + emit[:, t]
        for t in range(top - 2, -1, -1):
            step_back = log_sum(move + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(inside[:, t + 1, None], step_back, 0)
        total = log_sum(ahead[np.arange(n), sizes - 1], 1)
        marginal = np.exp(ahead + behind - total[:, None, None]) * inside[..., None]
        pair = ahead[:, :-1, :, None] + move + (emit[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        moves = (np.exp(np.minimum(pair, 0)) * inside[:, 1:, None, None]).sum((0, 1))
        grads = [near.T @ (marginal - one).reshape(n * top, k), moves - gold_moves, (marginal[:, 0] - one[:, 0]).sum(0)]
        for j, g in enumerate(grads):
            g = g / n + decay * theta[j]
            m, v = moments[j]
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            moments[j] = (m, v)
            theta[j] = theta[j] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(features, theta[0].reshape(3, len(names), k), theta[1] + barred, theta[2] + start_bar)


def labelled_words(spark: SparkSession, rows: int = 400, seed: int = 11) -> DataFrame:
    """The default training table: word runs made by a rule, with personal data in usual and unusual forms and look-alikes."""
    draw = random.Random(seed)
    d = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    w = lambda: "".join(draw.choice("aeioulnrstdmhéüñ") for _ in range(draw.randint(2, 9)))
    host = lambda: f"{w()}{draw.choice(['', d(1)])}.{draw.choice(['example', 'mail', w()])}.{draw.choice(['com', 'org', 'net', 'de'])}"
    octet = lambda: str(draw.randint(0, 255))

    def email():
        name = draw.choice([w(), w() + "." + w(), w() + d(2), w() + "." + d(2)])
        return draw.choice([[f"{name}@{host()}"], [f"{name}@{host()}"], [name, "(at)", host()], [name, "[at]", w(), "[dot]", "com"], [f"{name}(at){host()}"], [f"{name}[at]{w()}[dot]org"]])

    def ip():
        own = [octet() for _ in range(4)]
        return draw.choice([[".".join(own)], [".".join(own)], [".".join(own) + ":" + d(4)], [".".join(own) + "/" + draw.choice(["8", "16", "24"])], ["[.]".join(own)]])

    def card():
        own = "4" + d(15)
        groups = [own[i : i + 4] for i in range(0, 16, 4)]
        return draw.choice([[own], [own], groups, ["-".join(groups)], [".".join(groups)]])

    def phone():
        a, b, c, e = draw.choice("123456789"), d(3), "555", d(4)
        return draw.choice([[f"+{a}", f"({b})", f"{c}-{e}"], [f"+{a}", f"({b})", f"{c}-{e}"], [f"+{a}-{b}-{c}-{e}"], [f"({b})", f"{c}-{e}"], [f"{b}-{c}-{e}"], [f"+{a}{b}{c}{e}"], [f"{b}.{c}.{e}"]])

    def other():
        return draw.choice(
            [
                [d(draw.randint(1, 5))], [d(draw.randint(6, 12))], [f"{d(2)}.{d(2)}"], [f"v{d(1)}.{d(1)}.{d(1)}"], [f"{d(1)}.{d(1)}.{d(2)}"], [f"19{d(2)}-0{draw.randint(1, 9)}-1{draw.randint(0, 9)}"], [f"{d(2)}:{d(2)}"], ["$" + d(3)],
                [d(2) + "%"], [w() + d(2)], ["@" + w()], [f"{w()}@"], [f"({d(4)})"], [f"{d(3)}-{d(3)}"], ["Version", d(1) + "." + d(1)], ["10,000"], [d(1) + "."], [f"{w()}{d(8)}{w()}"], ["978-" + d(1) + "-" + d(4) + "-" + d(4) + "-" + d(1)], ["0x" + d(6)],
                [f"https://{host()}/{w()}?{d(3)}"], [f"www.{host()}"], [f"item_{d(3)}"], [f"{d(3)},", f"{d(3)},", f"{d(3)}"], [d(4), d(4)], [d(24)], [w() + "***"], [w() + "!!"],
            ]
        )

    made, out = {"email": email, "ip": ip, "card": card, "phone": phone}, []
    for i in range(rows):
        words, states = [], []
        for _ in range(draw.randint(1, 3)):
            plain = [w() for _ in range(draw.randint(1, 3))]
            words += plain
            states += ["O"] * len(plain)
            kind = draw.choice([*KINDS, "other", "other", "other"])
            own = made.get(kind, other)()
            own[-1] += draw.choice(["", "", "", ".", ",", ";"])
            words += own
            states += ["O"] * len(own) if kind == "other" else [f"B-{kind}"] + [f"I-{kind}"] * (len(own) - 1)
        plain = [w() for _ in range(draw.randint(0, 2))]
        out.append((words + plain, states + ["O"] * len(plain)))
    return spark.createDataFrame(out, "words array<string>, states array<string>")


def _edges(text: str, kind: str, start: int, end: int) -> tuple[int, int]:
    before, after = (".,;:!?\"'<>)]}", ".,;:!?\"'<>([{") if kind == "phone" else (".,;:!?\"'<>()[]{}", ".,;:!?\"'<>()[]{}")
    while start < end and text[start] in before:
        start += 1
    while end > start and text[end - 1] in after:
        end -= 1
    return start, end


def runs_of(text: str) -> list[list[tuple[int, int]]]:
    """Word runs to decode: (start, end) of each word that has a marked word within NEAR words."""
    marks = [m.start() for m in _MARK.finditer(text)]
    if not marks:
        return []
    out: list[list[tuple[int, int]]] = []
    done = 0  # all words that begin before this are dealt with
    k = 0
    while k < len(marks):
        # From this mark's word, a few words back.
        at = marks[k]
        begin = at
        for _ in range(NEAR + 1):
            while begin > done and text[begin - 1] not in " \t\n\v\f\r":
                begin -= 1
            if _ == NEAR or begin <= done:
                break
            while begin > done and text[begin - 1] in " \t\n\v\f\r":
                begin -= 1
        own, left = [], 1
        for m in _WORD.finditer(text, begin):
            has = False
            while k < len(marks) and marks[k] < m.end():
                has = True
                k += 1
            if has:
                left = NEAR + 1
            elif left <= 0 and m.start() > at:
                break
            own.append((m.start(), m.end()))
            done = m.end()
            if m.end() > at:
                left -= 1
        out.append(own)
    return out


def found_spans(texts: list[str], field: Field, known: dict) -> list[list[tuple[str, int, int]]]:
    """Spans by the field in each text."""
    where, scores = [], []
    for i, text in enumerate(texts):
        for run in runs_of(text):
            where.append((i, run))
            scores.append(field.scores([text[a:b] for a, b in run], known))
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for (i, run), path in zip(where, field.decode(scores), strict=True):
        k = 0
        while k < len(run):
            state = STATES[path[k]]
            first, k = k, k + 1
            if state != "O":
                while k < len(run) and STATES[path[k]] == "I-" + state[2:]:
                    k += 1
                start, end = _edges(texts[i], state[2:], run[first][0], run[k - 1][1])
                if start < end:
                    out[i].append((state[2:], start, end))
    return out


SPANS = "array<struct<kind:string,start:int,end:int>>"


def personal_data(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id, `base` (spans by the fixed patterns) and `spans` (those, and the field's that overlap none).

    Spans are (kind, start, end) in code points of the whole text, end exclusive, by kind as in KINDS, then start. Null
    text counts as empty: no spans. Null and repeated ids are passed on. Other columns are not read. No shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)
    kind_of = {k: i for i, k in enumerate(KINDS)}
    shape_ = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def as_rows(spans):
        return [{"kind": k, "start": a, "end": b} for k, a, b in spans]

    def run(batches):
        known: dict = {}
        for batch in batches:
            base, every = [], []
            for lo, hi in by_bytes(text_sizes(batch.column(1)), 4 << 20):
                texts = batch.column(1).slice(lo, hi - lo).to_pylist()
                for text, more in zip(texts, found_spans(texts, sent.value, known), strict=True):
                    own = base_spans(text)
                    new = [s for s in more if not any(s[1] < b and a < s[2] for _, a, b in own)]
                    base.append(as_rows(own))
                    every.append(as_rows(sorted([*own, *new], key=lambda s: (kind_of[s[0]], s[1]))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, shape_), pa.array(every, shape_)], ["id", "base", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), plain_text(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, base {SPANS}, spans {SPANS}").withColumnRenamed("id", id_col)


def redacted(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs` with each span of personal data in the text replaced by its kind in angle brackets."""
    sent = docs.sparkSession.sparkContext.broadcast(field)
    at = docs.columns.index(text_col)

    def run(batches):
        known: dict = {}
        for batch in batches:
            out = []
            for text in batch.column(at).to_pylist():
                own = base_spans(text) if text else []
                spans = own + [s for s in (found_spans([text], sent.value, known)[0] if text else []) if not any(s[1] < b and a < s[2] for _, a, b in own)]
                # Of overlapping spans of two kinds the outer or earlier one is named.
                done, parts = 0, []
                for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
                    if a >= done:
                        parts += [text[done:a], f"<{kind}>"]
                    done = max(done, b)
                out.append(None if text is None else "".join([*parts, text[done:]]))
            columns = list(batch.columns)
            columns[at] = pa.array(out, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
