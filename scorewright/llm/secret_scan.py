"""Secret scan: fixed patterns plus a linear-chain CRF over tokens, decoded by Viterbi.

All tokens of a text are one sequence, tagged begin, inside or outside. A secret holds no white space, so the
first token of a stretch of marks without white space is never inside. A secret may begin at a token of six or
more ASCII characters that mixes letters with digits or cases, or at any token of that length within three
stretches after a word for keys; all other tokens can only be outside or inside. A run of stretches
where none begins adds the same score to every path, so it is decoded as one outside token and
the result is that of decoding the whole text. Features: a token's shape, length, prefix and variety of
characters, the words and marks before and after it, and facts about the file (kinds of words in
it, share of digits). Weights are fitted on a bounded sample whose labels are the patterns' matches.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from scorewright.llm.crf import FORBIDDEN, Adam, likelihood, viterbi
from scorewright.llm.samples import digest, first_examples, free, sample_examples, written

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

CHUNK = re.compile(r"\S+")
#: What every token that may begin a secret holds: a digit, or a capital after another letter.
SIGN = re.compile(r"[0-9]|[A-Za-z][A-Z]")
TOKEN = re.compile(r"[A-Za-z0-9+/_.-]+|=+|[^\sA-Za-z0-9+/_.=-]")
WORD = re.compile(r"\w+|[^\w\s]")
AROUND = 48
#: Words for keys: a secret of plain letters or digits is looked for close behind them.
KEY_WORDS = ("key", "secret", "token", "passw", "credential")
KEY = re.compile("|".join(KEY_WORDS), re.IGNORECASE)
STRETCHES_AFTER = 3
PLAIN = re.compile(r"[A-Za-z0-9+/_.-]{6,}")
FILE_WORDS = ("key", "secret", "token", "password", "config", "http", "@")

SAMPLE_DOCS = 6000
SAMPLE_SEQUENCES = 4000
PER_DOC = 8
WIDTH = 1 << 12
LONGEST = 24
EPOCHS = 40


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the patterns by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def labelled_spans(text: str) -> list[tuple[int, int]]:
    """What the field is taught: the values of assignments, and the other matches."""
    out = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    return out + [(a, b) for kind, a, b in base_spans(text) if kind != "assign"]


def may_begin(token: str) -> bool:
    if len(token) < 6:
        return False
    digit, low, up = (any(map(f, token)) for f in (str.isdigit, str.islower, str.isupper))
    return token.isascii() and ((digit and (low or up)) or (low and any(c.isupper() for c in token[1:])))


def _shape(token: str) -> str:
    s = re.sub("[a-z]+", "x", re.sub("[A-Z]+", "X", re.sub("[0-9]+", "d", token)))
    return s if len(s) <= 8 else f"{s[:4]}~{len(set(s))}"


def _bucket(n: int) -> int:
    return min(n, 8) if n <= 8 else 8 + min(8, n // 8)


@dataclass
class Island:
    """Tokens without white space between them, with hashed features of each. ``after_others``: tokens that can
    only be outside lie between it and the island (or the text's start) before."""

    spans: list[tuple[int, int]]
    features: list[list[int]]
    begins: list[bool]
    inner: list[bool]
    after_others: bool


def _hash(*parts: object) -> int:
    return zlib.crc32("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")) % WIDTH


def file_features(text: str) -> list[int]:
    low = text.lower()
    digits = sum(map(text.count, "0123456789")) / max(1, len(text))
    out = [_hash("file", w) for w in FILE_WORDS if w in low]
    return out + [_hash("digits", int(np.searchsorted([0.002, 0.01, 0.05, 0.2], digits)))]


def _stretches(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, close behind a word for keys) of the stretches in which a secret might begin, in order."""
    near: dict[int, int] = {}
    if any(w in text.lower() for w in KEY_WORDS):
        for m in KEY.finditer(text):
            left = m.start()
            if left < max(near.values(), default=0):
                continue
            while left and not text[left - 1].isspace():
                left -= 1
            for chunk, _ in zip(CHUNK.finditer(text, left), range(STRETCHES_AFTER + 1)):
                near[chunk.start()] = chunk.end()
    waiting, done = iter(sorted(near.items())), -1
    ahead = next(waiting, None)
    for m in SIGN.finditer(text):
        if m.start() < done:
            continue
        left = m.start()
        while left > max(0, done) and not text[left - 1].isspace():
            left -= 1
        while ahead and ahead[0] < left:
            yield *ahead, True
            ahead = next(waiting, None)
        done = CHUNK.match(text, left).end()
        close = bool(ahead) and ahead[0] == left
        if close:
            ahead = next(waiting, None)
        yield left, done, close
    while ahead:
        yield *ahead, True
        ahead = next(waiting, None)


def islands(text: str) -> Iterator[Island]:
    """Every stretch of the text in which a secret may begin."""
    about, last = None, 0
    for left, done, close in _stretches(text):
        found = TOKEN.findall(text, left, done)
        begins = [may_begin(w) or (close and bool(PLAIN.fullmatch(w))) for w in found]
        if not any(begins):
            continue
        if about is None:
            about = file_features(text)
        tokens = list(TOKEN.finditer(text, left, done))
        words = [t[0] for t in tokens]
        before = WORD.findall(text[max(0, left - AROUND) : left])[-2:]
        after = WORD.findall(text[done : done + AROUND])[:1]
        line = ["<s>", "<s>", *before][-2:] + words + (after or ["</s>"])
        rows = []
        for i, w in enumerate(words):
            p2, p1, n1 = line[i], line[i + 1], line[i + 3]
            rows.append(
                [
                    _hash("bias"), _hash("shape", _shape(w)), _hash("len", _bucket(len(w))), _hash("pre", w[:4]),
                    _hash("distinct", _bucket(len(set(w)))), _hash("hex", bool(re.fullmatch("[0-9a-f]+", w)), _bucket(len(w))),
                    _hash("digits", _bucket(sum(map(str.isdigit, w)))),
                    _hash("prev", p1.lower() if len(p1) < 16 else _shape(p1)), _hash("prev2", p2.lower() if len(p2) < 16 else _shape(p2)),
                    _hash("prevshape", _shape(p1)), _hash("next", n1.lower() if len(n1) < 4 else _shape(n1)), *about,
                ]
            )
        inner = [False, *(bool(re.fullmatch(r"[A-Za-z0-9+/_.=-]+", w)) for w in words[1:])]
        between = text[last:left]
        yield Island([t.span() for t in tokens], rows, begins, inner, bool(between) and not between.isspace())
        last = done


@dataclass(frozen=True)
class Field:
    """Weights (features x 3 labels: outside, begin, inside), start and transition scores."""

    weights: np.ndarray
    start: np.ndarray
    trans: np.ndarray

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        scores, places, end = [], [], 0
        for island in islands(text):
            if island.after_others:
                scores.append(OUTSIDE)
                places.append(None)
            scores.append(_scores(island, self.weights))
            places += island.spans
            end = island.spans[-1][1]
        if not scores:
            return []
        if text[end:].strip():
            scores.append(OUTSIDE)
            places.append(None)
        labels = viterbi(np.concatenate(scores), np.array([len(places)]), self.start, self.trans)
        out: list[tuple[str, int, int]] = []
        for place, label in zip(places, labels):
            if label == 1:
                out.append(("crf", *place))
            elif label == 2:
                out[-1] = ("crf", out[-1][1], place[1])
        return out


#: Scores of a token that can only be outside.
OUTSIDE = np.array([[0.0, FORBIDDEN, FORBIDDEN]])


def _scores(island: Island, weights: np.ndarray) -> np.ndarray:
    flat = np.array([f for row in island.features for f in row])
    ends = np.cumsum([len(r) for r in island.features])
    out = np.add.reduceat(weights[flat], np.concatenate([[0], ends[:-1]]), axis=0)
    out[~np.array(island.begins), 1] = FORBIDDEN
    out[~np.array(island.inner), 2] = FORBIDDEN
    return out


def _constrained() -> tuple[np.ndarray, np.ndarray]:
    """Start and transition scores that forbid an inside after an outside."""
    start, trans = np.zeros(3), np.zeros((3, 3))
    start[2] = trans[0, 2] = FORBIDDEN
    return start, trans


def examples(text: str) -> Iterator[tuple[bool, tuple]]:
    """(labelled, (features, may begin, may be inside, tags)) of the islands of a text, as the patterns see them,
    with the outside tokens around them. Islands longer than LONGEST tokens are not learned from."""
    gold, nothing = labelled_spans(text), ([], False, False, 0)
    for island in islands(text):
        if len(island.spans) > LONGEST:
            continue
        rows, last = [nothing] * island.after_others, None
        for (a, b), x, begin, inner in zip(island.spans, island.features, island.begins, island.inner):
            hit = next((g for g in gold if g[0] < b and a < g[1]), None)
            tag = 0 if hit is None else 2 if hit == last and inner else 1 if begin else 0
            last = hit if tag else None
            rows.append((x, begin, inner, tag))
        if text[island.spans[-1][1] :].strip():
            rows.append(nothing)
        yield any(r[3] for r in rows), tuple(zip(*rows))


def train(texts: list[str], sequences: int = SAMPLE_SEQUENCES, epochs: int = EPOCHS) -> Field:
    """Fits the field on the first ``sequences`` examples of the texts."""
    return train_on(first_examples(texts, examples, sequences), epochs)


def train_on(sequences: list[tuple], epochs: int = EPOCHS) -> Field:
    """Fits the field on examples. Without any, it finds nothing."""
    weights = np.zeros((WIDTH, 3))
    start, trans = _constrained()
    if not sequences:
        weights[:, 0] = 1.0
        return Field(weights, start, trans)
    n, t = len(sequences), max(len(s[3]) for s in sequences)
    f = max(len(x) for s in sequences for x in s[0])
    ids, mask, gold = np.full((n, t, f), WIDTH), np.zeros((n, t), bool), np.zeros((n, t), np.int64)
    closed = np.zeros((n, t, 3))
    for i, (features, begins, inner, tags) in enumerate(sequences):
        for j, x in enumerate(features):
            ids[i, j, : len(x)] = x
            closed[i, j] = (0, 0 if begins[j] else FORBIDDEN, 0 if inner[j] else FORBIDDEN)
        mask[i, : len(tags)], gold[i, : len(tags)] = True, tags
    params = {"w": np.zeros((WIDTH + 1, 3)), "s": start, "t": trans}
    adam = Adam(params, 0.1)
    for _ in range(epochs):
        scores = params["w"][ids].sum(2) + closed
        _, d_scores, d_start, d_trans = likelihood(scores, gold, mask, params["s"], params["t"])
        d_w = np.zeros_like(params["w"])
        np.add.at(d_w, ids.reshape(-1), np.repeat(d_scores.reshape(-1, 3), f, axis=0))
        d_w[WIDTH] = 0
        adam.step({"w": d_w + 1e-5 * params["w"], "s": d_start, "t": d_trans})
    params["s"][2] = params["t"][0, 2] = FORBIDDEN
    return Field(params["w"][:WIDTH], params["s"], params["t"])


def fit_field(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """The field fitted on SAMPLE_SEQUENCES islands at most, of ``sample_docs`` documents at most and of each at
    most PER_DOC with and PER_DOC without a label; the islands are cut in the tasks, the fitting is local."""
    return train_on(sample_examples(docs, examples, sample_docs, SAMPLE_SEQUENCES, PER_DOC, id_col, text_col))


def scan_secrets(docs: DataFrame, field: Field, text_col: str = "text", name: str = "secrets") -> DataFrame:
    """``docs`` plus a struct: counts of the patterns' kinds, their digest, all spans as text, and the
    same spans as an array.

    Spans are in code points of the whole text, end exclusive; the field's spans (kind crf) are added
    where they overlap no pattern's. Null text: as empty, no span. Equal texts get equal answers; other
    columns pass through (a column called ``name`` is replaced). Empty in, empty out.
    """
    fields = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, found array<struct<kind:string,begin:int,end:int>>"

    @F.pandas_udf(fields)
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for text in batch:
                text = text or ""
                base = base_spans(text)
                added = free(field.spans(text), base)
                every = sorted(base + added, key=lambda s: (s[1], (*KINDS, "crf").index(s[0])))
                n = [sum(s[0] == k for s in base) for k in KINDS]
                rows.append((*n, digest(base), written(every), [{"kind": k, "begin": a, "end": b} for k, a, b in every]))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"])

    return docs.withColumn(name, scan(F.col(text_col)))
