"""Personal data: fixed patterns plus a character-level bidirectional LSTM with CRF transitions.

The network is trained in numpy on windows around the patterns' matches in a bounded sample. A text is
covered by overlapping windows; the scores of a character are averaged over its windows, and one
Viterbi pass over each unbroken stretch of windows reconciles them, so a span that crosses window
borders comes out whole. Spans of all four kinds hold a digit or an at sign; windows without either
can only be outside and aren't computed.
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

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SIGN = re.compile("[0-9@]")

WINDOW, STEP = 64, 32
EMBED, HIDDEN = 12, 16
LABELS = 1 + 2 * len(KINDS)
SYMBOLS = 128 + 3
SAMPLE_DOCS = 6000
SAMPLE_WINDOWS = 1500
PER_DOC = 8
EPOCHS, BATCH = 8, 50
SHORTEST = 6
WINDOWS_AT_ONCE = 2048


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from the at signs outwards, so long words cost no second look."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        left = at
        while left > end and text[left - 1] in LOCAL:
            left -= 1
        m = DOMAIN.match(text, at + 1) if left < at else None
        if m:
            out.append((left, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the patterns by kind as listed, then start."""
    if not SIGN.search(text):
        return []
    out = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def labelled_spans(text: str) -> list[tuple[str, int, int]]:
    """What the network is taught: the patterns' matches, and card-like numbers of any check digit."""
    base = base_spans(text)
    cards = [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(re.sub("[^0-9]", "", m[0])) <= 19]
    return sorted([s for s in base if s[0] != "card"] + free(cards, [s for s in base if s[0] != "card"]), key=lambda s: s[1])


def codes(text: str) -> np.ndarray:
    """ASCII characters as they are; other letters, other blanks and the rest have a class each."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    if len(points) and points.max() >= 128:
        for c in np.unique(points[points >= 128]):
            points[points == c] = 128 if chr(c).isalpha() else 129 if chr(c).isspace() else 130
    return points


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _run(x: np.ndarray, p: dict[str, np.ndarray], side: str, keep: bool):
    """One direction over x (n, t, EMBED) to hidden states (n, t, HIDDEN)."""
    n, t, _ = x.shape
    h, c = np.zeros((n, HIDDEN), x.dtype), np.zeros((n, HIDDEN), x.dtype)
    out, kept = np.zeros((n, t, HIDDEN), x.dtype), []
    fed = x @ p["x" + side] + p["b" + side]
    for i in range(t) if side == "f" else range(t - 1, -1, -1):
        z = fed[:, i] + h @ p["h" + side]
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        g = np.tanh(z[:, 3 * HIDDEN :])
        before = (h, c)
        c = gates[:, HIDDEN : 2 * HIDDEN] * c + gates[:, :HIDDEN] * g
        tc = np.tanh(c)
        h = gates[:, 2 * HIDDEN :] * tc
        out[:, i] = h
        if keep:
            kept.append((i, gates, g, *before, tc))
    return out, kept


def _run_back(d_out: np.ndarray, x: np.ndarray, p: dict[str, np.ndarray], side: str, kept: list, grads: dict[str, np.ndarray]) -> np.ndarray:
    """Gradients of one direction; returns those of x."""
    n = len(x)
    dh, dc, dx = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN)), np.zeros(x.shape)
    for i, gates, g, h_before, c_before, tc in reversed(kept):
        a, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        dh = dh + d_out[:, i]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * a * (1 - a), dc * c_before * f * (1 - f), dh * tc * o * (1 - o), dc * a * (1 - g * g)], axis=1)
        grads["x" + side] += x[:, i].T @ dz
        grads["h" + side] += h_before.T @ dz
        grads["b" + side] += dz.sum(0)
        dx[:, i] = dz @ p["x" + side].T
        dh, dc = dz @ p["h" + side].T, dc * f
    return dx


def _closed() -> tuple[np.ndarray, np.ndarray]:
    """Start and transition scores that let an inside follow its own kind only."""
    start, trans = np.zeros(LABELS), np.zeros((LABELS, LABELS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        start[inside] = FORBIDDEN
        for before in range(LABELS):
            if before not in (inside - 1, inside):
                trans[before, inside] = FORBIDDEN
    return start, trans


@dataclass(frozen=True)
class Tagger:
    """The trained network; labels are outside, then begin and inside of each kind."""

    params: dict[str, np.ndarray]

    def window_scores(self, windows: np.ndarray) -> np.ndarray:
        p = self.params
        x = p["e"][windows]
        hidden = np.concatenate([_run(x, p, "f", False)[0], _run(x, p, "r", False)[0]], axis=2)
        return hidden @ p["o"] + p["c"]

    def stretch_scores(self, text: str) -> list[tuple[int, np.ndarray]]:
        """(start, averaged scores) of each unbroken stretch of windows with a digit or an at sign."""
        points = codes(text)
        signs = np.flatnonzero(((points >= 48) & (points <= 57)) | (points == 64))
        if not len(signs):
            return []
        last = max(0, -(-(len(points) - WINDOW) // STEP))
        hit = np.unique(np.concatenate([signs // STEP - d for d in range(WINDOW // STEP)]))
        hit = np.unique(np.clip(hit, 0, last))
        padded = np.concatenate([points, np.full(WINDOW, 32)])
        out: list[tuple[int, np.ndarray]] = []
        for group in np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1):
            start, end = group[0] * STEP, min(len(points), group[-1] * STEP + WINDOW)
            total, seen = np.zeros((group[-1] * STEP + WINDOW - start, LABELS)), np.zeros(group[-1] * STEP + WINDOW - start)
            for i in range(0, len(group), WINDOWS_AT_ONCE):
                part = group[i : i + WINDOWS_AT_ONCE]
                scores = self.window_scores(padded[part[:, None] * STEP + np.arange(WINDOW)])
                for k, s in zip(part, scores):
                    at = k * STEP - start
                    total[at : at + WINDOW] += s
                    seen[at : at + WINDOW] += 1
            out.append((int(start), (total / seen[:, None])[: end - start]))
        return out

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        return self.spans_of([text])[0]

    def spans_of(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """Spans of the network in each text: six characters or more, with a digit or an at sign, and no
        letter or digit right before or after."""
        found = [(k, start, s) for k, text in enumerate(texts) for start, s in self.stretch_scores(text)]
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        if not found:
            return out
        lengths = np.array([len(s) for _, _, s in found])
        labels = viterbi(np.concatenate([s for _, _, s in found]), lengths, self.params["s"], self.params["t"])
        for (k, start, _), part in zip(found, np.split(labels, np.cumsum(lengths)[:-1])):
            for i in np.flatnonzero(part % 2 == 1):
                end = i + 1
                while end < len(part) and part[end] == part[i] + 1:
                    end += 1
                a, b = start + int(i), start + int(end)
                glued = texts[k][max(0, a - 1) : a].isalnum() or texts[k][b : b + 1].isalnum()
                if b - a >= SHORTEST and not glued and SIGN.search(texts[k], a, b):
                    out[k].append((KINDS[part[i] // 2], a, b))
        return out


def examples(text: str) -> Iterator[tuple[bool, tuple[bytes, bytes]]]:
    """(labelled, (character codes, tags)) of windows at a text's digits and at signs, labelled by the patterns."""
    if not SIGN.search(text):
        return
    points, tags = codes(text), np.zeros(len(text), np.int64)
    for kind, a, b in labelled_spans(text):
        tags[a:b] = 2 + 2 * KINDS.index(kind)
        tags[a] -= 1
    rng, last = np.random.default_rng(zlib.crc32(text[:WINDOW].encode("utf-8", "surrogatepass"))), -STEP
    for m in SIGN.finditer(text):
        if m.start() - last >= STEP:
            last = m.start()
            a = max(0, last - int(rng.integers(0, WINDOW)))
            x, y = np.full(WINDOW, 32), np.zeros(WINDOW, np.int64)
            part = slice(a, a + WINDOW)
            x[: len(points[part])], y[: len(tags[part])] = points[part], tags[part]
            if y[0] and y[0] % 2 == 0:
                y[0] -= 1  # a span cut by the window's border begins here
            yield bool(y.any()), (x.astype(np.int64).tobytes(), y.tobytes())


def train(texts: list[str], windows: int = SAMPLE_WINDOWS, epochs: int = EPOCHS, seed: int = 7) -> Tagger:
    """Trains on the first ``windows`` examples of the texts."""
    return train_on(first_examples(texts, examples, windows), epochs, seed)


def train_on(windows: list[tuple[bytes, bytes]], epochs: int = EPOCHS, seed: int = 7) -> Tagger:
    """Trains on examples. Without any, the network finds nothing."""
    rng = np.random.default_rng(seed)
    xs, ys = [np.frombuffer(x, np.int64) for x, _ in windows], [np.frombuffer(y, np.int64) for _, y in windows]
    start, trans = _closed()
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    p = {"e": rng.normal(0, 0.5, (SYMBOLS, EMBED)), "o": draw(2 * HIDDEN, LABELS), "c": np.zeros(LABELS), "s": start, "t": trans}
    for side in "fr":
        p |= {"x" + side: draw(EMBED, 4 * HIDDEN), "h" + side: draw(HIDDEN, 4 * HIDDEN), "b" + side: np.zeros(4 * HIDDEN)}
        p["b" + side][HIDDEN : 2 * HIDDEN] = 1.0
    if not xs:
        p["o"][:], p["c"][1:] = 0.0, FORBIDDEN
        return Tagger(p)
    x_all, y_all, mask = np.array(xs), np.array(ys), np.ones((BATCH, WINDOW), bool)
    adam = Adam(p, 0.02)
    for _ in range(epochs):
        order = rng.permutation(len(x_all))
        for i in range(0, len(order), BATCH):
            x_ids, y = x_all[order[i : i + BATCH]], y_all[order[i : i + BATCH]]
            x = p["e"][x_ids]
            (hf, kf), (hr, kr) = _run(x, p, "f", True), _run(x, p, "r", True)
            hidden = np.concatenate([hf, hr], axis=2)
            _, d_scores, d_start, d_trans = likelihood(hidden @ p["o"] + p["c"], y, mask[: len(y)], p["s"], p["t"])
            grads = {k: np.zeros_like(v) for k, v in p.items()}
            grads["o"], grads["c"] = np.einsum("nth,ntl->hl", hidden, d_scores), d_scores.sum((0, 1))
            grads["s"], grads["t"] = d_start, d_trans
            d_hidden = d_scores @ p["o"].T
            dx = _run_back(d_hidden[..., :HIDDEN], x, p, "f", kf, grads) + _run_back(d_hidden[..., HIDDEN:], x, p, "r", kr, grads)
            np.add.at(grads["e"], x_ids, dx)
            adam.step(grads)
    closed_start, closed = _closed()
    p["s"][closed_start == FORBIDDEN] = FORBIDDEN
    p["t"][closed == FORBIDDEN] = FORBIDDEN
    return Tagger({k: v.astype(np.float32) for k, v in p.items()})


def fit_tagger(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text") -> Tagger:
    """The network trained on SAMPLE_WINDOWS windows at most, of ``sample_docs`` documents at most and of each
    at most PER_DOC with and PER_DOC without a labelled span; the windows are cut in the tasks, the training
    is local."""
    return train_on(sample_examples(docs, examples, sample_docs, SAMPLE_WINDOWS, PER_DOC, id_col, text_col))


def find_personal_data(docs: DataFrame, tagger: Tagger, text_col: str = "text", name: str = "pii") -> DataFrame:
    """``docs`` plus a struct: counts of the patterns' kinds, their digest, all spans as text, and the
    same spans as an array.

    Spans are in code points of the whole text, end exclusive, ordered by kind and start; the network's
    are added where they overlap no pattern's. Null text: as empty, no span. Equal texts get equal
    answers; other columns pass through (a column called ``name`` is replaced). Empty in, empty out.
    """
    fields = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, found array<struct<kind:string,begin:int,end:int>>"

    @F.pandas_udf(fields)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            plain = [t or "" for t in batch]
            for text, own in zip(plain, (tagger.spans(t) for t in plain)):
                base = base_spans(text)
                every = sorted(base + free(own, base), key=lambda s: (KINDS.index(s[0]), s[1]))
                n = [sum(s[0] == k for s in base) for k in KINDS]
                rows.append((*n, digest(base), written(every), [{"kind": k, "begin": a, "end": b} for k, a, b in every]))
            yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "found"])

    return docs.withColumn(name, find(F.col(text_col)))
