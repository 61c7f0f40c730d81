"""Fill-in-middle: prefix, middle and suffix of whole texts, cut between words found eight bytes at once.

A unit is a run of blanks with the word after it (or blanks at the end of a text). The UTF-8 bytes of an
Arrow batch are viewed as 64-bit words; lane arithmetic marks the byte that ends each unit, and
``bitwise_count`` gives the units of a word. A cut after k units is a select: search the counts' running
sum for the word, then clear its lowest marks until the k-th is left. Continuation bytes are marked and
counted in the same way, which turns byte places into code points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Shares of a hundred: documents that are left plain, and of the others those with the suffix first.
PLAIN_FROM, SPM_BELOW = 50, 80
#: 64-bit words that are worked on at once; longer buffers take several stretches.
STRETCH = 1 << 20

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_8, _56 = np.uint64(8), np.uint64(56)


def _blanks(x: np.ndarray) -> np.ndarray:
    """High bit of every lane that holds a space or one of the bytes 9 to 13."""
    low = x & _LOW
    at_9, past_13 = low + _ONES * np.uint64(128 - 9), low + _ONES * np.uint64(128 - 14)
    space = ~((low ^ (_ONES * np.uint64(32))) + _LOW)
    return ((at_9 & ~past_13) | space) & ~x & _HIGH


def _unit_ends(x: np.ndarray, after: int) -> np.ndarray:
    """High bit of every lane whose byte is no blank and whose next byte is one; ``after``: the byte behind."""
    blank = _blanks(x)
    follow = blank >> _8
    follow[:-1] |= blank[1:] << _56
    if after == 32 or 9 <= after <= 13:
        follow[-1] |= np.uint64(1 << 63)
    return ~blank & follow & _HIGH


def _continuations(x: np.ndarray, after: int) -> np.ndarray:
    return x & ~(x << np.uint64(1)) & _HIGH


class Marks:
    """Rank and select over the marked bytes of a buffer, in stretches of bounded memory.

    ``extra``: byte places that are marked besides, each once (sorted).
    """

    def __init__(self, data: np.ndarray, mark, extra: np.ndarray | None = None):
        self.data, self.mark, self.extra = data, mark, np.zeros(0, np.int64) if extra is None else extra
        self.step = STRETCH * 8
        self.totals = np.zeros(-(-len(data) // self.step) + 1, np.int64)
        for k in range(len(self.totals) - 1):
            self.totals[k + 1] = self.totals[k] + int(np.bitwise_count(self._stretch(k)).sum())

    def _stretch(self, k: int) -> np.ndarray:
        """The marks of stretch k as words; bytes behind the buffer count as blanks."""
        a = k * self.step
        held = self.data[a : a + self.step]
        if len(held) % 8:
            held = np.concatenate([held, np.full(8 - len(held) % 8, 32, np.uint8)])
        after = int(self.data[a + self.step]) if a + self.step < len(self.data) else 32
        marks = self.mark(np.ascontiguousarray(held).view("<u8"), after)
        here = self.extra[np.searchsorted(self.extra, a) : np.searchsorted(self.extra, a + self.step)] - a
        if len(here):
            np.bitwise_or.at(marks, here >> 3, np.uint64(0x80) << ((here & 7) << 3).astype(np.uint64))
        return marks

    def _by_stretch(self, stretch: np.ndarray):
        order = np.argsort(stretch, kind="stable")
        cuts = np.flatnonzero(np.diff(stretch[order])) + 1
        for group in np.split(order, cuts) if len(order) else []:
            marks = self._stretch(int(stretch[group[0]]))
            yield int(stretch[group[0]]), group, marks, np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Marks before each byte place."""
        out = np.full(len(places), self.totals[-1], np.int64)
        inside = np.flatnonzero(places < len(self.data))
        for k, group, marks, run in self._by_stretch(places[inside] // self.step):
            at = places[inside[group]] - k * self.step
            below = (np.uint64(1) << ((at & 7) << 3).astype(np.uint64)) - np.uint64(1)
            out[inside[group]] = self.totals[k] + run[at >> 3] + np.bitwise_count(marks[at >> 3] & below)
        return out

    def select(self, numbers: np.ndarray) -> np.ndarray:
        """Byte place of the mark with each number, from 0."""
        out = np.zeros(len(numbers), np.int64)
        for k, group, marks, run in self._by_stretch(np.searchsorted(self.totals, numbers, side="right") - 1):
            left = numbers[group] - self.totals[k]
            word = np.searchsorted(run, left, side="right") - 1
            bits, left = marks[word], left - run[word]
            for _ in range(7):
                bits = np.where(left > 0, bits & (bits - np.uint64(1)), bits)
                left = left - 1
            lowest = bits & (~bits + np.uint64(1))
            out[group] = k * self.step + word * 8 + (np.bitwise_count(lowest - np.uint64(1)) >> 3)
        return out


def cuts(texts: pa.Array, first: np.ndarray, second: np.ndarray) -> dict[str, np.ndarray]:
    """Units n of every text and the cuts after min and max of (first, second) modulo n + 1 units.

    Returns arrays by text: n, begin and end (bytes of the buffer), left and right (byte places of the
    cuts), prefix_chars and middle_chars (code points). The buffer itself is under "data".
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], "<i8", len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if len(texts) else None
    base = int(offsets[0])
    data = np.frombuffer(raw, np.uint8)[base : int(offsets[-1])] if raw is not None and offsets[-1] > base else np.zeros(0, np.uint8)
    begin, end = offsets[:-1] - base, offsets[1:] - base
    filled = end > begin
    units = Marks(data, _unit_ends, end[filled] - 1)
    before = units.rank(begin)
    n = units.rank(end) - before
    low, high = np.minimum(first % (n + 1), second % (n + 1)), np.maximum(first % (n + 1), second % (n + 1))

    def byte_after(k: np.ndarray) -> np.ndarray:
        at = begin.copy()
        some = np.flatnonzero(k > 0)
        at[some] = units.select(before[some] + k[some] - 1) + 1
        return at

    left, right = byte_after(low), byte_after(high)
    inner = Marks(data, _continuations)
    chars = lambda a, b: (b - a) - (inner.rank(b) - inner.rank(a))
    return {
        "data": data, "n": n, "begin": begin, "end": end, "left": left, "right": right,
        "prefix_chars": chars(begin, left), "middle_chars": chars(left, right),
    }


def arrange(prefix: bytes, middle: bytes, suffix: bytes, form: str) -> list[bytes]:
    """The parts of the output in order."""
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if form == "plain":
        return [prefix, middle, suffix]
    return [p, prefix, s, suffix, m, middle] if form == "psm" else [s, suffix, p, prefix, m, middle]


def restore(output: bytes, form: str) -> list[bytes]:
    """The text's parts in order, from an output and its form: the marks occur in it once each."""
    if form == "plain":
        return [output]
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    at_m = output.index(m)
    if form == "psm":
        at_s = output.index(s)
        prefix, suffix = output[len(p) : at_s], output[at_s + len(s) : at_m]
    else:
        at_p = output.index(p)
        suffix, prefix = output[len(s) : at_p], output[at_p + len(p) : at_m]
    return [prefix, output[at_m + len(m) :], suffix]


def _draws(id_col: Column, seed: int) -> list[Column]:
    """The first four 32-bit groups of a sha256 over seed and id, as longs; a null id is written as nothing."""
    sha = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(sha, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    name: str = "fim",
    with_output: bool = True,
) -> DataFrame:
    """``docs`` plus a struct ``name``: n, form, prefix_chars, middle_chars, output, output_sha256 and
    restored_sha256 (of the text put together again from the output).

    The cuts and the form are drawn from a hash of seed and id alone, so reruns agree. Null and empty
    texts, and texts that hold one of the marks, stay plain (null prefix_chars and middle_chars); so does
    the share drawn so. A null id draws like an empty one; rows sharing an id share their draws. Blanks
    alone are one unit. Other columns pass through, one called ``name`` is replaced. Empty in, empty out.
    ``with_output=False`` leaves the output itself null, where only digests are wanted.
    """
    schema = "n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string, restored_sha256 string"

    @F.arrow_udf(schema)
    def build(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, h1, h2, form in batches:
            c = cuts(texts, h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False))
            data = memoryview(c["data"])
            forms, shown, out_sha, back_sha = form.to_pylist(), [], [], []
            for f, a, x, y, b in zip(forms, c["begin"].tolist(), c["left"].tolist(), c["right"].tolist(), c["end"].tolist()):
                output = b"".join(arrange(data[a:x], data[x:y], data[y:b], f))
                out_sha.append(hashlib.sha256(output).hexdigest())
                back = hashlib.sha256()
                for part in restore(output, f):
                    back.update(part)
                back_sha.append(back.hexdigest())
                shown.append(output if with_output else None)
            plain = np.array([f == "plain" for f in forms], bool)
            yield pa.StructArray.from_arrays(
                [
                    pa.array(c["n"]), pa.array(forms, pa.string()), pa.array(c["prefix_chars"], mask=plain), pa.array(c["middle_chars"], mask=plain),
                    pa.array(shown, pa.binary()).cast(pa.string()), pa.array(out_sha, pa.string()), pa.array(back_sha, pa.string()),
                ],
                names=["n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256"],
            )

    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2, h3, h4 = _draws(F.col(id_col), seed)
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = (
        F.when((text == "") | marked | (h3 % 100 >= PLAIN_FROM), "plain").when(h4 % 100 < SPM_BELOW, "spm").otherwise("psm")
    )
    return docs.withColumn(name, build(text, h1, h2, form))
