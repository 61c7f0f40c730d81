"""Language identification by rank-order n-gram profiles and out-of-place distance.

A profile lists the most frequent letter 1- to 3-grams in order of frequency. The profiles of the
languages are summed by Spark from partial counts of a bounded sample of labelled documents; a
document goes to the language whose ranks differ least from its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from scorewright.llm.base import boxed, field, unboxed

PROFILE = 400
SAMPLE_DOCS = 1500
UNKNOWN = "und"
#: Letters below this code point have a class of their own; the others share the rest of 10 bits.
OWN, CLASSES = 0x250, 1 << 10
_CLASS: list[np.ndarray] = []


def letter_classes() -> np.ndarray:
    """Code point -> class of a letter, 0 for everything else; built once in each process."""
    if not _CLASS:
        points = np.arange(0x110000, dtype=np.uint32)
        letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        own = np.where(points < OWN, points, OWN + points * np.uint32(2654435761) % np.uint32(CLASSES - OWN))
        _CLASS.append(np.where(letter, own, 0).astype(np.uint32))
    return _CLASS[0]


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 1- to 3-grams of a whole text (codes) and their counts. Case is folded, everything
    but letters parts words, and 2- and 3-grams may hold one parting mark at an end."""
    raw = (text or "").lower().encode("utf-32-le", "surrogatepass")
    a = letter_classes()[np.frombuffer(raw, dtype="<u4")]
    a = np.concatenate([np.zeros(1, np.uint32), a, np.zeros(1, np.uint32)])
    one, two = a[a > 0], a[:-1] << np.uint32(10) | a[1:]
    two = two[(a[:-1] > 0) | (a[1:] > 0)] | np.uint32(1 << 30)
    three = (a[:-2] << np.uint32(20) | a[1:-1] << np.uint32(10) | a[2:])[a[1:-1] > 0] | np.uint32(1 << 31)
    codes = np.concatenate([one, two, three])
    codes.sort()
    if not len(codes):
        return codes, np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[starts], np.diff(np.append(starts, len(codes)))


def profile(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The ``size`` most frequent codes in order; ties to the smaller code."""
    return codes[np.lexsort((codes, -counts))[:size]]


class Profiles:
    """Languages with the ranks of their n-grams, for lookup."""

    def __init__(self, ranked: dict[str, list[int]], size: int = PROFILE):
        self.languages, self.size = sorted(ranked), size
        self.codes = np.unique(np.array([c for codes in ranked.values() for c in codes], dtype=np.uint32))
        self.ranks = np.full((len(self.codes) + 1, len(self.languages)), -1, dtype=np.int32)
        for j, name in enumerate(self.languages):
            self.ranks[np.searchsorted(self.codes, np.array(ranked[name], np.uint32)), j] = np.arange(len(ranked[name]))

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Sum of rank differences for each language; an n-gram that a language lacks costs ``size``."""
        at = np.searchsorted(self.codes, own)
        known = (at < len(self.codes)) & (self.codes[np.minimum(at, len(self.codes) - 1)] == own) if len(self.codes) else np.zeros(len(own), bool)
        ranks = self.ranks[np.where(known, at, len(self.codes))]
        out = np.abs(ranks - np.arange(len(own), dtype=np.int32)[:, None])
        return np.where(ranks < 0, self.size, np.minimum(out, self.size)).sum(axis=0)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score; the score is 1 for equal ranks and 0 for nothing in common."""
        own = profile(*ngrams(text), self.size)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        d = self.distances(own)
        best = int(np.argmin(d))  # ties to the first by name
        return self.languages[best], float(1.0 - d[best] / (self.size * len(own)))


def hash_bound(n: int, wanted: int) -> int:
    """Bound on 63-bit hashes below which about ``wanted`` of ``n`` documents lie; exact integers, so that it
    holds at any size."""
    return min(2**63 - 1, max(1, (wanted << 63) // n))


def fit_profiles(docs: DataFrame, size: int = PROFILE, sample_docs: int = SAMPLE_DOCS, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Profiles:
    """Profiles from about ``sample_docs`` labelled documents of each language (all, if fewer).

    The sample is chosen by a hash of the id against each language's share, so it is the same on every
    run; rows with a null text or language are not learned from. Counts are summed in the tasks first;
    the driver gets ``size`` rows for each language.
    """
    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.shiftrightunsigned(F.xxhash64(F.col(id_col)), 1).alias("h")
    )
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Profiles({}, size)
    chosen = F.lit(False)
    for lang, n in sorted(counts.items()):
        chosen = chosen | ((F.col("lang") == lang) & (F.col("h") <= hash_bound(n, sample_docs)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes, n = ngrams(text)
                if lang in total:
                    codes, n = np.concatenate([total[lang][0], codes]), np.concatenate([total[lang][1], n])
                    codes, inverse = np.unique(codes, return_inverse=True)
                    n = np.bincount(inverse, weights=n).astype(np.int64)
                total[lang] = (codes, n)
        for lang, (codes, n) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(n)], names=["lang", "code", "n"]
            )

    counted = rows.where(chosen).select("lang", "text").mapInArrow(count, "lang string, code long, n long")
    summed = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top = summed.withColumn("rank", rank).where(F.col("rank") <= size).collect()
    ranked: dict[str, list[int]] = {}
    for r in sorted(top, key=lambda r: (r["lang"], r["rank"])):
        ranked.setdefault(r["lang"], []).append(r["code"])
    return Profiles(ranked, size)


def predict_language(docs: DataFrame, profiles: Profiles, text_col: str = "text", lang: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """``docs`` plus the predicted language and its score (0 to 1), from the text alone.

    Null texts and texts without a letter are ``und`` with score 0, and so is every text if no profile
    was learned. Equal distances go to the language first by name. Equal texts get equal answers;
    other columns pass through (columns of the added names are replaced). Empty in, empty out.
    """

    @F.pandas_udf("lang string, score double")
    def predict(texts):
        import pandas as pd

        return pd.DataFrame([profiles.predict(t) for t in texts], columns=["lang", "score"])

    named = boxed(docs).withColumn("found", predict(field(text_col)))
    return unboxed(named, docs.columns, {lang: F.col("found")["lang"], score: F.col("found")["score"]})


def held_out(id_col: Column) -> Column:
    """True for the fifth of ids kept for testing: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0
