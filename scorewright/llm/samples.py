"""A bounded sample of examples for fitting a model, cut in the tasks, and digests of spans."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from scorewright.session import stage


def sample_examples(
    docs: DataFrame,
    cut: Callable[[str], Iterator[tuple[bool, object]]],
    sample_docs: int,
    limit: int,
    share: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> list:
    """At most ``limit`` examples of at most ``sample_docs`` documents, the same on every run.

    The documents are those whose ids have the smallest hashes (each id once, null ids never). ``cut`` runs
    in the tasks and gives (labelled, example) of a whole text, examples being small and of bounded
    size; a document gives its first ``share`` labelled and ``share`` other ones at most, all rows of one id together.
    Half of ``limit`` is kept for labelled examples (all of it, if there are no others). Only ids, and the
    chosen examples, come to the driver.
    """
    keyed = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids = keyed.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    chosen = keyed.where(F.col("id").isin([r[0] for r in ids.collect()]) & F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for order, row, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                kept: dict[bool, list] = {True: [], False: []}
                for labelled, example in cut(text):
                    if len(kept[labelled]) < share:
                        kept[labelled].append(pickle.dumps(example))
                    if len(kept[True]) >= share and len(kept[False]) >= share:
                        break
                rows = [(order, row, labelled, i, e) for labelled, some in kept.items() for i, e in enumerate(some)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["h", "row", "labelled", "i", "example"])

    cuts = chosen.select(F.xxhash64("id").alias("h"), F.xxhash64("text").alias("row"), "text").mapInArrow(
        run, "h long, row long, labelled boolean, i long, example binary"
    )
    place = F.row_number().over(W.partitionBy("h", "labelled").orderBy("row", "i", "example"))
    cuts = stage(cuts.withColumn("n", place).where(F.col("n") <= share))
    order = ["n", "h", "row", "example"]  # the first examples of all documents come before the second ones
    some = {k: cuts.where(F.col("labelled") == k).orderBy(*order).limit(limit).select("example", "h", "n").collect() for k in (True, False)}
    some[True] = some[True][: max(limit // 2, limit - len(some[False]))]
    every = some[True] + some[False][: limit - len(some[True])]
    return [pickle.loads(r["example"]) for r in sorted(every, key=lambda r: (r["h"], r["n"]))]


def first_examples(texts: Iterable[str], cut: Callable[[str], Iterator[tuple[bool, object]]], limit: int) -> list:
    """The first ``limit`` examples of texts at hand."""
    return [example for _, example in islice((e for t in texts for e in cut(t)), limit)]


def written(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def digest(spans: Iterable[tuple[str, int, int]]) -> str:
    return hashlib.sha256(written(spans).encode()).hexdigest()


def free(spans: list[tuple[str, int, int]], taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans that overlap none of ``taken``."""
    if not spans or not taken:
        return spans
    import bisect

    cover: list[list[int]] = []
    for _, a, b in sorted(taken, key=lambda s: s[1]):
        if cover and a <= cover[-1][1]:
            cover[-1][1] = max(cover[-1][1], b)
        else:
            cover.append([a, b])
    starts = [c[0] for c in cover]

    def clear(a: int, b: int) -> bool:
        i = bisect.bisect_left(starts, b) - 1
        return i < 0 or cover[i][1] <= a

    return [s for s in spans if clear(s[1], s[2])]
