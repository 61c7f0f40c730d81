"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation.

Candidates and queries are dealt into blocks of bounded size; each pair of blocks meets once, in one
task. There the candidate block becomes postings (term -> places, weights), and every query row
scatters its weighted postings into a dense score array over the block. A partition selection keeps
the block's k best, and a window merges the blocks' lists.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

QUERIES_PER_BLOCK = 512
CANDIDATES_PER_BLOCK = 1024


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = 1024) -> DataFrame:
    """(id, v): floor(scale * component) as longs; rows without an id or with a null or non-finite
    component, and null vectors, are left out."""
    x = F.col(vec_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v")
    )


def _sparse(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, and (place, term, weight) of the components that are not zero."""
    v = table.column("v").combine_chunks()
    v = v.chunk(0) if isinstance(v, pa.ChunkedArray) else v
    ids = table.column("id").to_numpy()
    lengths = np.asarray(v.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = v.flatten().to_numpy(zero_copy_only=False)
    place = np.repeat(np.arange(len(ids)), lengths)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    hit = flat != 0
    return ids, place[hit], term[hit], flat[hit].astype(np.int64)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id, in order."""
    if len(scores) > k:
        least = scores[np.argpartition(-scores, k - 1)[k - 1]]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def block_search(k: int):
    """Cogrouped function: a block of candidates and one of queries to each query's k best."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out = ([], [], [])
        if candidates.num_rows and queries.num_rows:
            ids, place, term, weight = _sparse(candidates)
            order = np.argsort(term, kind="stable")
            place, term, weight = place[order], term[order], weight[order]
            starts = np.searchsorted(term, np.arange((term[-1] if len(term) else -1) + 2))
            qids, qplace, qterm, qweight = _sparse(queries)
            bounds = np.searchsorted(qplace, np.arange(len(qids) + 1))
            for q, qid in enumerate(qids):
                scores = np.zeros(len(ids), dtype=np.int64)
                for t, w in zip(qterm[bounds[q] : bounds[q + 1]], qweight[bounds[q] : bounds[q + 1]]):
                    if t + 1 < len(starts):
                        at = slice(starts[t], starts[t + 1])
                        scores[place[at]] += w * weight[at]  # a place is once in a posting list
                others = np.flatnonzero(ids != qid)
                best = others[best_of(scores[others], ids[others], k)]
                out[0].append(np.full(len(best), qid))
                out[1].append(ids[best])
                out[2].append(scores[best])
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return search


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row for which ``is_query`` holds.

    Score: integer inner product of the scaled, floored vectors; shorter vectors count as padded
    with zeros (products and sums are 64-bit). Ties go to the smaller vec_id. Fewer than k candidates:
    all of them. Null ids, null vectors and vectors with null or non-finite components take no part.
    Repeated ids: each row is a candidate (never of its own id); as a query an id counts once, with
    its smallest vector. Empty tables and query sets give an empty table; other columns are not read.
    """
    rows = integer_vectors(vectors, id_col, vec_col, scale)
    queries = integer_vectors(vectors.where(is_query), id_col, vec_col, scale).groupBy("id").agg(F.min("v").alias("v"))
    n_q = max(1, -(-queries.count() // QUERIES_PER_BLOCK))
    n_c = max(1, -(-rows.count() // CANDIDATES_PER_BLOCK))
    dealt = rows.withColumn("c", (F.monotonically_increasing_id() % n_c).cast("int"))
    asked = queries.withColumn("q", F.pmod(F.xxhash64("id"), F.lit(n_q)).cast("int"))
    left = dealt.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)))).groupBy("c", "q")
    right = asked.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1)))).groupBy("c", "q")
    found = left.cogroup(right).applyInArrow(block_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
