"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation.

1. Every whole text gives its set of word shingles, a fingerprint of the set and a MinHash signature.
   Documents of equal sets form one class, so exact copies never meet again.
2. Classes that agree on a band of the signature share a bucket. Buckets are never expanded into all
   pairs: every member meets the bucket-mate that has most mates over all bands, and the links so
   found make components. Where a bucket still lies in several, rounds follow: a pack of its members
   outside the main component meets all its members, a few hundred in one row. In the first round each
   of the pack seeks a link through its best mate; in the later ones all its possible mates are
   verified and it leaves the bucket. A bucket is done when its members lie in one component or all
   outside the main one have left.
3. A pair's signatures are compared in batches; a pair is given up as soon as the posterior
   probability of a similarity at the threshold or above falls below the batch's share of the chosen miss
   probability.
4. Survivors are confirmed on the full shingle sets of their texts, which classes in buckets keep.
5. Links become components by alternating star contractions over written tables.

What is compared is exact; a link is lost only if no band agrees, (1 - s^rows)^bands at similarity s, or in
one of the batches (3.0e-6 and, over all batches, 7.7e-6 at 0.8; lower above).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from scorewright.llm.base import boxed, field, unboxed
from scorewright.session import stage

BANDS, ROWS = 32, 5
#: The bands take the first hash functions of the signature; all of them serve verification.
HASHES = 448
BATCH = 32
MISS = 1e-5
#: Pivots of a bucket in the first rounds; four times as many in each later one, up to the second figure.
PIVOTS, MOST_PIVOTS = 1024, 4096
CHUNK = 256
#: Members of a bucket, about, that meet a pack in one row.
MATES = 256

_draw = np.random.default_rng(20_240_229)
MULTIPLIERS = _draw.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACES = _draw.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text: A-Z lower-cased, words parted by
    ASCII blanks. Fewer words than a shingle: one shingle of them all. No word: an empty set."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    width = min(words, len(parts))
    out = np.full(len(parts) - width + 1, np.uint64(width))
    for j in range(width):
        out += hashes[j : len(parts) - width + 1 + j] * PLACES[j]
    return np.unique(_mixed(out))


def signature(shingles: np.ndarray) -> np.ndarray:
    """8 bits of the smallest of each of the hash functions over the set: unequal ones agree once in 256
    times, which keeps pairs a little longer and never drops one."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), CHUNK):
        np.minimum(least, (shingles[i : i + CHUNK, None] * MULTIPLIERS).min(axis=0), out=least)
    return (least >> np.uint64(16)).astype(np.uint8)


@lru_cache
def least_matches(threshold: int, miss: float = MISS) -> tuple[int, ...]:
    """For each batch end, the fewest matches with which P(similarity >= threshold %) is ``miss`` over the number
    of batches, or more: the losses of the batches add up.

    The prior is uniform, so after m matches in n the posterior is Beta(m + 1, n - m + 1), whose upper
    tail at t is the probability of at most m successes in n + 1 draws of chance t.
    """
    t, out = threshold / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss * BATCH / HASHES:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def may_link(left: np.ndarray, right: np.ndarray, threshold: int) -> np.ndarray:
    """Which pairs of signatures (rows) survive all batches."""
    every, out = np.arange(len(left)), np.zeros(len(left), bool)
    out[_alive(left, every, right, every, threshold)] = True
    return out


def _alive(left: np.ndarray, i: np.ndarray, right: np.ndarray, j: np.ndarray, threshold: int) -> np.ndarray:
    """Places of the pairs (left[i], right[j]) that survive all batches."""
    alive, matches = np.arange(len(i)), np.zeros(len(i), np.int64)
    for k, least in enumerate(least_matches(threshold)):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches += (left[:, part][i[alive]] == right[:, part][j[alive]]).sum(axis=1)
        more = matches >= least
        alive, matches = alive[more], matches[more]
    return alive


def similar(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """100 * |a & b| >= threshold * |a | b|, for sorted distinct arrays that aren't both empty."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= threshold * (len(a) + len(b) - both) > 0


def describe(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, fp, sig) of rows (doc_id, text); fp is null for an empty set."""

    @F.pandas_udf("n long, fp binary, sig binary")
    def facts(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            s = shingle_set(text, words)
            rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None, signature(s).tobytes() if len(s) else None))
        return pd.DataFrame(rows, columns=["n", "fp", "sig"])

    return docs.withColumn("f", facts("text")).select("doc_id", "f.n", "f.fp", "f.sig")


def _bands(sig: Column) -> Column:
    """The band's number and its bucket, for each band."""
    return F.array(
        *[F.struct(F.lit(b).alias("band"), F.xxhash64(F.lit(b), F.substring(sig, b * ROWS + 1, ROWS)).alias("bucket")) for b in range(BANDS)]
    )


def _sizes_allow(n: Column, m: Column, threshold: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * threshold


def contract(edges: DataFrame) -> DataFrame:
    """(node, root) of every node but the roots, from edges (a, b); alternating star contractions.

    Each step joins the edges with the smallest neighbour of each node, found from partial minima, and
    is written to the shared folder; it ends when only stars are left.
    """
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")))
        low = F.least("a", "m")
        large = both.join(least, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("a"), low.alias("b"))
        large = stage(large.distinct())
        least = stage(large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")))
        small = large.join(least, F.col("a") == F.col("u")).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = stage(small.where("a <> b").distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _stars(edges: DataFrame) -> bool:
    """Whether every left end has one edge, to a node that is no left end."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        edges.select(F.col("b").alias("x"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    sums = ends.groupBy("x").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    return sums.where("l > 1 OR (l > 0 AND r > 0)").isEmpty()


def _survivors(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) whose signatures pass the batches."""
    sigs = classes.select("cid", "sig")
    joined = pairs.join(sigs.select(F.col("cid").alias("a"), F.col("sig").alias("sa")), "a").join(
        sigs.select(F.col("cid").alias("b"), F.col("sig").alias("sb")), "b"
    )

    @F.pandas_udf("boolean")
    def passes(left: pd.Series, right: pd.Series) -> pd.Series:
        as_rows = lambda s: np.frombuffer(b"".join(s), np.uint8).reshape(len(s), HASHES)
        return pd.Series(may_link(as_rows(left), as_rows(right), threshold))

    return joined.where(passes("sa", "sb")).select("a", "b")


class _Side:
    """One side's classes of a batch of meetings: a list of structs (cid, n, comp, sig) in each row."""

    def __init__(self, lists: pa.ListArray):
        self.ends, one = lists.offsets.to_numpy(), lists.values
        self.ids, self.sizes, self.comps = (one.field(k).to_numpy() for k in ("cid", "n", "comp"))
        self.sigs = np.frombuffer(one.field("sig").buffers()[2], np.uint8)[: len(one) * HASHES].reshape(-1, HASHES)
        codes = np.zeros((len(one), BANDS, 8), np.uint8)
        codes[:, :, :ROWS] = self.sigs[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
        self.bands = codes.view(np.uint64)[:, :, 0]


def _against_packs(current: DataFrame, packs: DataFrame, classes: DataFrame, threshold: int, best_only: bool) -> DataFrame:
    """Pairs (a, b, k) of a bucket's members and the pivots in its pack, of other components, whose
    signatures pass the batches; k is how many hashes agree.

    Slices of a bucket's members, parted by a hash, meet the whole pack in one row each, so that no
    bucket is a hot key. Only survivors become rows: of a pair only at the first band that it shares,
    and with ``best_only`` of a pivot only its best pair in each batch of rows.
    """
    part = F.pmod(F.xxhash64("cid", F.lit("mates")), F.col("parts")).alias("part")
    mates = current.join(classes.select("cid", "sig"), "cid").groupBy("bucket", part)
    mates = mates.agg(F.min("band").alias("band"), F.collect_list(F.struct("cid", "n", "comp", "sig")).alias("mates"))
    packs = packs.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    meetings = mates.join(packs.hint("merge"), ["bucket", "part"]).select("band", "mates", "pack")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            mates, pivots = _Side(batch.column(1)), _Side(batch.column(2))
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for row, band in enumerate(batch.column(0).to_pylist()):
                of = slice(*mates.ends[row : row + 2])
                for at in range(pivots.ends[row], pivots.ends[row + 1], CHUNK):
                    to = slice(at, min(at + CHUNK, pivots.ends[row + 1]))
                    n, m = pivots.sizes[to, None], mates.sizes[of]
                    fits = np.minimum(n, m) * 100 >= np.maximum(n, m) * threshold
                    i, j = np.nonzero(fits & (pivots.comps[to, None] != mates.comps[of]))
                    i, j = i + at, j + of.start
                    first = ~(pivots.bands[:, :band][i] == mates.bands[:, :band][j]).any(axis=1)
                    i, j = i[first], j[first]
                    alive = _alive(pivots.sigs, i, mates.sigs, j, threshold)
                    i, j = i[alive], j[alive]
                    if len(i):
                        out.append((pivots.ids[i], mates.ids[j], (pivots.sigs[i] == mates.sigs[j]).sum(axis=1)))
            if out:
                pivot, member, k = (np.concatenate(c) for c in zip(*out))
                if best_only:
                    order = np.lexsort((member, -k, pivot))
                    order = order[np.concatenate([[True], np.diff(pivot[order]) != 0])]
                    pivot, member, k = pivot[order], member[order], k[order]
                yield pa.RecordBatch.from_arrays([pa.array(pivot), pa.array(member), pa.array(k.astype(np.int64))], names=["a", "b", "k"])

    return meetings.mapInArrow(compare, "a long, b long, k long")


def _sets(rows: DataFrame, heads: DataFrame, words: int) -> DataFrame:
    """(cid, shingles) of the classes ``heads``: the sorted 64-bit hashes of the text's whole set."""

    @F.pandas_udf("binary")
    def hashed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: shingle_set(text, words).tobytes())

    return rows.join(heads.hint("merge"), F.col("doc_id") == F.col("cid")).select("cid", hashed("text").alias("shingles"))


def _links(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) confirmed on their full sets."""
    joined = pairs.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb")), "b"
    )

    @F.pandas_udf("boolean")
    def confirmed(left: pd.Series, right: pd.Series) -> pd.Series:
        as_set = lambda x: np.frombuffer(x, np.uint64)
        return pd.Series([similar(as_set(x), as_set(y), threshold) for x, y in zip(left, right)], dtype=bool)

    return joined.where(confirmed("sa", "sb")).select("a", "b")


def _members(classes: DataFrame) -> DataFrame:
    """(band, bucket, cid, n, degree) of the buckets that two or more classes share; degree: how many
    bucket-mates a class has over all bands, which is highest for what the others are copies of."""
    banded = classes.select("cid", "n", F.explode(_bands(F.col("sig"))).alias("x")).select("cid", "n", "x.*")
    shared = stage(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).where("k > 1"))
    own = banded.join(shared, "bucket").groupBy("cid", "n").agg(
        F.collect_list(F.struct("band", "bucket")).alias("buckets"), F.sum("k").alias("degree")
    )  # at most one row for each band
    return stage(own.select(F.explode("buckets").alias("x"), "cid", "n", "degree").select("x.*", "cid", "n", "degree"))


def _first_pairs(members: DataFrame, threshold: int) -> DataFrame:
    """Each member with the pivot it meets in most bands; a bucket's pivot has its highest degree."""
    best = F.max(F.struct("degree", (-F.col("cid")).alias("least"), "n")).alias("p")
    pivots = members.groupBy("bucket").agg(best)
    pivots = stage(pivots.select("bucket", (-F.col("p.least")).alias("a"), F.col("p.n").alias("m"), F.col("p.degree").alias("d")))
    met = (
        members.join(pivots, "bucket")
        .where((F.col("cid") != F.col("a")) & _sizes_allow(F.col("n"), F.col("m"), threshold))
        .groupBy(F.col("cid").alias("b"), "a", "d")
        .agg(F.count(F.lit(1)).alias("k"))
    )
    return met.groupBy("b").agg(F.max_by("a", F.struct("k", "d", -F.col("a"))).alias("a")).select("a", "b")


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that lie in two or more components, with their component, the bucket's
    main one, that of its member of highest degree, and the number of its slices of members."""
    named = members.join(roots, F.col("cid") == F.col("node"), "left")
    named = stage(named.select("band", "bucket", "cid", "n", "degree", F.coalesce("root", "cid").alias("comp")))
    buckets = named.groupBy("bucket").agg(
        F.max(F.struct("degree", "cid", "comp")).alias("m"), F.min("comp").alias("low"), F.max("comp").alias("high"),
        F.count(F.lit(1)).alias("k"),
    )
    buckets = stage(buckets.where("low <> high").select("bucket", F.col("m.comp").alias("main"), F.ceil(F.col("k") / MATES).alias("parts")))
    return stage(named.join(buckets, "bucket"))


def _packs(current: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """(bucket, parts, pack): up to ``size`` members outside the bucket's main component, the highest degree
    of each slice of a hash."""
    best = F.max(F.struct("degree", "cid", "n", "comp")).alias("p")
    picked = current.where("comp <> main").groupBy("bucket", "parts", F.pmod(F.xxhash64("cid"), F.lit(size)).alias("g")).agg(best)
    picked = picked.select("bucket", "parts", "p.cid", "p.n", "p.comp").join(classes.select("cid", "sig"), "cid")
    return picked.groupBy("bucket", "parts").agg(F.collect_list(F.struct("cid", "n", "comp", "sig")).alias("pack"))


def components(docs: DataFrame, shingle_words: int, threshold: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Rows are linked if their shingle sets have a Jaccard similarity of ``threshold`` % or more.
    component_id is the smallest id reachable; kept says that it is the row's own.

    Null, empty and blank texts have an empty set and are linked with nothing. A null id is linked
    with nothing either (component null, kept true). Of equal sets the smallest id stands for all. Rows
    that share an id are linked by their own texts, but two sets with the same smallest id are one. An
    empty table gives an empty table; no other column is read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    described = stage(describe(rows, shingle_words))
    known = described.where(F.col("fp").isNotNull() & F.col("doc_id").isNotNull())
    classes = stage(known.groupBy("fp").agg(F.min("doc_id").alias("cid"), F.min_by("n", "doc_id").alias("n"), F.min_by("sig", "doc_id").alias("sig")))
    members = _members(classes)
    heads = members.select("cid").distinct()
    sets = stage(_sets(rows, heads, shingle_words))
    pairs = stage(_first_pairs(members, threshold))
    tested = stage(_survivors(pairs, classes, threshold))
    roots = contract(_links(tested, sets, threshold))
    tested = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    size, seeking = PIVOTS, True
    while True:
        current = _open(members, roots)
        if current.isEmpty():
            break
        packs = stage(_packs(current, classes, size))
        met = _against_packs(current, packs, classes, threshold, seeking)
        if seeking:
            met = met.groupBy("a").agg(F.max_by("b", F.struct("k", -F.col("b"))).alias("b"))
        met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        new = stage(met.join(tested, ["a", "b"], "left_anti"))
        found = stage(_links(new, sets, threshold))
        tested = tested.unionByName(new)
        if not found.isEmpty():
            roots = contract(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found))
        members = current.select("band", "bucket", "cid", "n", "degree")
        if not seeking:
            used = packs.select("bucket", F.explode("pack.cid").alias("cid"))
            members = members.join(used, ["bucket", "cid"], "left_anti")
            size = min(4 * size, MOST_PIVOTS)
        seeking = False
    whole = classes.join(roots, F.col("cid") == F.col("node"), "left").select("fp", F.coalesce("root", "cid").alias("root"))
    return (
        described.select("doc_id", "n", "fp")
        .join(stage(whole), "fp", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
    )


def keep_one(docs: DataFrame, shingle_words: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose component has a smaller id; rows repeating a kept id stay."""
    gone = components(docs, shingle_words, threshold, id_col, text_col).where(~F.col("kept")).select(F.col("doc_id").alias("gone"))
    return unboxed(boxed(docs).join(gone, field(id_col).cast("long") == F.col("gone"), "left_anti"), docs.columns)
