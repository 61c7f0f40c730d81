"""Local surrogates: a weighted ridge model of any predictor around a row, on discretised features.

A background table gives each feature's quartile bins with their shares, means and deviations. Around a row
samples are drawn bin by bin from these shares, and inside a bin from its truncated normal; the model
is fitted on whether a sample lies in the row's own bins, near samples weighing more. Draws are hashes
of row, sample and feature, so nothing is stored: one pass draws the samples of a block of rows, the predictor
scores each sample as a row of its own in generated code, and a second pass takes the scores in their order and solves
the rows' small systems together. The block's rows travel beside its first sample. Rows are
never shuffled or grouped, and rows sharing a key are explained each by itself.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from scorewright.functions.columns import key_text
from scorewright.operators.ordered import long_form, quantiles

# Surrogate defaults.
TOP_LOCAL = 8
SAMPLES = 5000
KERNEL_FACTOR = 0.75
RIDGE = 1.0
CHOICE_RIDGE = 0.01
#: Up to so many features are chosen one after another; more by the size of their weights.
FORWARD = 6
#: Values that are drawn for one block of rows.
BLOCK_VALUES = 100_000
#: Samples that are scored in one row of Spark.
STRETCH = 100
#: Values of a feature that are drawn at once.
SLICE_VALUES = 20_000
#: Up to so many features a row's samples are summed by which of its bins they share.
PATTERN_FEATURES = 8
TINY = 1e-11


@dataclass(frozen=True)
class Background:
    """Of each feature: inner bin edges, and of each bin its share, mean, deviation, least and largest value."""

    features: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    shares: tuple[tuple[float, ...], ...]
    means: tuple[tuple[float, ...], ...]
    stds: tuple[tuple[float, ...], ...]
    lows: tuple[tuple[float, ...], ...]
    highs: tuple[tuple[float, ...], ...]


def fit_background(df: DataFrame, features: Sequence[str]) -> Background:
    """Exact quartiles and the statistics between them; four rows for each feature come to the driver.

    Nulls and NaN are no values. A feature without any value has one bin, at 0.
    """
    features = list(features)
    cuts = {r["feature"]: r for r in quantiles(df, features, (0.25, 0.5, 0.75)).collect()}
    edges = {c: sorted({float(x) for x in list(cuts[c])[1:]}) if c in cuts else [] for c in features}
    long = long_form(df, features).where("value IS NOT NULL AND NOT isnan(value)")
    bin_of = F.lit(0)
    for c in features:
        bin_of = bin_of + F.when(F.col("feature") == c, sum((F.when(F.col("value") > e, 1).otherwise(0) for e in edges[c]), F.lit(0))).otherwise(0)
    stats = long.groupBy("feature", bin_of.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("m"), F.stddev_pop("value").alias("s"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    rows = {(r["feature"], r["bin"]): r for r in stats.collect()}
    out: dict[str, list] = {k: [] for k in ("edges", "shares", "means", "stds", "lows", "highs")}
    for c in features:
        own = [rows.get((c, b)) for b in range(len(edges[c]) + 1)]
        n = sum(r["n"] for r in own if r)
        seen = [r for r in own if r]
        least, most = (min(r["lo"] for r in seen), max(r["hi"] for r in seen)) if seen else (0.0, 0.0)
        out["edges"].append(tuple(edges[c]))
        out["shares"].append(tuple(r["n"] / n if r else 0.0 for r in own) if n else (1.0,))
        out["means"].append(tuple(float(r["m"]) if r else 0.0 for r in own))
        out["stds"].append(tuple((float(r["s"]) if r else 0.0) + TINY for r in own))
        out["lows"].append((float(least), *edges[c]))
        out["highs"].append((*edges[c], float(most)))
    return Background(tuple(features), **{k: tuple(v) for k, v in out.items()})


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: well spread 64-bit words from counters."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=64)
def _counters(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def starts(rows: Sequence[int], feature: str) -> np.ndarray:
    """Where the rows' words begin, from row hash and feature name."""
    with np.errstate(over="ignore"):
        return mixed(np.asarray(rows, np.int64).astype(np.uint64) ^ np.uint64(zlib.crc32(feature.encode())))


def words(start: np.ndarray, n: int, out: np.ndarray | None = None, other: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Two 32-bit words for each of n samples of some rows, from where they begin and the sample's number.

    They are the halves of one array, which is made in ``out`` with the help of ``other`` if these are given.
    """
    bits = np.add.outer(start, _counters(n), out=out)
    # ``mixed`` in place.
    other = np.right_shift(bits, np.uint64(30), out=other)
    for factor, shift in ((np.uint64(0xBF58476D1CE4E5B9), np.uint64(27)), (np.uint64(0x94D049BB133111EB), np.uint64(31))):
        bits ^= other
        bits *= factor
        np.right_shift(bits, shift, out=other)
    bits ^= other
    halves = bits.astype("<u8", copy=False).view("<u4")
    return halves[..., ::2], halves[..., 1::2]


def uniforms(row: int, n: int, feature: str) -> tuple[np.ndarray, np.ndarray]:
    """The words as draws in (0, 1)."""
    u, v = ((w[0].astype(float) + 0.5) / 2.0**32 for w in words(starts([row], feature), n))
    return u, v


#: Steps of the table of normal quantiles.
STEPS = 2**15


@lru_cache(maxsize=1)
def _normal_table() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the standard normal at the middles of equal steps of probability, and their differences."""
    q = np.array([NormalDist().inv_cdf(x) for x in (np.arange(STEPS) + 0.5) / STEPS])
    return q, np.append(np.diff(q), 0.0)


def _cdf(z: float) -> float:
    return 0.5 * (1.0 + math.erf(z / math.sqrt(2.0)))


@lru_cache(maxsize=1024)
def _bin_tables(background: Background, j: int) -> tuple[np.ndarray, ...]:
    """Of a feature's bins: upper ends of their shares, then place in the normal table and width by word, deviation,
    mean, bounds."""
    shares, m, s, lo, hi = (np.array(getattr(background, k)[j], float) for k in ("shares", "means", "stds", "lows", "highs"))
    a, z = (np.array([_cdf(x) for x in (end - m) / s]) for end in (lo, hi))
    width = (z - a) * (STEPS / 2.0**32)
    return np.cumsum(shares)[:-1], a * STEPS + 0.5 + 0.5 * width, width, s, m, lo, hi


@lru_cache(maxsize=1)
def _ended_table() -> tuple[np.ndarray, np.ndarray]:
    """The normal table with its ends repeated, so that no place need be cut to it."""
    q, step = _normal_table()
    return np.concatenate([q[:1], q, q[-1:]]), np.concatenate([[0.0], step, [0.0]])


def bins_of(background: Background, j: int, u: np.ndarray) -> np.ndarray:
    return np.searchsorted(_bin_tables(background, j)[0], u, side="right")


@lru_cache(maxsize=1024)
def _word_ends(background: Background, j: int) -> tuple[int, ...]:
    """Least words of the bins but the first: ``bins_of`` of (word + 0.5) / 2**32 counts the ends up to the word."""
    return tuple(math.ceil(Fraction(float(c)) * 2**32 - Fraction(1, 2)) for c in _bin_tables(background, j)[0])


def _bins_of_words(background: Background, j: int, u: np.ndarray, bins: np.ndarray) -> None:
    """``bins_of`` for words, into ``bins``."""
    u = np.ascontiguousarray(u)
    bins[...] = 0
    for end in _word_ends(background, j):
        if end < 2**32:
            bins += (u >= np.uint32(max(end, 0))).view(np.uint8)


def own_bin(background: Background, j: int, value: float | None) -> int:
    """Bin of a value; a missing one has none."""
    return -1 if value is None or math.isnan(value) else int(np.searchsorted(background.edges[j], value))


def draw_block(background: Background, rows: Sequence[int], values: Sequence[Sequence[float | None]], n: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each feature (values, in the rows' own bins) of n samples a row, both rows x n; ``values`` are by feature.
    The first sample of a row is the row itself."""
    r = len(rows)
    drawn, same = [np.empty((r, n)) for _ in values], [np.empty((r, n), bool) for _ in values]
    slice_rows = max(1, SLICE_VALUES // n)
    # Steps of a slice stay in the processor's cache; their arrays are used again.
    whole = np.empty((2, slice_rows, n), np.uint64)
    index, number = np.empty((slice_rows, n), np.intp), np.empty((slice_rows, n))
    q, step = _ended_table()
    for j, (c, own) in enumerate(zip(background.features, values)):
        start = starts(rows, c)
        places, widths, *shape = _bin_tables(background, j)[1:]
        few = np.empty((slice_rows, n), np.min_scalar_type(len(places)))
        mine = np.array([own_bin(background, j, x) for x in own])[:, None]
        mine = np.where(mine < 0, len(places), mine).astype(few.dtype)  # a missing value shares no bin
        for i in range(0, r, slice_rows):
            at, shared = drawn[j][i : i + slice_rows], same[j][i : i + slice_rows]
            m = len(at)
            u, v = words(start[i : i + m], n, whole[0, :m], whole[1, :m])
            bins, k, t = few[:m], index[:m], number[:m]
            _bins_of_words(background, j, u, bins)
            np.equal(bins, mine[i : i + m], out=shared)
            np.copyto(k, bins)
            np.copyto(at, v)
            at *= widths.take(k, out=t, mode="clip")
            at += places.take(k, out=t, mode="clip")
            np.copyto(k, at, casting="unsafe")
            np.copyto(t, k)
            at -= t
            at *= step.take(k, out=t, mode="clip")
            at += q.take(k, out=t, mode="clip")
            np.copyto(k, bins)
            for act, table in zip((np.multiply, np.add, np.maximum, np.minimum), shape):
                act(at, table.take(k, out=t, mode="clip"), out=at)
        drawn[j][:, 0] = [np.nan if x is None else x for x in own]
        same[j][:, 0] = ~np.isnan(drawn[j][:, 0])
    return drawn, same


def draw(background: Background, row: int, values: Sequence[float | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, in the row's own bin) of n samples of one row, both n x features."""
    return tuple(np.stack([x[0] for x in side], axis=1) for side in draw_block(background, [row], [[x] for x in values], n))


def own_bins(background: Background, row: int, values: Sequence[float | None], n: int) -> np.ndarray:
    """The second part of ``draw`` alone."""
    same = np.empty((n, len(values)), bool, order="F")
    for j, (c, x) in enumerate(zip(background.features, values)):
        same[:, j] = bins_of(background, j, uniforms(row, n, c)[0]) == own_bin(background, j, x)
        same[0, j] = x is not None and not math.isnan(x)
    return same


def _weights(d: int) -> np.ndarray:
    """Weight of a sample by the number of own bins it lies in."""
    return np.sqrt(np.exp(-(d - np.arange(d + 1)) / (KERNEL_FACTOR**2 * d)))


def _solve_sums(mean_x: np.ndarray, mean_y: np.ndarray, gram: np.ndarray, rhs: np.ndarray, total: np.ndarray, top: int) -> tuple[np.ndarray, ...]:
    """(intercepts, weights, fits) of many rows from their centred sums; the rows' systems are solved together."""
    r, d = rhs.shape
    each = np.arange(r)[:, None]

    def ridge(chosen: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
        """Weights and share explained with the features that are chosen for each row."""
        part, right = gram[each[:, :, None], chosen[:, :, None], chosen[:, None, :]], rhs[each, chosen]
        k = chosen.shape[1]
        inverse = np.linalg.pinv(part + alpha * np.eye(k), rcond=np.finfo(float).eps * k, hermitian=True)
        beta = (inverse @ right[:, :, None])[:, :, 0]
        left = total - 2 * (beta * right).sum(axis=1) + (beta * (part @ beta[:, :, None])[:, :, 0]).sum(axis=1)
        return beta, np.where(total > 0, 1.0 - left / np.where(total > 0, total, 1.0), 1.0)

    count = min(top, d)
    if count == d:
        chosen = np.tile(np.arange(d), (r, 1))
    elif count <= FORWARD:
        chosen = np.empty((r, 0), np.intp)
        for _ in range(count):
            gains = np.full((r, d), -np.inf)
            for j in range(d):
                rest = ~(chosen == j).any(axis=1)
                gains[rest, j] = ridge(np.column_stack([chosen, np.full(r, j)]), 0.0)[1][rest]
            chosen = np.column_stack([chosen, gains.argmax(axis=1)])
    else:
        first = ridge(np.tile(np.arange(d), (r, 1)), CHOICE_RIDGE)[0]
        chosen = np.argsort(-np.abs(first), axis=1, kind="stable")[:, :count]
    beta, share = ridge(chosen, RIDGE)
    out = np.full((r, d), np.nan)
    out[each, chosen] = beta
    return mean_y - (mean_x[each, chosen] * beta).sum(axis=1), out, share


def solve(same: np.ndarray, p: np.ndarray, top: int) -> tuple[float, np.ndarray, float]:
    """(intercept, weights, fit): the weighted ridge model of predictions ``p`` on the ``top`` chosen features, NaN
    for the others. Samples without a prediction are left out; fit is the share of variance explained."""
    n, d = same.shape
    w = _weights(d)[same.sum(axis=1)]
    x, y, ok = same.astype(float), p, ~np.isnan(p)
    if not ok.all():
        x, y, w = x[ok], p[ok], w[ok]
    if not len(y):
        return math.nan, np.full(d, np.nan), math.nan
    mean_x, mean_y = (w @ x) / w.sum(), (w @ y) / w.sum()
    xc, yc = x - mean_x, y - mean_y
    sums = mean_x, mean_y, xc.T @ (xc * w[:, None]), xc.T @ (yc * w), w @ (yc * yc)
    intercept, weights, fit = _solve_sums(*[np.asarray(t)[None] for t in sums], top)
    return float(intercept[0]), weights[0], float(fit[0])


def solve_block(codes: np.ndarray, p: np.ndarray, d: int, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``solve`` for many rows (rows x samples): bit j of a code tells whether the sample lies in its row's own bin of feature j."""
    r, n = p.shape
    kinds = 1 << d
    base, counted, sum1, sum2 = np.zeros(r), *np.zeros((3, r, kinds))
    for i, (code, y) in enumerate(zip(codes, p)):
        ok = ~np.isnan(y)
        if not ok.all():
            code, y = code[ok], y[ok]
        if len(y):
            base[i] = y[0]
            y = y - y[0]  # so that sums of squares lose nothing
            counted[i], sum1[i], sum2[i] = (np.bincount(code, t, kinds) for t in (None, y, y * y))
    bits = (np.arange(kinds)[:, None] >> np.arange(d) & 1).astype(float)
    w = _weights(d)[bits.sum(axis=1).astype(int)]
    some = counted.any(axis=1)
    counted, sum1, sum2 = (t[some] * w for t in (counted, sum1, sum2))
    weight = counted.sum(axis=1)
    mean_x, mean_y = counted @ bits / weight[:, None], sum1.sum(axis=1) / weight
    xc = bits - mean_x[:, None, :]
    right = sum1 - counted * mean_y[:, None]
    gram = np.swapaxes(xc, 1, 2) @ (xc * counted[:, :, None])
    total = (sum2 - 2 * mean_y[:, None] * sum1 + mean_y[:, None] ** 2 * counted).sum(axis=1)
    found = _solve_sums(mean_x, mean_y, gram, (xc * right[:, :, None]).sum(axis=1), total, top)
    out = np.full(r, np.nan), np.full((r, d), np.nan), np.full(r, np.nan)
    for t, own in zip(out, found):
        t[some] = own
    out[0][:] += base
    return out


def local_surrogate(
    df: DataFrame,
    predict: Callable[[Mapping[str, Column]], Column],
    features: Sequence[str],
    row_key: Sequence[str],
    n_samples: int = SAMPLES,
    top: int = TOP_LOCAL,
    seed: int = 42,
    background: Background | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Per row of ``df`` the surrogate of ``predict``: rows (row_key, feature, weight, low, high, intercept, fit).

    ``low`` and ``high`` bound the bin in which the row's value lies; a weight tells how the prediction
    changes when the feature is there. ``background`` defaults to the table itself. A missing value
    lies in no bin. ``spread`` deals the rows out to so many tasks first, for tables of few files.
    """
    features = list(features)
    known = background or fit_background(df, features)
    base = df.select(
        *row_key, *[F.col(c).cast("double").alias(f"_x{j}") for j, c in enumerate(features)],
        F.xxhash64(key_text([*row_key, seed])).alias("_row"),
    )
    base = base.repartition(spread) if spread else base
    keys, d = len(row_key), len(features)
    block = max(1, BLOCK_VALUES // (n_samples * d))
    lists = T.StructType.fromDDL(", ".join([f"_z{j} array<double>" for j in range(d)] + ["_rows binary"]))

    def listed(z: np.ndarray) -> pa.Array:
        """Values in lists of ``STRETCH``, the last one filled up with nulls."""
        count = -(-len(z) // STRETCH)
        if len(z) < count * STRETCH:
            z = np.concatenate([z, np.full(count * STRETCH - len(z), np.nan)])
        missing = np.isnan(z)
        values = pa.array(z, mask=missing) if missing.any() else pa.array(z)
        return pa.ListArray.from_arrays(pa.array(np.arange(count + 1, dtype=np.int32) * STRETCH), values)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's samples in stretches, by feature; beside the first, its rows with their samples' shared bins in one message."""
        for whole in batches:
            for i in range(0, whole.num_rows, block):
                batch = whole.slice(i, block)
                drawn, same = draw_block(known, batch.column("_row").to_pylist(), [batch.column(keys + j).to_pylist() for j in range(d)], n_samples)
                packed = np.zeros((batch.num_rows, n_samples, -(-d // 8)), np.uint8)
                for j, shared in enumerate(same):
                    packed[:, :, j // 8] |= shared.view(np.uint8) << np.uint8(j % 8)
                shares = pa.FixedSizeBinaryArray.from_buffers(pa.binary(packed[0].size), batch.num_rows, [None, pa.py_buffer(packed)])
                sent = pa.RecordBatch.from_arrays([*batch.columns, shares], names=[*[f"c{k}" for k in range(batch.num_columns)], "same"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, sent.schema) as stream:
                    stream.write_batch(sent)
                stretches = [listed(z.ravel()) for z in drawn]
                messages = pa.array([sink.getvalue().to_pybytes(), *[None] * (len(stretches[0]) - 1)], pa.binary())
                yield pa.RecordBatch.from_arrays([*stretches, messages], names=[f.name for f in lists])

    # The scores of a stretch are written out one by one: generated code, where a function over an array would be
    # interpreted. The message passes through such a function because it keeps the projection out of whole-stage
    # code, whose one method would grow too long to be compiled; here each score has a method of its own.
    scores = [predict({c: F.get(f"_z{j}", F.lit(k)) for j, c in enumerate(features)}).cast("double") for k in range(STRETCH)]
    message = F.get(F.transform(F.array("_rows"), lambda m: m), F.lit(0))
    scored = base.mapInArrow(sample, lists).select(F.array(*scores).alias("_p"), message.alias("_rows"))

    result = T.StructType.fromDDL("feature string, weight double, low double, high double, intercept double, fit double").fields
    names, kinds = [*base.columns[:keys], *[f.name for f in result]], [pa.string(), *[pa.float64()] * 5]

    def explained(block_rows: pa.RecordBatch, p: np.ndarray) -> pa.RecordBatch:
        r = block_rows.num_rows
        packed = np.frombuffer(b"".join(block_rows.column("same").to_pylist()), np.uint8).reshape(r, n_samples, -1)
        p = p.reshape(r, n_samples)
        if d <= PATTERN_FEATURES:
            intercepts, weights, fits = solve_block(packed[:, :, 0], p, d, top)
        else:
            same = np.unpackbits(packed, axis=2, count=d, bitorder="little").astype(bool)
            intercepts, weights, fits = (np.array(t) for t in zip(*[solve(same[i], p[i], top) for i in range(r)]))
        values = [block_rows.column(keys + j).to_pylist() for j in range(d)]
        found: list[list] = [[] for _ in result]
        take, at = np.nonzero(~np.isnan(weights))
        for i, j in zip(take.tolist(), at.tolist()):
            b = own_bin(known, j, values[j][i])
            bounds = (None, None) if b < 0 else (known.lows[j][b], known.highs[j][b])
            for column, v in zip(found, (features[j], float(weights[i, j]), *bounds, float(intercepts[i]), float(fits[i]))):
                column.append(v)
        own = [block_rows.column(k).take(pa.array(take)) for k in range(keys)]
        return pa.RecordBatch.from_arrays([*own, *[pa.array(c, t) for c, t in zip(found, kinds)]], names=names)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Gathers a block's scores, which arrive in order."""
        rows, parts, have = None, [], 0
        for batch in batches:
            messages, scores = batch.column("_rows"), batch.column("_p").flatten().to_numpy(zero_copy_only=False)
            at = 0
            for k in np.flatnonzero(messages.is_valid()).tolist() + [batch.num_rows]:
                parts.append(scores[at : k * STRETCH])
                have, at = have + k * STRETCH - at, k * STRETCH
                if rows is not None and have >= rows.num_rows * n_samples:
                    yield explained(rows, np.concatenate(parts)[: rows.num_rows * n_samples])
                    rows, parts, have = None, [], 0
                if k < batch.num_rows:
                    if rows is not None or have:
                        raise RuntimeError("a block's scores are not in order")
                    rows = pa.ipc.open_stream(messages[k].as_buffer()).read_next_batch()
        if rows is not None:
            raise RuntimeError("a block's scores are not whole")

    return scored.mapInArrow(fit, T.StructType([*base.schema.fields[:keys], *result]))
