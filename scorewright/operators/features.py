"""Feature state (medians, modes, vocabularies, scaling) fitted once and applied lazily."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from scorewright.functions import columns as C
from scorewright.operators.joins import collect_bounded, lookup_join
from scorewright.operators.ordered import long_form, modes, prefix_sum, quantiles
from scorewright.session import stage

#: Values of a vocabulary that may be written into the projection.
LITERAL_VALUES = 200


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns are imputed, derived, encoded, selected and scaled, in that order."""

    median: Sequence[str] = ()
    mode: Sequence[str] = ()
    derive: Mapping[str, Column] = field(default_factory=dict)
    encode: Sequence[str] = ()
    select: Sequence[str] = ()
    drop: Sequence[str] = ()


@dataclass
class FeatureState:
    """One row per column except ``vocab``, which has one row per category."""

    medians: dict[str, float]
    modes: dict[str, str]
    vocab: DataFrame | None
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)


def fit_impute(df: DataFrame, median: Sequence[str], mode: Sequence[str]) -> tuple[dict, dict]:
    """Exact medians and modes; one row per column comes to the driver."""
    medians = (
        {r["feature"]: r["median"] for r in quantiles(df, median).collect()} if median else {}
    )
    most = {r["feature"]: r["mode"] for r in modes(df, mode).collect()} if mode else {}
    return medians, most


def impute(df: DataFrame, medians: Mapping[str, float], most: Mapping[str, str]) -> DataFrame:
    """Medians for nulls and NaN, modes for nulls."""
    types = dict(df.dtypes)
    fills = {c: F.coalesce(C.null_if_nan(F.col(c).cast("double")), F.lit(v)) for c, v in medians.items()}
    fills |= {c: F.coalesce(c, F.lit(v).cast(types[c])) for c, v in most.items()}
    return df.withColumns(fills) if fills else df


def impute_grouped(df: DataFrame, median: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Fill nulls and NaN with the median of the row's own group."""
    keys = list(keys)
    fits = quantiles(df, median, (0.5,), keys)
    wide = fits.groupBy(*keys).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"_med_{c}") for c in median]
    )
    joined = lookup_join(df, wide, keys, null_safe=True)
    return joined.withColumns(
        {c: F.coalesce(C.null_if_nan(F.col(c).cast("double")), f"_med_{c}") for c in median}
    ).drop(*[f"_med_{c}" for c in median])


def fit_vocab(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (feature, value, code): distinct strings in byte order numbered from 0; null is 'nan'.

    Codes come from the ranged running sum, so a huge vocabulary is never sorted in one task.
    """
    values = (
        long_form(df, columns, (), "string")
        .select("feature", F.coalesce("value", F.lit(C.MISSING_TOKEN)).alias("value"))
        .distinct()
        .withColumn("one", F.lit(1).cast("long"))
    )
    ranked = prefix_sum(values, ["value"], ["one"], ["feature"])
    return ranked.select("feature", "value", (F.col("cum_one") - 1).cast("int").alias("code"))


def encode(df: DataFrame, vocab: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace categories by codes; values outside the vocabulary get the lowest class, 0.

    Vocabularies of up to LITERAL_VALUES values become literal maps of the projection; each larger one is a
    lookup join.
    """
    names = df.columns
    here = vocab.where(F.col("feature").isin(list(columns)))
    sizes = {r["feature"]: r["count"] for r in here.groupBy("feature").count().collect()}
    few = [c for c in columns if sizes.get(c, 0) <= LITERAL_VALUES]
    codes: dict[str, list] = {c: [] for c in few}
    for r in here.where(F.col("feature").isin([c for c in few if c in sizes])).collect():
        codes[r["feature"]] += [F.lit(r["value"]), F.lit(r["code"])]
    maps = {}
    for c in few:
        token = F.coalesce(F.col(c).cast("string"), F.lit(C.MISSING_TOKEN))
        maps[c] = F.coalesce(F.try_element_at(F.create_map(*codes[c]), token), F.lit(0)) if codes[c] else F.lit(0)
    df = df.withColumns(maps) if maps else df
    for c in columns:
        if c in maps:
            continue
        lookup = here.where(F.col("feature") == c).select(F.col("value").alias(f"_{c}_token"), F.col("code").alias(f"_{c}_code"))
        tokens = df.withColumn(f"_{c}_token", F.coalesce(F.col(c).cast("string"), F.lit(C.MISSING_TOKEN)))
        df = lookup_join(tokens, lookup, [f"_{c}_token"]).withColumn(c, F.coalesce(f"_{c}_code", F.lit(0)))
    return df.select(*names)


def fit_scale(df: DataFrame, columns: Sequence[str]) -> tuple[dict, dict]:
    """Mean and population std of every column in one aggregate; std 0 becomes 1."""
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns],
    ).first()
    return {c: row[f"m_{c}"] for c in columns}, {c: row[f"s_{c}"] or 1.0 for c in columns}


def scale(df: DataFrame, means: Mapping[str, float], stds: Mapping[str, float]) -> DataFrame:
    return df.withColumns(
        {c: (F.col(c).cast("double") - F.lit(m)) / F.lit(stds[c] or 1.0) for c, m in means.items()}
    )


def prepare(df: DataFrame, spec: FeatureSpec, state: FeatureState, keep: Sequence[str] = ()) -> DataFrame:
    """Impute, derive, encode and select (unscaled features)."""
    out = impute(df.drop(*spec.drop), state.medians, state.modes)
    for name, expr in spec.derive.items():
        out = out.withColumn(name, expr)
    if spec.encode:
        out = encode(out, state.vocab, spec.encode)
    return out.select(*keep, *[c for c in spec.select if c not in keep])


def fit(df: DataFrame, spec: FeatureSpec) -> FeatureState:
    """Fit every stage on ``df`` (pass the training part, or all rows for leaky parity)."""
    medians, most = fit_impute(df, spec.median, spec.mode)
    derived = impute(df.drop(*spec.drop), medians, most)
    for name, expr in spec.derive.items():
        derived = derived.withColumn(name, expr)
    vocab = None
    if spec.encode:
        vocab = stage(fit_vocab(derived, spec.encode))
        small = collect_bounded(vocab)
        vocab = vocab if small is None else small
    state = FeatureState(medians, most, vocab)
    state.means, state.stds = fit_scale(prepare(df, spec, state), spec.select)
    return state


def apply(df: DataFrame, spec: FeatureSpec, state: FeatureState, keep: Sequence[str] = ()) -> DataFrame:
    """The whole feature chain as lazy projections and bounded lookups."""
    return scale(prepare(df, spec, state, keep), state.means, state.stds)


def passenger_spec() -> FeatureSpec:
    """The twelve-feature spec of the survival classifier."""
    return FeatureSpec(
        median=["Age", "Fare"],
        mode=["Embarked"],
        drop=["Cabin"],
        derive={
            "Title": C.remap(C.extract_first("Name"), C.title_groups()),
            "FamilySize": C.total_plus_one("SibSp", "Parch"),
            "IsAlone": C.flag(F.col("FamilySize") == 1),
            "AgeBand": C.bin_right_closed("Age", C.AGE_EDGES, C.AGE_LABELS, C.AGE_DEFAULT),
            "FareBand": C.bin_right_closed("Fare", C.FARE_EDGES, C.FARE_LABELS, C.FARE_DEFAULT),
        },
        encode=["Sex", "Title", "AgeBand", "FareBand", "Embarked"],
        select=[
            "Pclass", "Sex", "Age", "SibSp", "Parch", "Fare",
            "Title", "FamilySize", "IsAlone", "AgeBand", "FareBand", "Embarked",
        ],
    )
