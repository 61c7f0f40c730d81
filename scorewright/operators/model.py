"""Logistic regression: fit (sums by pass, see ``irls``), score (plain expressions), search."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from scorewright.functions.columns import label_text, linear, sigmoid
from scorewright.operators import irls
from scorewright.operators.metrics import metrics
from scorewright.session import stage

# The search space of the parameter search.
SOLVER_PENALTIES = [
    "lbfgs_l2", "lbfgs_none", "liblinear_l1", "liblinear_l2", "saga_l1", "saga_l2", "saga_none",
]
C_RANGE = (1e-3, 10.0)
MAX_ITER_RANGE = (200, 2000, 200)
CLASS_WEIGHTS = ["balanced", None]


@dataclass(frozen=True)
class LogisticModel:
    """Weights in feature order; everything scoring needs fits in a literal expression."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float

    def margin(self) -> Column:
        return linear(dict(zip(self.features, self.weights)), self.intercept)

    def probability(self) -> Column:
        return sigmoid(self.margin())


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_class) per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    classes = Window.partitionBy(F.lit(1))  # one row per class
    n, k = F.sum("n_class").over(classes), F.count(F.lit(1)).over(classes)
    return counts.withColumn("weight", n.cast("double") / (k * F.col("n_class")))


def fit_logreg(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    C: float = 1.0,
    penalty: str | None = "l2",
    balanced: bool = True,
    max_iter: int = 1000,
    tol: float = 1e-9,
) -> LogisticModel:
    """Penalty strength follows the 0.5|w|^2 + C * sum(loss) convention, intercept free.

    Rows without a label are not learned from. The rows are staged once; see ``irls`` for the passes.
    """
    rows = stage(irls.training_rows(df, features, label))
    fitted, _ = irls.fit_many(rows, features, [irls.Setting(C, penalty, balanced, max_iter, tol)])
    return as_model(features, fitted[0])


def as_model(features: Sequence[str], fitted) -> LogisticModel:
    return LogisticModel(tuple(features), tuple(map(float, fitted[1:])), float(fitted[0]))


def coefficients(model: LogisticModel, spark) -> DataFrame:
    """Rows (feature, coefficient, importance, rank), largest absolute weight first."""
    ranked = sorted(zip(model.features, model.weights), key=lambda fw: (-abs(fw[1]), fw[0]))
    rows = [(f, w, abs(w), i + 1) for i, (f, w) in enumerate(ranked)]
    return spark.createDataFrame(rows, "feature string, coefficient double, importance double, rank int")


def score(
    df: DataFrame,
    model: LogisticModel,
    positive: str = "Survived",
    negative: str = "Did not survive",
    names: tuple[str, str] = ("survival_probability", "non_survival_probability"),
) -> DataFrame:
    """Carry all input columns; add both probabilities, the prediction and its text."""
    p1, p0 = names
    return (
        df.withColumn(p1, model.probability())
        .withColumn(p0, F.lit(1.0) - F.col(p1))
        .withColumn("prediction", (F.col(p1) > 0.5).cast("int"))
        .withColumn("prediction_label", label_text("prediction", positive, negative))
    )


def score_variant(df: DataFrame, model: LogisticModel, version: str | None = None) -> DataFrame:
    """Scores with per-class probabilities, confidence, version and timestamp columns."""
    p = F.col("probability_positive")
    return (
        df.withColumn("probability_positive", model.probability())
        .withColumn("probability_negative", F.lit(1.0) - p)
        .withColumn("prediction", (p > 0.5).cast("int"))
        .withColumn("confidence", F.greatest("probability_positive", "probability_negative"))
        .withColumn("inference_timestamp", F.current_timestamp())
        .withColumn("model_version", F.lit(version or "unknown"))
    )


def score_batches(df: DataFrame, load: Callable[[], Callable], schema) -> DataFrame:
    """Plug-in scorer: ``load()`` runs once per partition, its result on every Arrow batch."""

    def run(batches):
        fn = load()
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)


@dataclass(frozen=True)
class Trial:
    number: int
    C: float
    solver: str
    penalty: str | None
    class_weight: str | None
    max_iter: int


def draw_trials(n_trials: int = 50, seed: int = 42) -> list[Trial]:
    """Seeded random draws from the search space (log-uniform C)."""
    rng = random.Random(seed)
    low, high, step = MAX_ITER_RANGE
    out = []
    for i in range(n_trials):
        solver, penalty = rng.choice(SOLVER_PENALTIES).split("_")
        out.append(
            Trial(
                number=i,
                C=math.exp(rng.uniform(math.log(C_RANGE[0]), math.log(C_RANGE[1]))),
                solver=solver,
                penalty=None if penalty == "none" else penalty,
                class_weight=rng.choice(CLASS_WEIGHTS),
                max_iter=rng.randrange(low, high + 1, step),
            )
        )
    return out


def search(
    train: DataFrame,
    valid: DataFrame,
    features: Sequence[str],
    label: str,
    n_trials: int = 50,
    seed: int = 42,
    parallelism: int = 4,
    fit_one: Callable[[DataFrame, Trial], LogisticModel] | None = None,
) -> DataFrame:
    """Trial table with validation AUC and F1, all trials evaluated in one keyed job.

    The trials' models are fitted together, one pass over the training rows for an iteration of all of
    them. With ``fit_one``, a function of the caller's, they are fitted one by one, ``parallelism`` at a time.
    """
    spark = train.sparkSession
    # every trial reads the same staged rows instead of recomputing the feature chain
    valid = stage(valid.where(F.col(label).isNotNull()).select(*features, label))
    trials = draw_trials(n_trials, seed)
    if fit_one is None:
        rows = stage(irls.training_rows(train, features, label))
        settings = [irls.Setting(t.C, t.penalty, t.class_weight == "balanced", t.max_iter, 1e-9) for t in trials]
        models = [as_model(features, fitted) for fitted in irls.fit_many(rows, features, settings)[0]]
    else:
        train = stage(train.select(*features, label))
        with ThreadPoolExecutor(parallelism) as pool:
            models = list(pool.map(lambda t: fit_one(train, t), trials))
    scored = valid.select(
        F.col(label).alias("y"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(t.number).alias("number"), m.probability().alias("p"))
                    for t, m in zip(trials, models)
                ]
            )
        ),
    ).withColumn("pred", (F.col("p") > 0.5).cast("int"))
    result = metrics(scored, "y", "pred", "p", ["number"]).select(
        "number", F.col("roc_auc").alias("val_roc_auc"), F.col("f1_score").alias("val_f1_score")
    )
    table = spark.createDataFrame(
        [tuple(asdict(t).values()) for t in trials],
        "number int, C double, solver string, penalty string, class_weight string, max_iter int",
    )
    return table.join(result, "number", "left")


def best_trial(trials: DataFrame, keys: Sequence[str] = (), metric: str = "val_roc_auc") -> DataFrame:
    """Largest metric, ties to the lowest trial number."""
    rest = [c for c in trials.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(F.col(metric), -F.col("number")))
    return trials.where(F.col(metric).isNotNull()).groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")
