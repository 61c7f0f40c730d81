"""Classification metrics, exact at any size: all take optional group keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from scorewright.functions.stats import confusion_counts, metric_columns, ratio
from scorewright.operators.joins import lookup_join
from scorewright.operators.ordered import prefix_sum

# Promotion threshold and recommendation texts.
PROMOTION_THRESHOLD = 0.02
PROMOTE_TEXT = "PROMOTE challenger to champion"
KEEP_TEXT = "KEEP existing champion"


def confusion(df: DataFrame, y: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    counts = confusion_counts(y, pred)
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in counts.items()])


def score_counts(df: DataFrame, y: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows (keys, score, pos, neg): all a ranking metric needs; ties are merged.

    Rows without a label fall out after the counts, because a filter on the label would be
    pushed below it and compute a derived label twice.
    """
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(*keys, F.col(score).alias("score"))
        .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg"))
        .where(F.col("pos") + F.col("neg") > 0)
    )


def midranks(df: DataFrame, y: str, score: str, keys: Sequence[str] = ()):
    """Distinct scores with their tie-averaged ascending rank."""
    counts = score_counts(df, y, score, keys).withColumn("n", F.col("pos") + F.col("neg"))
    ranked = prefix_sum(counts, ["score"], ["pos", "neg", "n"], keys)
    return ranked.select(
        *keys,
        "score",
        "pos",
        "neg",
        (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2).alias("midrank"),
        "total_pos",
        "total_neg",
    )


def roc_auc(df: DataFrame, y: str, score: str, keys: Sequence[str] = ()):
    """Rank-sum AUC, ties at half; null when a class is absent."""
    pos, neg = F.col("total_pos").cast("double"), F.col("total_neg").cast("double")
    return (
        midranks(df, y, score, keys)
        .groupBy(*keys)
        .agg(
            F.sum(F.col("pos") * F.col("midrank")).alias("r"),
            F.max("total_pos").alias("total_pos"),
            F.max("total_neg").alias("total_neg"),
        )
        .select(
            *keys,
            F.try_divide(F.col("r") - pos * (pos + 1) / 2, pos * neg).alias("roc_auc"),
        )
    )


def metrics(
    df: DataFrame, y: str, pred: str, score: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts, accuracy, precision, recall, f1_score, support (and roc_auc).

    With a score, one grouped pass feeds both: confusion counts ride along on the distinct
    scores that the ranking needs anyway.
    """
    keys = list(keys)
    if score is None:
        base = confusion(df, y, pred, keys)
    else:
        cells = {n: c.alias(n) for n, c in confusion_counts(y, pred).items()}
        ranked = F.col(score).isNotNull()
        counts = df.groupBy(*keys, F.col(score).alias("score")).agg(
            F.count_if((F.col(y) == 1) & ranked).alias("pos"),
            F.count_if((F.col(y) == 0) & ranked).alias("neg"),
            *cells.values(),
        )
        walk = prefix_sum(counts, ["score"], ["pos", "neg"], keys)
        won = F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2.0)
        base = walk.groupBy(*keys).agg(
            *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in cells],
            F.try_divide(F.sum(won), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"),
        )
    base = base.withColumn("support", F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp"))
    return base.withColumns(metric_columns())


def roc(
    df: DataFrame,
    y: str,
    score: str,
    keys: Sequence[str] = (),
    drop_collinear: bool = True,
) -> DataFrame:
    """Points (keys, fpr, tpr, threshold, fps, tps), the (0, 0) point with an infinite threshold."""
    keys = list(keys)
    down = score_counts(df, y, score, keys).withColumn("down", -F.col("score"))
    walk = prefix_sum(down, ["down"], ["pos", "neg"], keys)
    if drop_collinear:
        same = (F.col("next.pos") == F.col("pos")) & (F.col("next.neg") == F.col("neg"))
        walk = walk.where(F.col("prev").isNull() | F.col("next").isNull() | ~same)
    points = walk.select(
        *keys,
        ratio("cum_neg", "total_neg", None).alias("fpr"),
        ratio("cum_pos", "total_pos", None).alias("tpr"),
        F.col("score").alias("threshold"),
        F.col("cum_neg").alias("fps"),
        F.col("cum_pos").alias("tps"),
    )
    has = walk.select(*keys, "total_pos", "total_neg").groupBy(*keys).agg(
        F.max("total_pos").alias("p"), F.max("total_neg").alias("n")
    ).where("p IS NOT NULL")
    origin = has.select(
        *keys,
        F.when(F.col("n") > 0, 0.0).alias("fpr"),
        F.when(F.col("p") > 0, 0.0).alias("tpr"),
        F.lit(float("inf")).alias("threshold"),
        F.lit(0).cast("long").alias("fps"),
        F.lit(0).cast("long").alias("tps"),
    )
    return points.unionByName(origin)


def auc_trapezoid(df: DataFrame, y: str, score: str, keys: Sequence[str] = ()):
    """Area under the ROC points by trapezoids: each tie group adds one trapezoid."""
    down = score_counts(df, y, score, keys).withColumn("down", -F.col("score"))
    walk = prefix_sum(down, ["down"], ["pos", "neg"], keys)
    area = F.col("neg") * (2 * F.col("cum_pos") - F.col("pos")) / 2.0
    return (
        walk.groupBy(*keys)
        .agg(
            F.sum(area).alias("a"),
            F.max("total_pos").cast("double").alias("p"),
            F.max("total_neg").cast("double").alias("n"),
        )
        .select(*keys, F.try_divide(F.col("a"), F.col("p") * F.col("n")).alias("auc"))
    )


def classification_report(df: DataFrame, y: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows (keys, class, precision, recall, f1_score, support) plus accuracy and averages."""
    keys = list(keys)
    counts = confusion(df, y, pred, keys)
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    one = metric_columns()
    zero = metric_columns("tp", "fn", "fp", "tn")
    s0, s1 = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1_score"),
            support.cast("long").alias("support"),
        )

    def mean(key):
        return (zero[key] + one[key]) / 2.0

    def weighted(key):
        return ratio(zero[key] * s0 + one[key] * s1, n)

    picked = ("precision", "recall", "f1_score")
    return counts.select(
        *keys,
        F.inline(
            F.array(
                row("0", *[zero[k] for k in picked], s0),
                row("1", *[one[k] for k in picked], s1),
                row("accuracy", *[one["accuracy"]] * 3, n),
                row("macro avg", *[mean(k) for k in picked], n),
                row("weighted avg", *[weighted(k) for k in picked], n),
            )
        ),
    )


def side_by_side(runs: DataFrame, on: Sequence[str], role: str = "role") -> DataFrame:
    """Champion and challenger metric rows next to each other; the champion may be absent."""
    on = list(on)
    cols = [c for c in runs.columns if c not in (*on, role)]

    def part(name):
        rows = runs.where(F.col(role) == name)
        return rows.select(*on, *[F.col(c).alias(f"{name}_{c}") for c in cols])

    challenger, champion = part("challenger"), part("champion")
    return lookup_join(challenger, champion, on, null_safe=True)


def promote(pairs: DataFrame, threshold: float = PROMOTION_THRESHOLD) -> DataFrame:
    """The challenger wins iff its AUC gain reaches the threshold, or nobody holds the title."""
    first = F.col("champion_roc_auc").isNull()
    gain = F.col("challenger_roc_auc") - F.col("champion_roc_auc")
    wins = first | F.coalesce(gain >= threshold, F.lit(False))
    text = F.regexp_replace(F.format_number(gain, 4), ",", "")
    reason = (
        F.when(first, F.lit("First model deployment — no champion exists"))
        .when(
            wins,
            F.concat(
                F.lit("Challenger ROC-AUC improved by "), text, F.lit(f" (threshold: {threshold})")
            ),
        )
        .otherwise(
            F.concat(F.lit("Challenger did NOT improve by threshold ("), text, F.lit(f" < {threshold})"))
        )
    )
    return pairs.withColumns(
        {
            "challenger_wins": wins,
            "is_first_model": first,
            "roc_auc_improvement": gain,
            "improvement_threshold": F.lit(threshold),
            "promotion_reason": reason,
            "recommendation": F.when(wins, PROMOTE_TEXT).otherwise(KEEP_TEXT),
        }
    )
