"""Queries over classification metrics, ranking curves, promotion, fitting and explanation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from scorewright.catalog.base import (
    CHALLENGER, CHAMPION, KEY_SQL, ROW_KEY, SCORED, Y_SQL, key_column, key_hash_sql, planted_label, probability_sql, query,
    raw_lines, scored_lines, scored_sql, table,
)
from scorewright.catalog.transforms import CHAIN_FEATURES, chained, line_spec
from scorewright.functions.columns import sigmoid
from scorewright.operators import explain as E
from scorewright.operators import irls
from scorewright.operators import metrics as M
from scorewright.operators import model as ML
from scorewright.operators import splits as S
from scorewright.operators import surrogate as SG
from scorewright.operators.features import fit_impute, impute
from scorewright.operators.validation import Field, Schema, at_least, at_most, isin, quarantine
from scorewright.plans.training import train
from scorewright.session import stage

CONF = """count(*) FILTER (y = 0 AND prediction = 0) AS tn, count(*) FILTER (y = 0 AND prediction = 1) AS fp,
    count(*) FILTER (y = 1 AND prediction = 0) AS fn, count(*) FILTER (y = 1 AND prediction = 1) AS tp"""
METRICS = """round((tn + tp) / (tn + fp + fn + tp), 6) AS accuracy,
    round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
    round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
    round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1_score"""
METRIC_NAMES = ["accuracy", "precision", "recall", "f1_score"]


def auc_sql(keys: str = "", source: str = "scored") -> str:
    """Mid-rank AUC of (y, p), per group."""
    k, g = (f"{keys},", f"GROUP BY {keys}") if keys else ("", "")
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""(SELECT {k} round((sum(rk) FILTER (y = 1) - pos * (pos + 1) / 2) / (pos * neg), 6) AS roc_auc FROM (
        SELECT {k} y, rank() OVER ({part} ORDER BY p) + (count(*) OVER (PARTITION BY {k} p) - 1) / 2 AS rk,
            sum(y) OVER ({part})::DOUBLE AS pos, sum(1 - y) OVER ({part})::DOUBLE AS neg FROM {source})
        GROUP BY {k} pos, neg)"""


def rounded(df, names=METRIC_NAMES):
    return df.withColumns({c: F.round(c, 6) for c in names})


@query("confusion", f"WITH {SCORED} SELECT l_linestatus, {CONF} FROM scored GROUP BY 1")
def confusion(spark, sf):
    return M.confusion(scored_lines(spark, sf), "y", "prediction", ["l_linestatus"])


@query(
    "classification_metrics",
    f"""WITH {SCORED}, c AS (SELECT {CONF} FROM scored)
        SELECT tn, fp, fn, tp, tn + fp + fn + tp AS support, {METRICS}, roc_auc FROM c, {auc_sql()}""",
)
def classification_metrics(spark, sf):
    return rounded(M.metrics(scored_lines(spark, sf), "y", "prediction", "p"), [*METRIC_NAMES, "roc_auc"])


@query("roc_auc", f"WITH {SCORED} SELECT roc_auc FROM {auc_sql()}")
def roc_auc(spark, sf):
    return rounded(M.roc_auc(scored_lines(spark, sf), "y", "p"), ["roc_auc"])


@query(
    "midrank",
    f"""WITH {SCORED} SELECT DISTINCT p AS score, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2
        AS midrank FROM scored""",
)
def midrank(spark, sf):
    return M.midranks(scored_lines(spark, sf), "y", "p").select("score", "midrank")


CUM = """g AS (SELECT p, sum(y)::BIGINT AS pos, sum(1 - y)::BIGINT AS neg FROM scored GROUP BY 1),
cum AS (SELECT p AS threshold, pos, neg, (sum(neg) OVER w)::BIGINT AS fps, (sum(pos) OVER w)::BIGINT AS tps,
    lag(pos) OVER w AS before_pos, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
    (sum(pos) OVER ())::DOUBLE AS n_pos, (sum(neg) OVER ())::DOUBLE AS n_neg
    FROM g WINDOW w AS (ORDER BY p DESC))"""


@query("roc_cumulative", f"WITH {SCORED}, {CUM} SELECT threshold, fps, tps FROM cum")
def roc_cumulative(spark, sf):
    rows = M.roc(scored_lines(spark, sf), "y", "p", drop_collinear=False)
    return rows.where(F.col("threshold") != float("inf")).select("threshold", "fps", "tps")


KEPT = """kept AS (SELECT * FROM cum WHERE before_pos IS NULL OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg)"""


@query("roc_drop_collinear", f"WITH {SCORED}, {CUM}, {KEPT} SELECT threshold, fps, tps FROM kept")
def roc_drop_collinear(spark, sf):
    rows = M.roc(scored_lines(spark, sf), "y", "p")
    return rows.where(F.col("threshold") != float("inf")).select("threshold", "fps", "tps")


@query(
    "roc_curve",
    f"""WITH {SCORED}, {CUM}, {KEPT} SELECT round(fps / n_neg, 6) AS fpr, round(tps / n_pos, 6) AS tpr, threshold FROM kept
        UNION ALL SELECT 0, 0, 'infinity'::DOUBLE""",
)
def roc_curve(spark, sf):
    rows = M.roc(scored_lines(spark, sf), "y", "p")
    return rows.select(F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"), "threshold")


@query(
    "auc_trapezoid",
    f"""WITH {SCORED}, {CUM} SELECT round(sum(neg / n_neg * (tps + tps - pos) / n_pos / 2), 6) AS auc FROM cum""",
)
def auc_trapezoid(spark, sf):
    return rounded(M.auc_trapezoid(scored_lines(spark, sf), "y", "p"), ["auc"])


def class_row(name, tn, fp, fn, tp) -> str:
    return f"""SELECT '{name}' AS class, CASE WHEN {tp} + {fp} = 0 THEN 0 ELSE {tp} / ({tp} + {fp}) END AS precision,
        CASE WHEN {tp} + {fn} = 0 THEN 0 ELSE {tp} / ({tp} + {fn}) END AS recall,
        CASE WHEN 2 * {tp} + {fp} + {fn} = 0 THEN 0 ELSE 2 * {tp} / (2 * {tp} + {fp} + {fn}) END AS f1_score,
        {tp} + {fn} AS support FROM c"""


@query(
    "classification_report",
    f"""WITH {SCORED}, c AS (SELECT {CONF} FROM scored),
        per AS ({class_row('0', 'tp', 'fn', 'fp', 'tn')} UNION ALL {class_row('1', 'tn', 'fp', 'fn', 'tp')})
        SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, support FROM per
        UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT round((tn + tp) / (tn + fp + fn + tp), 6) AS a, tn + fp + fn + tp AS n FROM c)
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1_score), 6), sum(support)::BIGINT FROM per
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
            round(sum(f1_score * support) / sum(support), 6), sum(support)::BIGINT FROM per""",
)
def classification_report(spark, sf):
    rows = M.classification_report(scored_lines(spark, sf), "y", "prediction")
    return rounded(rows, ["precision", "recall", "f1_score"])


@query(
    "train_test_metrics",
    f"""WITH {SCORED}, parts AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY {key_hash_sql(42, *ROW_KEY)})
            <= floor(count(*) OVER (PARTITION BY y) * 0.2::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS split FROM scored),
        c AS (SELECT split, {CONF} FROM parts GROUP BY 1)
        SELECT split, tn, fp, fn, tp, tn + fp + fn + tp AS support, {METRICS}, roc_auc
        FROM c JOIN {auc_sql('split', 'parts')} USING (split)""",
)
def train_test_metrics(spark, sf):
    parts = S.split(scored_lines(spark, sf), ROW_KEY, 0.2, 42, ["y"])
    return rounded(M.metrics(parts, "y", "prediction", "p", ["split"]), [*METRIC_NAMES, "roc_auc"])


@query(
    "segment_metrics",
    f"""WITH {SCORED}, c AS (SELECT l_suppkey, {CONF} FROM scored GROUP BY 1)
        SELECT l_suppkey, tn, fp, fn, tp, tn + fp + fn + tp AS support, {METRICS}, roc_auc
        FROM c JOIN {auc_sql('l_suppkey')} USING (l_suppkey)""",
)
def segment_metrics(spark, sf):
    rows = M.metrics(scored_lines(spark, sf), "y", "prediction", "p", ["l_suppkey"])
    return rounded(rows, [*METRIC_NAMES, "roc_auc"])


BOTH = f"""{scored_sql(CHAMPION, 'champ')}, {scored_sql(CHALLENGER, 'chall')},
both_models AS (SELECT 'champion' AS role, l_linestatus, y, p, prediction FROM champ
    UNION ALL SELECT 'challenger', l_linestatus, y, p, prediction FROM chall),
runs AS (SELECT role, l_linestatus, roc_auc FROM {auc_sql('role, l_linestatus', 'both_models')}),
pairs AS (SELECT a.l_linestatus, a.roc_auc AS challenger_roc_auc, b.roc_auc AS champion_roc_auc
    FROM runs a JOIN runs b ON a.l_linestatus = b.l_linestatus AND a.role = 'challenger' AND b.role = 'champion')"""


def _pairs(spark, sf):
    sides = [
        scored_lines(spark, sf, model).select(F.lit(role).alias("role"), "l_linestatus", "y", "p")
        for role, model in (("champion", CHAMPION), ("challenger", CHALLENGER))
    ]
    runs = rounded(M.roc_auc(sides[0].unionByName(sides[1]), "y", "p", ["role", "l_linestatus"]), ["roc_auc"])
    return M.side_by_side(runs, ["l_linestatus"])


@query("champion_vs_challenger", f"WITH {BOTH} SELECT * FROM pairs")
def champion_vs_challenger(spark, sf):
    return _pairs(spark, sf)


@query(
    "promotion_decision",
    f"""WITH {BOTH}, cases AS (SELECT * FROM pairs UNION ALL SELECT 'new', challenger_roc_auc, NULL FROM pairs WHERE l_linestatus = 'F'),
        gains AS (SELECT *, round(challenger_roc_auc - champion_roc_auc, 6) AS gain FROM cases)
        SELECT l_linestatus, champion_roc_auc IS NULL OR gain >= 0.02 AS challenger_wins, champion_roc_auc IS NULL AS is_first_model,
            gain AS roc_auc_improvement, 0.02::DOUBLE AS improvement_threshold,
            CASE WHEN champion_roc_auc IS NULL THEN 'First model deployment — no champion exists'
                WHEN gain >= 0.02 THEN 'Challenger ROC-AUC improved by ' || printf('%.4f', gain) || ' (threshold: 0.02)'
                ELSE 'Challenger did NOT improve by threshold (' || printf('%.4f', gain) || ' < 0.02)' END AS promotion_reason,
            CASE WHEN champion_roc_auc IS NULL OR gain >= 0.02 THEN 'PROMOTE challenger to champion'
                ELSE 'KEEP existing champion' END AS recommendation FROM gains""",
)
def promotion_decision(spark, sf):
    pairs = _pairs(spark, sf)
    first = pairs.where("l_linestatus = 'F'").select(
        F.lit("new").alias("l_linestatus"), "challenger_roc_auc", F.lit(None).cast("double").alias("champion_roc_auc")
    )
    decided = M.promote(pairs.unionByName(first)).drop("challenger_roc_auc", "champion_roc_auc")
    return decided.withColumn("roc_auc_improvement", F.round("roc_auc_improvement", 6))


# ---- the flagship: one job over validation, features, scores and metrics ----


@query(
    "lifecycle",
    f"""WITH lines AS (
            SELECT *, {Y_SQL} AS y, NULLIF(l_discount, 0::DOUBLE) AS d FROM lineitem
            WHERE l_linenumber BETWEEN 1 AND 7 AND l_quantity BETWEEN 1 AND 50),
        filled AS (SELECT * REPLACE (coalesce(d, (SELECT quantile_cont(d, 0.5) FROM lines)) AS l_discount) FROM lines),
        scored AS (SELECT *, (p > 0.5)::INT AS prediction FROM (
            SELECT *, round({probability_sql(CHAMPION)}, 6) AS p FROM filled)),
        c AS (SELECT l_linestatus, {CONF} FROM scored GROUP BY 1)
        SELECT l_linestatus, tn, fp, fn, tp, tn + fp + fn + tp AS support, {METRICS}, roc_auc
        FROM c JOIN {auc_sql('l_linestatus')} USING (l_linestatus)""",
)
def lifecycle(spark, sf):
    schema = Schema(
        "lines",
        (
            Field("l_linenumber", "int", (isin(1, 2, 3, 4, 5, 6, 7),)),
            Field("l_quantity", "double", (at_least(1), at_most(50))),
        ),
    )
    good, _ = quarantine(table(spark, sf, "lineitem").withColumn("y", planted_label()), schema)
    lines = good.withColumn("l_discount", F.nullif("l_discount", F.lit(0.0)))
    filled = impute(lines, *fit_impute(lines, ["l_discount"], []))
    scored = filled.withColumn("p", F.round(sigmoid(CHAMPION.margin()), 6))
    scored = scored.withColumn("prediction", (F.col("p") > 0.5).cast("int"))
    return rounded(M.metrics(scored, "y", "prediction", "p", ["l_linestatus"]), [*METRIC_NAMES, "roc_auc"])


# ---- fitting and search ----


def _sums_sql() -> str:
    """Gradient, Gram matrix and loss of the champion's coefficients, per row, with balanced weights."""
    x = {"intercept": "1", **{c: c for c in CHAMPION.features}}
    names = list(x)
    parts = [f"SELECT 'gradient' AS what, '{a}' AS a, NULL AS b, sum(w * (p - y) * {x[a]}) / count(*) AS value FROM m" for a in names]
    parts += [
        f"SELECT 'gram', '{a}', '{b}', sum(w * p * (1 - p) * {x[a]} * {x[b]}) / count(*) FROM m"
        for i, a in enumerate(names) for b in names[i:]
    ]
    parts.append("SELECT 'loss', NULL, NULL, sum(-w * ln(CASE WHEN y = 1 THEN p ELSE 1 - p END)) / count(*) FROM m")
    return f"""WITH r AS (SELECT *, {Y_SQL} AS y, {probability_sql(CHAMPION)} AS p FROM lineitem),
        m AS (SELECT *, count(*) OVER () / (2 * count(*) OVER (PARTITION BY y)) AS w FROM r)
        SELECT what, a, b, round(value, 6) AS value FROM ({" UNION ALL ".join(parts)})"""


@query("logreg_sums", _sums_sql())
def logreg_sums(spark, sf):
    """One pass of the fit at fixed coefficients: what an iteration knows of the rows."""
    names = list(CHAMPION.features)
    rows = irls.training_rows(table(spark, sf, "lineitem").withColumn("y", planted_label()), names, "y")
    zeros, ones = irls.class_counts(rows, names)
    n = zeros + ones
    at = np.array([[CHAMPION.intercept, *CHAMPION.weights]])
    sums = irls.loss_sums(rows, names, at, np.array([[n / (2 * zeros), n / (2 * ones)]]))
    every = ["intercept", *names]
    out = [("gradient", a, None, float(v) / n) for a, v in zip(every, sums.gradient[0])]
    out += [("gram", a, every[j], float(sums.gram[0, i, j]) / n) for i, a in enumerate(every) for j in range(i, len(every))]
    out.append(("loss", None, None, float(sums.loss[0]) / n))
    made = spark.createDataFrame(out, "what string, a string, b string, value double")
    return made.withColumn("value", F.round("value", 6))


FITS = {"balanced": {}, "l1": {"C": 0.01, "penalty": "l1"}, "unweighted": {"balanced": False}}


@query(
    "logreg_stationary",
    " UNION ALL ".join(
        f"SELECT '{fit}' AS fit, '{c}' AS feature, count(*) AS n_rows, 0::DOUBLE AS slope FROM lineitem"
        for fit in FITS for c in ["intercept", *CHAIN_FEATURES]
    ),
)
def logreg_stationary(spark, sf):
    """At each solution the slope of the penalised objective, from sums in SQL over all rows, is zero."""
    rows = stage(chained(spark, sf))
    parts = []
    for fit, options in FITS.items():
        model = ML.fit_logreg(rows, CHAIN_FEATURES, "y", **options)
        C, balanced = options.get("C", 1.0), options.get("balanced", True)
        weighed = rows.join(F.broadcast(ML.class_weights(rows, "y").select("y", "weight")), "y")
        miss = (F.col("weight") if balanced else F.lit(1.0)) * (model.probability() - F.col("y")) * C
        slopes = weighed.agg(F.count(F.lit(1)).alias("n"), *[F.sum(miss * x).alias(c) for c, x in (("intercept", F.lit(1.0)), *((c, F.col(c)) for c in CHAIN_FEATURES))])
        terms = [F.struct(F.lit("intercept").alias("feature"), F.col("intercept").alias("slope"))]
        for c, w in zip(model.features, model.weights):
            if options.get("penalty") == "l1":
                slope = F.greatest(F.abs(F.col(c)) - 1, F.lit(0.0)) if w == 0 else F.col(c) + (1 if w > 0 else -1)
            else:
                slope = F.col(c) + w
            terms.append(F.struct(F.lit(c).alias("feature"), slope.alias("slope")))
        each = slopes.select(F.lit(fit).alias("fit"), F.col("n").alias("n_rows"), F.inline(F.array(*terms)))
        # -0.0 and tiny remainders of the sums become 0
        parts.append(each.withColumn("slope", F.round(F.col("slope") / F.col("n_rows"), 7) + F.lit(0.0)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("logreg_fit")
def logreg_fit(spark, sf):
    return ML.coefficients(ML.fit_logreg(chained(spark, sf), CHAIN_FEATURES, "y"), spark)


@query("logreg_fit_l1")
def logreg_fit_l1(spark, sf):
    return ML.coefficients(ML.fit_logreg(chained(spark, sf), CHAIN_FEATURES, "y", C=0.01, penalty="l1"), spark)


@query("logreg_fit_unweighted")
def logreg_fit_unweighted(spark, sf):
    model = ML.fit_logreg(chained(spark, sf), CHAIN_FEATURES, "y", balanced=False)
    rows = ML.coefficients(model, spark)
    position = F.array_position(F.lit(list(CHAIN_FEATURES)), F.col("feature")) - 1
    return rows.withColumn("feature", F.concat(F.lit("Feature_"), position.cast("string")))


@query("coef_importance")
def coef_importance(spark, sf):
    done = train(raw_lines(spark, sf).withColumn("y", planted_label()), line_spec(), "y", ["row_key"])
    return done.importance.orderBy(F.desc("importance"))


def _trials(spark, sf):
    rows = S.split(chained(spark, sf), ["row_key"], 0.2, 43, exact=False, into="part")
    train, valid = rows.where("part = 'train'"), rows.where("part = 'test'")
    return ML.search(train, valid, CHAIN_FEATURES, "y", seed=42, parallelism=4)


@query("hyperparam_search")
def hyperparam_search(spark, sf):
    return _trials(spark, sf)


TRIALS_SQL = f"""trials AS (SELECT l_suppkey, (l_linenumber)::INT AS number, round(avg(p), 3) AS val_roc_auc
    FROM scored GROUP BY 1, 2)"""


@query(
    "best_trial",
    f"""WITH {SCORED}, {TRIALS_SQL} SELECT l_suppkey, number, val_roc_auc FROM (SELECT *, row_number() OVER (
        PARTITION BY l_suppkey ORDER BY val_roc_auc DESC, number) AS r FROM trials) WHERE r = 1""",
)
def best_trial(spark, sf):
    trials = scored_lines(spark, sf).groupBy("l_suppkey", F.col("l_linenumber").cast("int").alias("number")).agg(
        F.round(F.avg("p"), 3).alias("val_roc_auc")
    )
    return ML.best_trial(trials, ["l_suppkey"])


# ---- explanation ----

PHI_PARTS = [
    f"SELECT row_key, '{c}' AS feature, {c}::DOUBLE AS value, {w!r}::DOUBLE * ({c} - (SELECT avg({c}) FROM lineitem)) AS phi, p FROM k"
    for c, w in zip(CHAMPION.features, CHAMPION.weights)
]
PHI_SQL = f"""k AS (SELECT *, {KEY_SQL} AS row_key, {probability_sql(CHAMPION)} AS p FROM lineitem),
phi AS ({' UNION ALL '.join(PHI_PARTS)})"""


def _keyed(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("row_key", key_column())
    return rows, E.background_means(rows, CHAMPION.features)


@query("linear_shap", f"WITH {PHI_SQL} SELECT row_key, feature, value, round(phi, 8) AS phi FROM phi")
def linear_shap(spark, sf):
    rows, means = _keyed(spark, sf)
    return E.contributions(rows, CHAMPION, means, ["row_key"]).withColumn("phi", F.round("phi", 8))


@query(
    "mean_abs_contribution",
    f"WITH {PHI_SQL} SELECT feature, round(avg(abs(phi)), 6) AS mean_abs_phi, count(*) AS n_explained FROM phi GROUP BY 1",
)
def mean_abs_contribution(spark, sf):
    rows, means = _keyed(spark, sf)
    return rounded(E.global_importance(E.contributions(rows, CHAMPION, means, ["row_key"])), ["mean_abs_phi"])


@query(
    "shap_global",
    f"""WITH {PHI_SQL}, g AS (SELECT feature, round(avg(abs(phi)), 6) AS mean_abs_phi, count(*) AS n_explained FROM phi GROUP BY 1)
        SELECT *, row_number() OVER (ORDER BY mean_abs_phi DESC, feature)::INT AS rank FROM g""",
)
def shap_global(spark, sf):
    return E.rank_features(mean_abs_contribution(spark, sf))


@query(
    "topk_global",
    f"""WITH {PHI_SQL} SELECT feature, round(avg(abs(phi)), 6) AS mean_abs_phi, count(*) AS n_explained FROM phi GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 2""",
)
def topk_global(spark, sf):
    return E.top_global(mean_abs_contribution(spark, sf), 2)


LOCAL_SQL = f"""{PHI_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY abs(phi) DESC, feature)::INT AS rank FROM phi)"""


@query("contribution_rank", f"WITH {LOCAL_SQL} SELECT row_key, feature, rank FROM ranked")
def contribution_rank(spark, sf):
    rows, means = _keyed(spark, sf)
    return E.explain_rows(rows, CHAMPION, means, ["row_key"], 3).select("row_key", "feature", "rank")


@query(
    "topk_per_row",
    f"WITH {LOCAL_SQL} SELECT row_key, feature, rank, round(phi, 8) AS phi FROM ranked WHERE rank <= 2",
)
def topk_per_row(spark, sf):
    rows, means = _keyed(spark, sf)
    out = E.explain_rows(rows, CHAMPION, means, ["row_key"], 2)
    return out.select("row_key", "feature", "rank", F.round("phi", 8).alias("phi"))


@query(
    "shap_local",
    f"""WITH {LOCAL_SQL} SELECT row_key, (p > 0.5)::INT AS prediction, round(p, 6) AS probability, rank, feature, value,
        round(phi, 8) AS phi, CASE WHEN phi >= 0 THEN '+' ELSE '-' END AS sign FROM ranked WHERE rank <= 8""",
)
def shap_local(spark, sf):
    rows, means = _keyed(spark, sf)
    out = E.explain_rows(rows, CHAMPION, means, ["row_key"])
    return out.withColumns({"phi": F.round("phi", 8), "probability": F.round("probability", 6)})


@query(
    "first_n_rows",
    f"""WITH {LOCAL_SQL} SELECT row_key, feature, rank FROM ranked WHERE row_key IN (
        SELECT row_key FROM k ORDER BY row_key LIMIT 5)""",
)
def first_n_rows(spark, sf):
    rows, means = _keyed(spark, sf)
    first = E.first_rows(rows, ["row_key"], 5)
    return E.explain_rows(first, CHAMPION, means, ["row_key"]).select("row_key", "feature", "rank")


@query("additivity_check", f"WITH {PHI_SQL} SELECT count(*) AS n_rows, true AS additive FROM k")
def additivity_check(spark, sf):
    rows, means = _keyed(spark, sf)
    gaps = E.additivity_gap(rows, CHAMPION, means, ["row_key"])
    return gaps.agg(F.count(F.lit(1)).alias("n_rows"), (F.max("gap") < 1e-9).alias("additive"))


@query("local_surrogate")
def local_surrogate(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 5000.0).alias("balance"), (F.col("c_nationkey") / 10.0).alias("nation")
    )
    predict = lambda z: sigmoid(z["balance"] * 1.5 - z["nation"] * 0.5)
    return SG.local_surrogate(rows, predict, ["balance", "nation"], ["c_custkey"], top=8, spread=spark.sparkContext.defaultParallelism)
