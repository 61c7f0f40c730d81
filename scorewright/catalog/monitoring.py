"""Queries over drift tests, severity, alerts and the feedback loop."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorewright.catalog.base import (
    ARRIVALS_SQL, LOG_SQL, PERIODS_SQL, SCORED, fresh_dir, key_hash_sql, late_label_rows, periods, prediction_log, query, scored_lines, table,
)
from scorewright.operators import drift as D
from scorewright.operators import feedback as FB
from scorewright.operators import label_store as LS
from scorewright.operators import metrics as M
from scorewright.operators.profile import baseline_stats
from scorewright.plans.monitoring import monitor
from scorewright.session import stage
from scorewright.sources.writers import append_rows

NUMERIC, CATEGORICAL = ["l_extendedprice", "l_quantity"], ["l_returnflag"]


def values_sql(columns, keys: str = "", cast: str = "DOUBLE", ref="ref", cur="cur") -> str:
    k = f"{keys}, " if keys else ""
    return " UNION ALL ".join(
        f"SELECT {k}'{c}' AS feature, {c}::{cast} AS value, {side} AS side FROM {source}"
        for c in columns
        for side, source in ((0, ref), (1, cur))
    )


def ecdf_sql(columns, keys: str = "", ref="ref", cur="cur", name="") -> str:
    """CTEs vals, cnt, ecdf and ks of numeric features."""
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {k}feature"
    lam = "statistic * sqrt(n * m / (n + m))"
    series = f"list_sum([CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END * exp(-2 * i * i * pow({lam}, 2)) FOR i IN range(1, 101)])"
    return f"""{name}vals AS ({values_sql(columns, keys, ref=ref, cur=cur)}),
{name}cnt AS (SELECT {k}feature, value, count(*) FILTER (side = 0) AS r, count(*) FILTER (side = 1) AS c
    FROM {name}vals WHERE value IS NOT NULL GROUP BY ALL),
{name}ecdf AS (SELECT *, sum(r) OVER w / sum(r) OVER ({part}) AS f1, sum(c) OVER w / sum(c) OVER ({part}) AS f2,
    lead(value) OVER w AS nxt FROM {name}cnt WINDOW w AS ({part} ORDER BY value)),
{name}raw_ks AS (SELECT {k}feature, max(abs(f1 - f2)) AS statistic, sum(abs(f1 - f2) * (nxt - value)) AS wasserstein,
    sum(r)::DOUBLE AS n, sum(c)::DOUBLE AS m, sum(value * r) / sum(r) AS ref_mean, sum(value * c) / sum(c) AS cur_mean
    FROM {name}ecdf GROUP BY ALL),
{name}ks AS (SELECT *, CASE WHEN {lam} < 0.2 THEN 1 ELSE greatest(0, least(1, 2 * {series})) END AS p FROM {name}raw_ks)"""


def chi2_sql(columns, keys: str = "", ref="ref", cur="cur") -> str:
    """CTEs of the chi-square statistic; p for two degrees of freedom only."""
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {k}feature"
    return f"""cvals AS ({values_sql(columns, keys, 'VARCHAR', ref, cur)}),
ccnt AS (SELECT {k}feature, value, count(*) FILTER (side = 0)::DOUBLE AS r, count(*) FILTER (side = 1)::DOUBLE AS c
    FROM cvals WHERE value IS NOT NULL GROUP BY ALL),
ctot AS (SELECT *, sum(r) OVER ({part}) AS rt, sum(c) OVER ({part}) AS ct FROM ccnt),
chi AS (SELECT {k}feature, sum(pow(r * ct - c * rt, 2) / ((r + c) * rt * ct)) AS statistic,
    count(*) - 1 AS dof, max(rt)::BIGINT AS n, max(ct)::BIGINT AS m FROM ctot GROUP BY ALL)"""


def rounded(df, names, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in names})


@query(
    "ecdf_pair",
    f"""WITH {PERIODS_SQL}, {ecdf_sql(['l_quantity', 'l_tax'])} SELECT feature, value, round(f1, 6) AS cdf_reference,
        round(f2, 6) AS cdf_current FROM ecdf""",
)
def ecdf_pair(spark, sf):
    rows = D.ecdf_pair(*periods(spark, sf), ["l_quantity", "l_tax"])
    return rounded(rows.select("feature", "value", "cdf_reference", "cdf_current"), ["cdf_reference", "cdf_current"])


KS_OUT = """feature, round(statistic, 6) AS statistic, round(p, 6) AS drift_score, p < 0.05 AS drift_detected"""


@query("ks_two_sample", f"WITH {PERIODS_SQL}, {ecdf_sql(NUMERIC)} SELECT {KS_OUT} FROM ks")
def ks_two_sample(spark, sf):
    features, _ = D.drift(*periods(spark, sf), NUMERIC)
    return rounded(features.select("feature", "statistic", "drift_score", "drift_detected"), ["statistic", "drift_score"])


@query(
    "ks_two_sample_grouped",
    f"""WITH {PERIODS_SQL}, {ecdf_sql(NUMERIC, 'l_suppkey')} SELECT l_suppkey, {KS_OUT} FROM ks""",
)
def ks_two_sample_grouped(spark, sf):
    features, _ = D.drift(*periods(spark, sf), NUMERIC, keys=["l_suppkey"])
    cols = ["l_suppkey", "feature", "statistic", "drift_score", "drift_detected"]
    return rounded(features.select(cols), ["statistic", "drift_score"])


@query(
    "chi2_categorical",
    f"""WITH {PERIODS_SQL}, {chi2_sql(['l_returnflag', 'l_linestatus'])} SELECT feature, round(statistic, 6) AS statistic,
        dof, n AS n_reference, m AS n_current, CASE WHEN dof = 2 THEN exp(-statistic / 2) < 0.05
        ELSE statistic > 3.841458820694124 END AS drift_detected FROM chi""",
)
def chi2_categorical(spark, sf):
    features, _ = D.drift(*periods(spark, sf), [], ["l_returnflag", "l_linestatus"])
    cols = ["feature", "statistic", "dof", "n_reference", "n_current", "drift_detected"]
    return rounded(features.select(cols), ["statistic"])


@query(
    "drift_missing_feature",
    f"""WITH {PERIODS_SQL}, n AS (SELECT (SELECT count(*) FROM ref) AS r, (SELECT count(*) FROM cur) AS c)
        SELECT 'l_tax' AS feature, r AS n_reference, 0::BIGINT AS n_current, c AS missing_current, true AS drift_detected FROM n
        UNION ALL SELECT 'l_discount', 0, c, 0, true FROM n
        UNION ALL SELECT 'l_returnflag', r, 0, c, true FROM n
        UNION ALL SELECT 'l_linestatus', 0, 0, c, false FROM n""",
)
def drift_missing_feature(spark, sf):
    ref, cur = periods(spark, sf)
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    ref = ref.withColumns({"l_discount": F.lit(float("nan")), "l_linestatus": no_text})
    cur = cur.withColumns({"l_tax": no_number, "l_returnflag": no_text, "l_linestatus": no_text})
    features, _ = D.drift(ref, cur, ["l_tax", "l_discount"], ["l_returnflag", "l_linestatus"])
    return features.select("feature", "n_reference", "n_current", "missing_current", "drift_detected")


@query(
    "wasserstein",
    f"WITH {PERIODS_SQL}, {ecdf_sql(NUMERIC)} SELECT feature, round(wasserstein, 6) AS wasserstein FROM ks",
)
def wasserstein(spark, sf):
    features, _ = D.drift(*periods(spark, sf), NUMERIC)
    return rounded(features.select("feature", "wasserstein"), ["wasserstein"])


@query(
    "mean_shift",
    f"""WITH {PERIODS_SQL} """
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round((SELECT avg({c}) FROM ref), 6) AS reference_mean,
        round((SELECT avg({c}) FROM cur), 6) AS current_mean,
        round((SELECT avg({c}) FROM cur) - (SELECT avg({c}) FROM ref), 6) AS shift"""
        for c in NUMERIC
    ),
)
def mean_shift(spark, sf):
    rows = D.mean_shift(*periods(spark, sf), NUMERIC)
    return rounded(rows, ["reference_mean", "current_mean", "shift"])


@query(
    "baseline_join",
    f"""WITH {PERIODS_SQL} """
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, r AS baseline_mean, f AS current_mean FROM
        (SELECT round(avg({c}), 6) AS r FROM ref), (SELECT round(avg({c}), 6) AS f FROM cur)"""
        for c in NUMERIC
    )
    + " UNION ALL SELECT 'l_tax', (SELECT round(avg(l_tax), 6) FROM ref), NULL",
)
def baseline_join(spark, sf):
    ref, cur = periods(spark, sf)
    base = baseline_stats(ref, [*NUMERIC, "l_tax"]).select("feature", "mean")
    joined = D.baseline_join(baseline_stats(cur, NUMERIC).select("feature", "mean"), base)
    return rounded(joined, ["baseline_mean", "current_mean"])


def flags_sql(keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    return f"""{ecdf_sql(NUMERIC, keys)}, {chi2_sql(CATEGORICAL, keys)},
flags AS (SELECT {k}feature, p < 0.05 AS hit FROM ks UNION ALL SELECT {k}feature, exp(-statistic / 2) < 0.05 FROM chi),
shares AS (SELECT {k}count(*) FILTER (hit) AS n_drifted_features, count(*) AS n_features_tested,
    count(*) FILTER (hit) / greatest(count(*), 1) AS share FROM flags GROUP BY ALL)"""


@query(
    "drift_counts",
    f"""WITH {PERIODS_SQL}, {flags_sql('l_suppkey')} SELECT l_suppkey, n_drifted_features, n_features_tested,
        round(share, 6) AS drift_share, round(share * 100, 1) AS drift_percentage FROM shares""",
)
def drift_counts(spark, sf):
    features, _ = D.drift(*periods(spark, sf), NUMERIC, CATEGORICAL, ["l_suppkey"])
    return rounded(D.drift_counts(features, ["l_suppkey"]), ["drift_share"])


@query(
    "dataset_drift",
    f"""WITH {PERIODS_SQL}, {flags_sql()} SELECT n_drifted_features, n_features_tested, round(share, 6) AS drift_share,
        round(share * 100, 1) AS drift_percentage, share >= 0.5 AS overall_drift_detected FROM shares""",
)
def dataset_drift(spark, sf):
    _, data = D.drift(*periods(spark, sf), NUMERIC, CATEGORICAL)
    return rounded(data, ["drift_share"])


@query(
    "common_columns",
    f"""WITH {PERIODS_SQL} SELECT feature, (SELECT count(*) FROM ref) AS n_reference, (SELECT count(*) FROM cur) AS n_current
        FROM (VALUES ('l_quantity'), ('l_tax')) v(feature)""",
)
def common_columns(spark, sf):
    ref, cur = periods(spark, sf)
    shared = D.common_columns(ref.drop("l_discount"), cur, ["l_quantity", "l_discount", "l_tax", "absent"])
    counts = D.paired_counts(ref, cur, shared)
    return counts.groupBy("feature").agg(F.sum("r").alias("n_reference"), F.sum("c").alias("n_current"))


PRED_SQL = """round(abs(avg(prediction) - 0.38::DOUBLE), 4) AS absolute_shift,
    abs(avg(prediction) - 0.38::DOUBLE) > 0.05 AS prediction_drift_detected"""


@query(
    "prediction_drift",
    f"""WITH {LOG_SQL} SELECT lang, 0.38::DOUBLE AS baseline_positive_rate, round(avg(prediction), 6) AS current_positive_rate,
        {PRED_SQL} FROM log GROUP BY 1""",
)
def prediction_drift(spark, sf):
    rows = D.prediction_drift(prediction_log(spark, sf), keys=["lang"])
    return rounded(rows, ["current_positive_rate"])


@query(
    "prediction_distribution_drift",
    f"""WITH {SCORED}, ref AS (SELECT * FROM scored WHERE l_shipdate < TIMESTAMP '1998-01-01'),
        cur AS (SELECT * FROM scored WHERE l_shipdate >= TIMESTAMP '1998-01-01'),
        {ecdf_sql(['p'])}, {chi2_sql(['prediction'])}
        SELECT feature, round(statistic, 6) AS statistic, p < 0.05 AS drift_detected FROM ks
        UNION ALL SELECT feature, round(statistic, 6), statistic > 3.841458820694124 FROM chi""",
)
def prediction_distribution_drift(spark, sf):
    rows = scored_lines(spark, sf)
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    ref, cur = rows.where(F.col("l_shipdate") < cut), rows.where(F.col("l_shipdate") >= cut)
    features, _ = D.drift(ref, cur, ["p"], ["prediction"])
    return rounded(features.select("feature", "statistic", "drift_detected"), ["statistic"])


MATCH_SQL = f"""{LOG_SQL}, {ARRIVALS_SQL},
joined AS (SELECT log.*, ground_truth FROM log LEFT JOIN newest ON log.doc_id = newest.doc_id)"""
CONCEPT_SQL = """concept AS (SELECT lang, coalesce(0.8::DOUBLE - acc > 0.03, false) AS concept_drift_detected, 0.8::DOUBLE AS baseline_accuracy,
    round(acc, 6) AS current_accuracy, round(0.8::DOUBLE - acc, 6) AS performance_drop, n AS samples_evaluated,
    CASE WHEN coalesce(0.8::DOUBLE - acc > 0.03, false) THEN 'Concept drift detected' WHEN n = 0 THEN 'No ground truth'
        ELSE 'Performance within acceptable range' END AS reason
    FROM (SELECT lang, count(ground_truth) AS n, avg((prediction = ground_truth)::INT) FILTER (ground_truth IS NOT NULL) AS acc
        FROM joined GROUP BY 1))"""


def _joined(spark, sf):
    return FB.label_join(prediction_log(spark, sf), late_label_rows(spark, sf), "doc_id", "doc_id", "label", ["arrival"])


@query("concept_drift", f"WITH {MATCH_SQL}, {CONCEPT_SQL} SELECT * FROM concept")
def concept_drift(spark, sf):
    rows = D.concept_drift(M.metrics(_joined(spark, sf), "ground_truth", "prediction", None, ["lang"]), keys=["lang"])
    return rounded(rows.drop("threshold"), ["current_accuracy", "performance_drop"])


@query(
    "quality_compare",
    f"""WITH {PERIODS_SQL}, r AS (SELECT NULLIF(l_discount, 0::DOUBLE) AS d, l_extendedprice AS e, NULLIF(l_returnflag, 'A') AS f FROM ref),
        c AS (SELECT NULLIF(l_discount, 0::DOUBLE) AS d, l_extendedprice AS e, CASE WHEN l_quantity = 50 THEN 'X' ELSE NULLIF(l_returnflag, 'A') END AS f FROM cur),
        s AS (SELECT round(1 - count(d) / count(*), 4) AS d, round(1 - count(f) / count(*), 4) AS f FROM r),
        t AS (SELECT round(1 - count(d) / count(*), 4) AS d, round(1 - count(f) / count(*), 4) AS f FROM c)
        SELECT 'discount' AS "column", s.d AS reference_missing_rate, t.d AS current_missing_rate, false AS out_of_range, 0::BIGINT AS new_values,
            round(t.d - s.d, 6) AS missing_rate_change FROM s, t
        UNION ALL SELECT 'l_extendedprice', 0, 0, (SELECT min(e) FROM c) < (SELECT min(e) FROM r) OR (SELECT max(e) FROM c) > (SELECT max(e) FROM r), 0, 0
        UNION ALL SELECT 'flag', s.f, t.f, false, 1, round(t.f - s.f, 6) FROM s, t""",
)
def quality_compare(spark, sf):
    ref, cur = periods(spark, sf)
    holes = {"discount": F.nullif("l_discount", F.lit(0.0)), "flag": F.nullif("l_returnflag", F.lit("A"))}
    ref, cur = ref.withColumns(holes), cur.withColumns(holes)
    cur = cur.withColumn("flag", F.when(F.col("l_quantity") == 50, "X").otherwise(F.col("flag")))
    rows = D.quality_compare(ref, cur, ["discount", "l_extendedprice"], ["flag"])
    return rounded(rows, ["missing_rate_change"])


# ---- summary, severity and alerts by segment ----

SIDES_SQL = f"""{LOG_SQL}, {ARRIVALS_SQL},
joined AS (SELECT log.*, ground_truth FROM log LEFT JOIN newest ON log.doc_id = newest.doc_id),
ref AS (SELECT * FROM log WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
cur AS (SELECT * REPLACE (CASE WHEN lang IN ('de', 'es') THEN n_chars * 3 ELSE n_chars END AS n_chars) FROM joined)"""
SUMMARY_SQL = f"""{SIDES_SQL}, {ecdf_sql(['n_chars', 'probability'], 'lang')}, {CONCEPT_SQL},
shares AS (SELECT lang, count(*) FILTER (p < 0.05) / count(*) AS share FROM ks GROUP BY 1),
pred AS (SELECT lang, abs(avg(prediction) - 0.38::DOUBLE) > 0.05 AS hit FROM cur GROUP BY 1),
summary AS (SELECT s.lang, share >= 0.5 AS data_drift_detected, concept_drift_detected, hit AS prediction_drift_detected,
    round(share * 100, 1) AS drift_percentage, share >= 0.5 OR concept_drift_detected OR hit AS any_drift_detected
    FROM shares s JOIN concept USING (lang) JOIN pred USING (lang)),
graded AS (SELECT *, CASE WHEN concept_drift_detected AND data_drift_detected THEN 'CRITICAL'
    WHEN concept_drift_detected OR drift_percentage > 50 THEN 'HIGH' WHEN drift_percentage > 20 THEN 'MEDIUM'
    WHEN data_drift_detected THEN 'LOW' ELSE 'NONE' END AS severity FROM summary),
texts AS (SELECT * FROM (VALUES
    ('CRITICAL', 'Immediate retraining required. Both data and concept drift detected.'),
    ('HIGH', 'Retraining strongly recommended. Significant drift detected.'),
    ('MEDIUM', 'Monitor closely. Consider retraining in next sprint.'),
    ('LOW', 'Minor data drift. No immediate action required.'),
    ('NONE', 'No drift detected. Model is healthy.')) t(severity, recommendation))"""


def _run(spark, sf):
    log, labels = prediction_log(spark, sf), table(spark, sf, "labels")
    ref = FB.unmatched(log, labels, "doc_id", "doc_id")
    longer = F.when(F.col("lang").isin("de", "es"), F.col("n_chars") * 3).otherwise(F.col("n_chars"))
    return monitor(
        ref, log.withColumn("n_chars", longer), late_label_rows(spark, sf), ["n_chars", "probability"], [],
        "doc_id", "doc_id", "label", ["arrival"], keys=["lang"],
    )


FLAGS = ["data_drift_detected", "concept_drift_detected", "prediction_drift_detected", "drift_percentage", "any_drift_detected"]


@query("monitoring_summary", f"WITH {SUMMARY_SQL} SELECT * FROM summary")
def monitoring_summary(spark, sf):
    return _run(spark, sf).analysis.select("lang", *FLAGS)


@query("severity", f"WITH {SUMMARY_SQL} SELECT lang, severity FROM graded")
def severity(spark, sf):
    return _run(spark, sf).analysis.select("lang", "severity")


@query(
    "recommendation",
    f"""WITH {SUMMARY_SQL} SELECT lang, severity, severity IN ('CRITICAL', 'HIGH') AS action_required, recommendation
        FROM graded JOIN texts USING (severity)""",
)
def recommendation(spark, sf):
    return _run(spark, sf).analysis.select("lang", "severity", "action_required", "recommendation")


GATE_SQL = f"""{SUMMARY_SQL},
gated AS (SELECT g.lang, CASE WHEN g.lang <> 'fr' THEN g.severity WHEN concept_drift_detected AND data_drift_detected THEN 'HIGH'
        WHEN concept_drift_detected THEN 'MEDIUM' WHEN data_drift_detected THEN 'LOW' ELSE 'NONE' END AS severity,
    t.recommendation AS text, any_drift_detected FROM graded g JOIN texts t USING (severity)),
alerts AS (SELECT lang, severity, CASE WHEN lang <> 'fr' THEN text ELSE 'Severity: ' || severity END AS recommendation,
    any_drift_detected FROM gated WHERE severity IN ('CRITICAL', 'HIGH', 'MEDIUM'))"""


def _alerts(spark, sf):
    """The analysis of 'fr' is missing, so it is graded from the raw flags."""
    analysis = stage(_run(spark, sf).analysis)  # read twice below: one row per group
    return D.alert_gate(analysis.where("lang <> 'fr'"), analysis.select("lang", *FLAGS), ["lang"])


@query("alert_gate", f"WITH {GATE_SQL} SELECT * FROM alerts")
def alert_gate(spark, sf):
    return _alerts(spark, sf)


@query(
    "alert_log",
    f"""WITH {GATE_SQL} SELECT severity, 'Data drift detected in production' AS message,
        CASE WHEN severity IN ('CRITICAL', 'HIGH') THEN 'error' ELSE 'warning' END AS log_level,
        json_object('lang', lang, 'severity', severity)::VARCHAR AS drift_details FROM alerts""",
)
def alert_log(spark, sf):
    path = fresh_dir(spark, "alerts")
    rows = D.alert_rows(_alerts(spark, sf), "Data drift detected in production", ["lang", "severity"])
    append_rows(rows, path)
    return spark.read.schema(rows.schema).parquet(path).drop("timestamp")


@query(
    "retrain_recommendation",
    f"""WITH {GATE_SQL} SELECT lang, 'RETRAIN' AS recommendation, 'Drift detected in production' AS reason,
        'Start the training job' AS action_required, 'build-1' AS build, TIMESTAMP '2024-02-01 06:30:00' AS timestamp FROM alerts""",
)
def retrain_recommendation(spark, sf):
    at = F.lit("2024-02-01 06:30:00").cast("timestamp_ntz")
    return D.retrain_rows(_alerts(spark, sf), "Start the training job", "build-1", ["lang"], at)


# ---- feedback loop ----


@query(
    "log_predictions",
    f"""WITH {LOG_SQL} SELECT r.run_id, lang, count(*) AS n, count(DISTINCT doc_id) AS n_ids FROM log,
        (VALUES ('run-1'), ('run-2')) r(run_id) GROUP BY 1, 2""",
)
def log_predictions(spark, sf):
    path = fresh_dir(spark, "prediction-log")
    rows = prediction_log(spark, sf)
    for run in ("run-1", "run-2", "run-2"):  # re-running a run must not duplicate it
        FB.log_predictions(rows, path, ["doc_id"], run)
    return spark.read.parquet(path).groupBy("run_id", "lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("inference_id").alias("n_ids")
    )


@query(
    "submit_labels",
    f"WITH {LOG_SQL}, {ARRIVALS_SQL} SELECT count(*) AS updated FROM log WHERE doc_id IN (SELECT doc_id FROM newest)",
)
def submit_labels(spark, sf):
    return FB.submit_labels(
        prediction_log(spark, sf), late_label_rows(spark, sf), "doc_id", "doc_id", "label", ["arrival"]
    )


@query(
    "submit_labels_table",
    f"""WITH {SCORED}, lab AS (SELECT o_orderkey AS id, (o_orderstatus = 'F')::INT AS outcome FROM orders WHERE o_orderpriority <> '5-LOW')
        SELECT row_key, prediction, outcome AS ground_truth, id IS NOT NULL AS feedback_received
        FROM scored LEFT JOIN lab ON scored.l_orderkey = lab.id""",
)
def submit_labels_table(spark, sf):
    orders = table(spark, sf, "orders").where("o_orderpriority <> '5-LOW'")
    labels = orders.select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").cast("int").alias("outcome"))
    joined = FB.label_join(scored_lines(spark, sf), labels, "l_orderkey", "id", "outcome", ["outcome"])
    return joined.select("row_key", "prediction", "ground_truth", "feedback_received")


@query(
    "matched_data",
    f"WITH {MATCH_SQL} SELECT doc_id, lang, prediction, ground_truth AS actual_label FROM joined WHERE ground_truth IS NOT NULL",
)
def matched_data(spark, sf):
    return FB.matched(_joined(spark, sf), 0.3).select("doc_id", "lang", "prediction", "actual_label")


@query(
    "min_coverage_gate",
    f"""WITH {MATCH_SQL}, cov AS (SELECT source, count(ground_truth) / count(*) AS share FROM joined GROUP BY 1)
        SELECT doc_id, source, ground_truth AS actual_label FROM joined
        WHERE ground_truth IS NOT NULL AND source IN (SELECT source FROM cov WHERE share >= 0.4)""",
)
def min_coverage_gate(spark, sf):
    return FB.matched(_joined(spark, sf), 0.4, ["source"]).select("doc_id", "source", "actual_label")


@query(
    "coverage_report",
    f"""WITH {MATCH_SQL}, langs AS (SELECT lang FROM joined UNION SELECT 'xx'),
        c AS (SELECT langs.lang, count(joined.lang) AS n, count(ground_truth) AS m FROM langs LEFT JOIN joined ON joined.lang = langs.lang GROUP BY 1)
        SELECT lang, n AS total_predictions, m AS feedback_received, round(m / greatest(n, 1), 4) AS coverage_fraction,
        round(m / greatest(n, 1) * 100, 2) AS coverage_percent, TIMESTAMP '2024-02-01' AS timestamp,
        CASE WHEN n = 0 THEN 'No predictions logged yet' END AS message FROM c""",
)
def coverage_report(spark, sf):
    """One language is expected and was never logged."""
    joined = _joined(spark, sf)
    expected = joined.select("lang").unionByName(spark.range(1).select(F.lit("xx").alias("lang")))
    return FB.coverage(joined, ["lang"], F.lit("2024-02-01").cast("timestamp_ntz"), expected)


@query(
    "label_store",
    f"""WITH {LOG_SQL}, r AS (SELECT doc_id, prediction, quality, toxic, labels.doc_id IS NOT NULL AS hit FROM log LEFT JOIN labels USING (doc_id)),
        s AS (SELECT unnest(['read', 'stored']) AS how)
        SELECT how, run_id, r.doc_id, prediction, CASE WHEN toxic = 1 THEN 1 - quality ELSE quality END AS ground_truth, hit AS feedback_received,
            CASE WHEN hit THEN CASE WHEN toxic = 1 THEN 1707091200 ELSE 1706745600 END END AS received_at
        FROM r, s, (VALUES ('run-1'), ('run-2')) v(run_id)""",
)
def label_store(spark, sf):
    """Two runs logged, labels in three batches: the second overrides the toxic ones, an older one comes last
    and changes nothing. Read before the batches are folded, and from the files after it."""
    root = fresh_dir(spark, "label-store")
    for run in ("run-1", "run-2", "run-2"):
        LS.log_run(prediction_log(spark, sf), root, ["doc_id"], run, "doc_id", buckets=8)
    labels = table(spark, sf, "labels")
    flipped = labels.where("toxic = 1").withColumn("quality", 1 - F.col("quality"))
    wrong = labels.withColumn("quality", F.lit(-1))
    for rows, batch, day in ((labels, "a", "2024-02-01"), (flipped, "b", "2024-02-05"), (labels, "a", "2024-02-01"), (wrong, "c", "2024-01-20")):
        LS.submit(rows, root, "doc_id", "quality", batch, F.lit(f"{day}T00:00:00Z"), buckets=8)
    read = stage(LS.read_log(spark, root, "doc_id").withColumn("how", F.lit("read")))
    LS.compact(spark, root, "doc_id", "first")
    stored = LS.stored_log(spark, root).withColumn("how", F.lit("stored"))
    return read.unionByName(stored).select(
        "how", "run_id", "doc_id", "prediction", "ground_truth", "feedback_received", F.unix_seconds("feedback_received_at").alias("received_at")
    )


@query(
    "simulate_feedback",
    f"""WITH {LOG_SQL} SELECT count(*) AS updated FROM log WHERE doc_id IN (SELECT doc_id FROM (
        SELECT doc_id, row_number() OVER (ORDER BY {key_hash_sql(42, "doc_id")}) <= floor(count(*) OVER () * 0.8::DOUBLE + 0.5) AS picked
        FROM labels) WHERE picked)""",
)
def simulate_feedback(spark, sf):
    return FB.simulate_feedback(prediction_log(spark, sf), table(spark, sf, "labels"), "doc_id", "doc_id", "quality")
