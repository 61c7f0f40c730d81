"""Queries over profiles, summaries, rankings and set comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorewright.catalog.base import (
    ARRIVALS_SQL, LOG_SQL, RAW_SQL, SCORED, late_label_rows, prediction_log, query, raw_lines,
    scored_lines, table,
)
from scorewright.functions.columns import extract_first
from scorewright.operators import drift as DR
from scorewright.operators import feedback as FB
from scorewright.operators import profile as P
from scorewright.operators.joins import lookup_join
from scorewright.operators.model import class_weights
from scorewright.operators.ordered import modes, quantiles


@query("count_rows", "SELECT count(*) AS row_count, 11 AS column_count FROM lineitem")
def count_rows(spark, sf):
    return P.table_shape(table(spark, sf, "lineitem"))


@query(
    "median",
    f"""WITH {RAW_SQL} SELECT 'discount' AS feature, round(quantile_cont(discount, 0.5), 6) AS median FROM raw
        UNION ALL SELECT 'l_extendedprice', round(quantile_cont(l_extendedprice, 0.5), 6) FROM raw""",
)
def median(spark, sf):
    rows = quantiles(raw_lines(spark, sf), ["discount", "l_extendedprice"])
    return rows.select("feature", F.round("median", 6).alias("median"))


@query(
    "median_grouped",
    f"""WITH {RAW_SQL} SELECT l_linestatus, 'l_extendedprice' AS feature,
        round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25,
        round(quantile_cont(l_extendedprice, 0.75), 6) AS p75 FROM raw GROUP BY 1""",
)
def median_grouped(spark, sf):
    """The path for groups too large for an aggregation buffer."""
    rows = quantiles(table(spark, sf, "lineitem"), ["l_extendedprice"], (0.5, 0.25, 0.75), ["l_linestatus"], buffer_rows=0)
    return rows.select("l_linestatus", "feature", *[F.round(c, 6).alias(c) for c in ("median", "p25", "p75")])


@query(
    "mode",
    """SELECT 'o_orderpriority' AS feature, (SELECT o_orderpriority FROM orders GROUP BY 1
        ORDER BY count(*) DESC, o_orderpriority LIMIT 1) AS mode
       UNION ALL SELECT 'o_orderstatus', (SELECT o_orderstatus FROM orders GROUP BY 1
        ORDER BY count(*) DESC, o_orderstatus LIMIT 1)""",
)
def mode(spark, sf):
    return modes(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"])


STATS = ["mean", "std", "min", "max", "median", "p25", "p75"]


def profile_sql(c: str, dtype: str, source: str) -> str:
    return f"""SELECT '{c}' AS "column", '{dtype}' AS dtype, count(*) AS n_rows, count(*) - count({c}) AS missing_count,
        round((count(*) - count({c})) / count(*), 4) AS missing_rate, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max,
        round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.25), 6) AS p25,
        round(quantile_cont({c}, 0.75), 6) AS p75 FROM {source}"""


@query(
    "profile_numeric",
    f"WITH {RAW_SQL} "
    + " UNION ALL ".join(
        profile_sql(c, t, "raw")
        for c, t in [("l_quantity", "double"), ("l_extendedprice", "double"), ("discount", "double"), ("l_linenumber", "int")]
    ),
)
def profile_numeric(spark, sf):
    rows = P.profile_numeric(raw_lines(spark, sf), ["l_quantity", "l_extendedprice", "discount", "l_linenumber"])
    return rows.withColumns({c: F.round(c, 6) for c in STATS})


def counts_sql(c: str) -> str:
    return f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM raw GROUP BY 2"


COUNTS_SQL = f"{RAW_SQL}, counts AS ({counts_sql('flag')} UNION ALL {counts_sql('quantity_text')})"
RANKED_SQL = """ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value NULLS LAST)::INT AS rank
    FROM counts)"""


@query(
    "profile_categorical",
    f"""WITH {COUNTS_SQL}, {RANKED_SQL} SELECT "column", sum(n)::BIGINT AS n_rows,
        coalesce(sum(n) FILTER (value IS NULL), 0)::BIGINT AS missing_count, count(value) AS unique_count,
        round(coalesce(sum(n) FILTER (value IS NULL), 0) / sum(n), 4) AS missing_rate,
        string_agg(coalesce(value, 'nan') || '=' || n, ',' ORDER BY rank) FILTER (rank <= 10) AS top_values
        FROM ranked GROUP BY 1""",
)
def profile_categorical(spark, sf):
    rows = P.profile_categorical(raw_lines(spark, sf), ["flag", "quantity_text"])
    pairs = F.transform(F.map_entries("top_values"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return rows.withColumn("top_values", F.array_join(pairs, ","))


@query("top_values_rank", f"WITH {COUNTS_SQL}, {RANKED_SQL} SELECT * FROM ranked WHERE rank <= 10")
def top_values_rank(spark, sf):
    return P.top_values(P.value_counts(raw_lines(spark, sf), ["flag", "quantity_text"]))


@query("positive_rate", "SELECT round(avg(quality), 6) AS target_positive_rate FROM labels")
def positive_rate(spark, sf):
    return table(spark, sf, "labels").agg(F.round(P.positive_rate("quality"), 6).alias("target_positive_rate"))


@query(
    "baseline_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min,
        max({c}) AS max, round(quantile_cont({c}, 0.5), 6) AS median FROM lineitem"""
        for c in ("l_quantity", "l_discount", "l_tax")
    ),
)
def baseline_stats(spark, sf):
    rows = P.baseline_stats(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    return rows.withColumns({c: F.round(c, 6) for c in ("mean", "std", "median")})


SUMMARY = """count(*) AS total_predictions, count(*) FILTER (prediction = 1) AS positive_predictions,
    count(*) FILTER (prediction = 0) AS negative_predictions, round(avg(confidence), 6) AS average_confidence,
    min(confidence) AS min_confidence, max(confidence) AS max_confidence"""
CONFIDENT = "(SELECT *, round(greatest(p, 1::DOUBLE - p), 6) AS confidence FROM scored)"


def confident(spark, sf):
    p = F.col("p")
    return scored_lines(spark, sf).withColumn("confidence", F.round(F.greatest(p, 1.0 - p), 6))


@query("scoring_summary", f"WITH {SCORED} SELECT {SUMMARY} FROM {CONFIDENT}")
def scoring_summary(spark, sf):
    return P.scoring_summary(confident(spark, sf)).withColumn("average_confidence", F.round("average_confidence", 6))


@query(
    "batch_survival_rate",
    f"""WITH {SCORED} SELECT l_orderkey, count(*) AS total, count(*) FILTER (prediction = 1) AS positive_count,
        round(count(*) FILTER (prediction = 1) / count(*), 4) AS positive_rate FROM scored GROUP BY 1""",
)
def batch_survival_rate(spark, sf):
    return P.batch_rate(scored_lines(spark, sf), ["l_orderkey"])


@query(
    "coverage",
    f"""WITH {LOG_SQL} SELECT count(*) AS total_predictions, count(l.doc_id) AS feedback_received,
        round(count(l.doc_id) / count(*), 4) AS coverage_fraction, round(count(l.doc_id) / count(*) * 100, 2) AS coverage_percent
        FROM log LEFT JOIN labels l ON log.doc_id = l.doc_id""",
)
def coverage(spark, sf):
    labels = table(spark, sf, "labels")
    joined = FB.label_join(prediction_log(spark, sf), labels, "doc_id", "doc_id", "quality", ["quality"])
    return FB.coverage(joined).drop("timestamp", "message")


@query(
    "class_weights",
    """SELECT quality, count(*) AS n_class, round((SELECT count(*) FROM labels)
        / ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 6) AS weight FROM labels GROUP BY 1""",
)
def class_weights_query(spark, sf):
    return class_weights(table(spark, sf, "labels"), "quality").withColumn("weight", F.round("weight", 6))


@query(
    "grouped_rollup",
    f"""WITH {SCORED} SELECT l_linestatus, l_returnflag, grouping(l_linestatus, l_returnflag) AS level, {SUMMARY}
        FROM {CONFIDENT} GROUP BY ROLLUP (l_linestatus, l_returnflag)""",
)
def grouped_rollup(spark, sf):
    aggs = [
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if(F.col("prediction") == 1).alias("positive_predictions"),
        F.count_if(F.col("prediction") == 0).alias("negative_predictions"),
        F.round(F.avg("confidence"), 6).alias("average_confidence"),
        F.min("confidence").alias("min_confidence"),
        F.max("confidence").alias("max_confidence"),
    ]
    return P.rollup_summary(confident(spark, sf), ["l_linestatus", "l_returnflag"], aggs)


@query(
    "grouped_cube",
    f"""WITH {LOG_SQL} SELECT lang, source, grouping(lang, source) AS level, count(*) AS n,
        round(avg(prediction), 6) AS rate FROM log GROUP BY CUBE (lang, source)""",
)
def grouped_cube(spark, sf):
    aggs = [F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 6).alias("rate")]
    return P.rollup_summary(prediction_log(spark, sf), ["lang", "source"], aggs, "cube")


# ---- joins on the prediction log ----


@query(
    "label_join",
    f"""WITH {LOG_SQL}, {ARRIVALS_SQL} SELECT log.doc_id, lang, prediction, ground_truth,
        newest.doc_id IS NOT NULL AS feedback_received FROM log LEFT JOIN newest ON log.doc_id = newest.doc_id""",
)
def label_join(spark, sf):
    joined = FB.label_join(prediction_log(spark, sf), late_label_rows(spark, sf), "doc_id", "doc_id", "label", ["arrival"])
    return joined.select("doc_id", "lang", "prediction", "ground_truth", "feedback_received")


@query("label_dedupe_last", f"WITH {ARRIVALS_SQL} SELECT doc_id::VARCHAR AS doc_key, ground_truth FROM newest")
def label_dedupe_last(spark, sf):
    newest = FB.latest_labels(late_label_rows(spark, sf), "doc_id", "label", ["arrival"])
    return newest.withColumnRenamed("_key", "doc_key")


@query("latest_label_per_key", f"WITH {ARRIVALS_SQL} SELECT doc_id, ground_truth AS label, 1 AS arrival FROM newest")
def latest_label_per_key(spark, sf):
    rows = late_label_rows(spark, sf)
    best = F.max_by(F.struct("label", "arrival"), "arrival")
    return rows.groupBy("doc_id").agg(best.alias("b")).select("doc_id", "b.label", "b.arrival")


@query(
    "matched_only",
    f"WITH {LOG_SQL} SELECT log.doc_id, prediction, quality FROM log JOIN labels l ON log.doc_id = l.doc_id",
)
def matched_only(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return lookup_join(prediction_log(spark, sf), labels, ["doc_id"], "inner").select("doc_id", "prediction", "quality")


@query(
    "unmatched_only",
    f"WITH {LOG_SQL} SELECT doc_id, prediction FROM log WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def unmatched_only(spark, sf):
    rows = FB.unmatched(prediction_log(spark, sf), table(spark, sf, "labels"), "doc_id", "doc_id")
    return rows.select("doc_id", "prediction")


# ---- set operations on category values ----

TITLE = "nullif(regexp_extract(text, ' ([A-Za-z]+)\\.', 1), '')"


def _titles(spark, sf, cond):
    docs = table(spark, sf, "documents").where(cond)
    return docs.select(extract_first("text").alias("value")).where("value IS NOT NULL").distinct()


@query(
    "unseen_categories",
    f"SELECT DISTINCT {TITLE} AS value FROM documents WHERE lang <> 'en' AND {TITLE} IS NOT NULL "
    f"EXCEPT SELECT {TITLE} FROM documents WHERE lang = 'en'",
)
def unseen_categories(spark, sf):
    return _titles(spark, sf, "lang <> 'en'").subtract(_titles(spark, sf, "lang = 'en'"))


@query(
    "shared_categories",
    f"SELECT DISTINCT {TITLE} AS value FROM documents WHERE n_chars < 1000 AND {TITLE} IS NOT NULL "
    f"INTERSECT SELECT {TITLE} FROM documents WHERE n_chars >= 1000",
)
def shared_categories(spark, sf):
    return _titles(spark, sf, "n_chars < 1000").intersect(_titles(spark, sf, "n_chars >= 1000"))


@query(
    "metric_trend",
    f"""WITH runs AS (SELECT l_linestatus, month(l_shipdate)::INT + 12 * year(l_shipdate)::INT AS run,
            round(avg(l_discount), 8) AS metric FROM lineitem GROUP BY 1, 2)
        SELECT l_linestatus, run, metric, lag(metric) OVER w AS previous, round(metric - lag(metric) OVER w, 8) AS change,
            round(avg(metric) OVER (PARTITION BY l_linestatus ORDER BY run ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 8)
            AS rolling_mean FROM runs WINDOW w AS (PARTITION BY l_linestatus ORDER BY run)""",
)
def metric_trend(spark, sf):
    run = F.month("l_shipdate") + 12 * F.year("l_shipdate")
    runs = table(spark, sf, "lineitem").groupBy("l_linestatus", run.alias("run")).agg(
        F.round(F.avg("l_discount"), 8).alias("metric")
    )
    rows = DR.metric_trend(runs, "metric", "run", ["l_linestatus"])
    return rows.withColumns({c: F.round(c, 8) for c in ("change", "rolling_mean")})
