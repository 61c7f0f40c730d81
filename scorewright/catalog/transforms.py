"""Queries over projections, filters, feature state, splits and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorewright.catalog.base import (
    CHAMPION, KEY_SQL, LOG_SQL, RAW_SQL, ROW_KEY, SCORED, Y_SQL, fresh_dir, key_hash_sql, planted_label, prediction_log,
    probability_sql, query, raw_lines, scored_lines, table,
)
from scorewright.functions import columns as C
from scorewright.operators import features as X
from scorewright.operators import model as M
from scorewright.operators import splits as S
from scorewright.operators.drift import feature_columns
from scorewright.operators.feedback import stamp
from scorewright.operators.joins import lookup_join
from scorewright.operators.validation import Field, RequestField, Schema, at_most, isin
from scorewright.plans.scoring import score_files, score_requests
from scorewright.sources.readers import flatten_json_column, flatten_requests
from scorewright.sources.writers import write_csv

TITLE_SQL = "nullif(regexp_extract(text, ' ([A-Za-z]+)\\.', 1), '')"


@query("select_features", "SELECT l_tax, l_quantity, l_discount FROM lineitem")
def select_features(spark, sf):
    return table(spark, sf, "lineitem").select("l_tax", "l_quantity", "l_discount")


@query("drop_if_exists", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def drop_if_exists(spark, sf):
    return table(spark, sf, "customer").drop("c_mktsegment", "c_cabin")


@query("regex_extract", f"SELECT doc_id, {TITLE_SQL} AS title FROM documents")
def regex_extract(spark, sf):
    return table(spark, sf, "documents").select("doc_id", C.extract_first("text").alias("title"))


@query(
    "remap_values",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'High' WHEN '2-HIGH' THEN 'High'
        WHEN '5-LOW' THEN 'Low' ELSE o_orderpriority END AS priority FROM orders""",
)
def remap_values(spark, sf):
    groups = {"1-URGENT": "High", "2-HIGH": "High", "5-LOW": "Low"}
    return table(spark, sf, "orders").select("o_orderkey", C.remap("o_orderpriority", groups).alias("priority"))


@query("arith_derive", f"SELECT {KEY_SQL} AS row_key, l_quantity + l_linenumber + 1 AS family_size FROM lineitem")
def arith_derive(spark, sf):
    return raw_lines(spark, sf).select("row_key", C.total_plus_one("l_quantity", "l_linenumber").alias("family_size"))


@query("flag_derive", f"SELECT {KEY_SQL} AS row_key, (l_linenumber = 1)::INT AS is_alone FROM lineitem")
def flag_derive(spark, sf):
    return raw_lines(spark, sf).select("row_key", C.flag(F.col("l_linenumber") == 1).alias("is_alone"))


QTY_EDGES, QTY_LABELS = [1.0, 12.0, 18.0, 35.0, 45.0], ["small", "medium", "large", "huge"]
QTY_SQL = """CASE WHEN l_quantity > 1 AND l_quantity <= 12 THEN 'small' WHEN l_quantity > 12 AND l_quantity <= 18
    THEN 'medium' WHEN l_quantity > 18 AND l_quantity <= 35 THEN 'large'
    WHEN l_quantity > 35 AND l_quantity <= 45 THEN 'huge' END"""


@query("bin_fixed", f"SELECT {KEY_SQL} AS row_key, {QTY_SQL} AS band FROM lineitem")
def bin_fixed(spark, sf):
    return raw_lines(spark, sf).select("row_key", C.bin_right_closed("l_quantity", QTY_EDGES, QTY_LABELS).alias("band"))


FARE_SQL = """CASE WHEN c_acctbal > -0.001 AND c_acctbal <= 7.91 THEN 'Q1' WHEN c_acctbal > 7.91 AND c_acctbal <= 14.45
    THEN 'Q2' WHEN c_acctbal > 14.45 AND c_acctbal <= 31.0 THEN 'Q3'
    WHEN c_acctbal > 31.0 AND c_acctbal <= 1000.0 THEN 'Q4' ELSE 'Q2' END"""
AGE_SQL = """CASE WHEN c_acctbal > 0 AND c_acctbal <= 12 THEN 'Child' WHEN c_acctbal > 12 AND c_acctbal <= 18
    THEN 'Teenager' WHEN c_acctbal > 18 AND c_acctbal <= 35 THEN 'Adult' WHEN c_acctbal > 35 AND c_acctbal <= 60
    THEN 'Middle-aged' WHEN c_acctbal > 60 AND c_acctbal <= 100 THEN 'Senior' ELSE 'Adult' END"""


@query("bin_fallback", f"SELECT c_custkey, {FARE_SQL} AS fare_band, {AGE_SQL} AS age_band FROM customer")
def bin_fallback(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        C.bin_right_closed("c_acctbal", C.FARE_EDGES, C.FARE_LABELS, C.FARE_DEFAULT).alias("fare_band"),
        C.bin_right_closed("c_acctbal", C.AGE_EDGES, C.AGE_LABELS, C.AGE_DEFAULT).alias("age_band"),
    )


MODE_SQL = "(SELECT flag FROM raw WHERE flag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, flag LIMIT 1)"
MED_SQL = "(SELECT quantile_cont(discount, 0.5) FROM raw)"


@query("impute_median", f"WITH {RAW_SQL} SELECT row_key, coalesce(discount, {MED_SQL}) AS discount FROM raw")
def impute_median(spark, sf):
    raw = raw_lines(spark, sf)
    medians, _ = X.fit_impute(raw, ["discount"], [])
    return X.impute(raw, medians, {}).select("row_key", "discount")


@query(
    "impute_median_grouped",
    f"""WITH {RAW_SQL}, med AS (SELECT l_suppkey, quantile_cont(discount, 0.5) AS m FROM raw GROUP BY 1)
        SELECT row_key, coalesce(discount, m) AS discount FROM raw JOIN med USING (l_suppkey)""",
)
def impute_median_grouped(spark, sf):
    return X.impute_grouped(raw_lines(spark, sf), ["discount"], ["l_suppkey"]).select("row_key", "discount")


@query("impute_mode", f"WITH {RAW_SQL} SELECT row_key, coalesce(flag, {MODE_SQL}) AS flag FROM raw")
def impute_mode(spark, sf):
    raw = raw_lines(spark, sf)
    _, most = X.fit_impute(raw, [], ["flag"])
    return X.impute(raw, {}, most).select("row_key", "flag")


@query(
    "clean_data",
    f"""WITH {RAW_SQL} SELECT row_key, coalesce(discount, {MED_SQL}) AS discount,
        coalesce(flag, {MODE_SQL}) AS flag, l_tax, status_text FROM raw""",
)
def clean_data(spark, sf):
    raw = raw_lines(spark, sf)
    cleaned = X.impute(raw, *X.fit_impute(raw, ["discount"], ["flag"]))
    return cleaned.select("row_key", "discount", "flag", "l_tax", "status_text")


@query("label_text", "SELECT doc_id, CASE WHEN quality = 1 THEN 'Good' ELSE 'Poor' END AS label FROM labels")
def label_text(spark, sf):
    return table(spark, sf, "labels").select("doc_id", C.label_text("quality", "Good", "Poor").alias("label"))


@query(
    "format_scored_line",
    f"""WITH {SCORED} SELECT concat_ws(',', row_key, prediction, printf('%.4f', p),
        CASE WHEN prediction = 1 THEN 'Survived' ELSE 'Did not survive' END) AS line FROM scored""",
)
def format_scored_line(spark, sf):
    rows = scored_lines(spark, sf).withColumn("label", C.label_text("prediction", "Survived", "Did not survive"))
    return rows.select(C.scored_line("row_key", "prediction", "p", "label").alias("line"))


@query(
    "round_report",
    """SELECT l_suppkey, round(round(avg(l_discount), 10), 4) AS d4, round(round(avg(l_tax) * 100, 10), 2) AS d2,
        round(round(avg(l_quantity), 10), 1) AS d1 FROM lineitem GROUP BY 1""",
)
def round_report(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.round(F.round(F.avg("l_discount"), 10), 4).alias("d4"),
        F.round(F.round(F.avg("l_tax") * 100, 10), 2).alias("d2"),
        F.round(F.round(F.avg("l_quantity"), 10), 1).alias("d1"),
    )


@query("confidence", f"WITH {SCORED} SELECT row_key, greatest(p, 1::DOUBLE - p) AS confidence FROM scored")
def confidence(spark, sf):
    return scored_lines(spark, sf).select("row_key", F.greatest(F.col("p"), 1.0 - F.col("p")).alias("confidence"))


@query(
    "stamp_metadata",
    f"""WITH {LOG_SQL} SELECT doc_id, prediction, sha256(to_json([doc_id::VARCHAR, 'run-1'])::VARCHAR) AS inference_id,
        'run-1' AS run_id, TIMESTAMP '2024-01-01' AS logged_at FROM log""",
)
def stamp_metadata(spark, sf):
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    stamped = stamp(prediction_log(spark, sf), ["doc_id"], "run-1", at)
    return stamped.select("doc_id", "prediction", "inference_id", "run_id", "logged_at")


@query(
    "json_flatten",
    """SELECT event_id, props->>'k' AS k, NULL::VARCHAR AS absent FROM events""",
)
def json_flatten(spark, sf):
    return flatten_json_column(table(spark, sf, "events"), "props", ["k", "absent"], ["event_id"])


@query(
    "request_log_flatten",
    """SELECT event_id, user_id::VARCHAR AS user_id, (value > 10)::INT::VARCHAR AS prediction,
        CASE WHEN event_type = 'error' THEN 'unknown' ELSE event_type END AS deployment FROM events""",
)
def request_log_flatten(spark, sf):
    text = F.col("user_id").cast("string")
    headers = F.when(F.col("event_type") == "error", F.create_map(F.lit("host"), F.lit("a"))).otherwise(
        F.create_map(F.lit("deployment"), F.col("event_type"))
    )
    body = F.struct((F.col("value") > 10).cast("int").cast("string").alias("prediction"))
    logs = table(spark, sf, "events").select(
        "event_id",
        F.struct(F.create_map(F.lit("user_id"), text).alias("body"), headers.alias("headers")).alias("request"),
        F.struct(body.alias("body")).alias("response"),
    )
    return flatten_requests(logs, ["user_id"], keep=["event_id"])


@query("truncate_payload", """SELECT doc_id, '{"text":"' || t || '"}' AS payload
    FROM (SELECT doc_id, regexp_replace(text, '[^A-Za-z ]', '', 'g') AS t FROM documents)""")
def truncate_payload(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.regexp_replace("text", "[^A-Za-z ]", "").alias("text"))
    return docs.select("doc_id", C.truncated_json(F.struct("text")).alias("payload"))


@query("rename_compat", "SELECT doc_id, quality AS actual_label FROM labels")
def rename_compat(spark, sf):
    return table(spark, sf, "labels").select("doc_id", "quality").withColumnRenamed("quality", "actual_label")


@query("cast_key", "SELECT doc_id::VARCHAR AS doc_key, quality FROM labels")
def cast_key(spark, sf):
    return table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("doc_key"), "quality")


@query("filter_flag", "SELECT doc_id, quality, toxic FROM labels WHERE toxic = 1")
def filter_flag(spark, sf):
    return table(spark, sf, "labels").where("toxic = 1")


@query("drop_nulls", f"WITH {RAW_SQL} SELECT row_key, discount, flag FROM raw WHERE discount IS NOT NULL AND flag IS NOT NULL")
def drop_nulls(spark, sf):
    return raw_lines(spark, sf).select("row_key", "discount", "flag").dropna(subset=["discount", "flag"])


@query("feature_column_filter", f"WITH {SCORED} SELECT l_quantity, l_tax FROM scored")
def feature_column_filter(spark, sf):
    return feature_columns(scored_lines(spark, sf), ["l_quantity", "prediction", "Age", "l_tax"])


# ---- vocabulary, scaling and the whole feature chain ----

VOCAB_SQL = """vocab AS (
    SELECT value, (row_number() OVER (ORDER BY value) - 1)::INT AS code FROM (
        SELECT DISTINCT coalesce(flag, 'nan') AS value FROM raw WHERE l_shipdate < TIMESTAMP '1998-01-01'))"""


def _old(raw):
    return raw.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))


@query("vocab_fit", f"WITH {RAW_SQL}, {VOCAB_SQL} SELECT 'flag' AS feature, value, code FROM vocab")
def vocab_fit(spark, sf):
    return X.fit_vocab(_old(raw_lines(spark, sf)), ["flag"])


@query(
    "vocab_fit_text",
    f"""SELECT feature, value, (row_number() OVER (PARTITION BY feature ORDER BY value) - 1)::INT AS code FROM (
        SELECT DISTINCT 'title' AS feature, coalesce({TITLE_SQL}, 'nan') AS value FROM documents
        UNION SELECT DISTINCT 'lang', lang FROM documents)""",
)
def vocab_fit_text(spark, sf):
    docs = table(spark, sf, "documents").select("lang", C.extract_first("text").alias("title"))
    return X.fit_vocab(docs, ["title", "lang"])


@query(
    "vocab_join",
    f"""WITH {RAW_SQL}, {VOCAB_SQL} SELECT row_key, coalesce(code, 0) AS flag
        FROM raw LEFT JOIN vocab ON coalesce(raw.flag, 'nan') = vocab.value""",
)
def vocab_join(spark, sf):
    raw = raw_lines(spark, sf)
    return X.encode(raw.select("row_key", "flag"), X.fit_vocab(_old(raw), ["flag"]), ["flag"])


@query(
    "label_encode",
    f"""WITH known AS (SELECT DISTINCT {TITLE_SQL} AS t FROM documents WHERE lang = 'en'),
        codes AS (SELECT coalesce(t, 'nan') AS t, (row_number() OVER (ORDER BY coalesce(t, 'nan')) - 1)::INT AS code FROM known)
        SELECT doc_id, coalesce(code, 0) AS title FROM documents LEFT JOIN codes ON coalesce({TITLE_SQL}, 'nan') = codes.t""",
)
def label_encode(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", C.extract_first("text").alias("title"))
    vocab = X.fit_vocab(docs.where("lang = 'en'"), ["title"])
    return X.encode(docs.select("doc_id", "title"), vocab, ["title"])


@query(
    "scaler_fit",
    """SELECT 'l_quantity' AS feature, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std FROM lineitem
       UNION ALL SELECT 'l_tax', round(avg(l_tax), 6), round(stddev_pop(l_tax), 6) FROM lineitem""",
)
def scaler_fit(spark, sf):
    means, stds = X.fit_scale(table(spark, sf, "lineitem"), ["l_quantity", "l_tax"])
    rows = [(c, round(means[c], 6), round(stds[c], 6)) for c in means]
    return spark.createDataFrame(rows, "feature string, mean double, std double")


SCALE_SQL = "round(({0} - avg({0}) OVER ()) / stddev_pop({0}) OVER (), 6) AS {0}"


@query(
    "standard_scale",
    f"SELECT {KEY_SQL} AS row_key, {SCALE_SQL.format('l_quantity')}, {SCALE_SQL.format('l_tax')} FROM lineitem",
)
def standard_scale(spark, sf):
    rows = raw_lines(spark, sf)
    scaled = X.scale(rows, *X.fit_scale(rows, ["l_quantity", "l_tax"]))
    return scaled.select("row_key", F.round("l_quantity", 6).alias("l_quantity"), F.round("l_tax", 6).alias("l_tax"))


@query(
    "stats_cross_join",
    """SELECT c_custkey, c_acctbal - med AS above_median, med AS median FROM customer,
        (SELECT quantile_cont(c_acctbal, 0.5) AS med FROM customer)""",
)
def stats_cross_join(spark, sf):
    customers = table(spark, sf, "customer")
    median = X.fit_impute(customers, ["c_acctbal"], [])[0]["c_acctbal"]
    return customers.select("c_custkey", (F.col("c_acctbal") - median).alias("above_median"), F.lit(median).alias("median"))


def line_spec() -> X.FeatureSpec:
    return X.FeatureSpec(
        median=["discount"],
        mode=["flag"],
        drop=["status_text"],
        derive={
            "band": C.bin_right_closed("l_quantity", QTY_EDGES, QTY_LABELS, "medium"),
            "bulk": C.total_plus_one("l_quantity", "l_linenumber"),
            "first_line": C.flag(F.col("l_linenumber") == 1),
        },
        encode=["flag", "band"],
        select=["l_quantity", "discount", "l_tax", "flag", "band", "bulk", "first_line"],
    )


CHAIN_FEATURES = ["l_quantity", "discount", "l_tax", "flag", "band", "bulk", "first_line"]
CHAIN_SQL = f"""{RAW_SQL},
filled AS (
    SELECT row_key, {Y_SQL} AS y, l_quantity, coalesce(discount, {MED_SQL}) AS discount, l_tax,
        coalesce(flag, {MODE_SQL}) AS flag_value, coalesce({QTY_SQL}, 'medium') AS band_value,
        l_quantity + l_linenumber + 1 AS bulk, (l_linenumber = 1)::INT AS first_line
    FROM raw),
encoded AS (
    SELECT row_key, y, l_quantity, discount, l_tax, (dense_rank() OVER (ORDER BY flag_value) - 1) AS flag,
        (dense_rank() OVER (ORDER BY band_value) - 1) AS band, bulk, first_line FROM filled),
chained AS (SELECT row_key, y, {', '.join(
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in CHAIN_FEATURES)} FROM encoded)"""


def chained(spark, sf):
    rows = raw_lines(spark, sf).withColumn("y", planted_label())
    state = X.fit(rows, line_spec())
    return X.apply(rows, line_spec(), state, keep=["row_key", "y"])


@query(
    "feature_transform",
    f"WITH {CHAIN_SQL} SELECT row_key, {', '.join(f'round({c}, 6) AS {c}' for c in CHAIN_FEATURES)} FROM chained",
)
def feature_transform(spark, sf):
    return chained(spark, sf).select("row_key", *[F.round(c, 6).alias(c) for c in CHAIN_FEATURES])


# ---- splits and assignments ----

ROW_HASH = key_hash_sql(42, *ROW_KEY)


def first_sql(hash_sql: str, size: str, partition: str = "") -> str:
    over = f"PARTITION BY {partition}" if partition else ""
    return f"row_number() OVER ({over} ORDER BY {hash_sql}) <= {size.format(over)}"


ROUND_N = "floor(count(*) OVER ({{}}) * {0}::DOUBLE + 0.5)"


@query(
    "stratified_split",
    f"""SELECT {KEY_SQL} AS row_key, l_returnflag, CASE WHEN {first_sql(ROW_HASH, ROUND_N.format(0.2), 'l_returnflag')}
        THEN 'test' ELSE 'train' END AS split FROM lineitem""",
)
def stratified_split(spark, sf):
    rows = S.split(raw_lines(spark, sf), ROW_KEY, 0.2, 42, ["l_returnflag"])
    return rows.select("row_key", "l_returnflag", "split")


@query(
    "nested_split",
    f"""WITH outer_split AS (SELECT doc_id, lang, {first_sql(key_hash_sql(42, "doc_id"), ROUND_N.format(0.2), 'lang')} AS test FROM documents)
        SELECT doc_id, CASE WHEN {first_sql(key_hash_sql(43, "doc_id"), ROUND_N.format(0.2), 'lang')}
        THEN 'valid' ELSE 'fit' END AS part FROM outer_split WHERE NOT test""",
)
def nested_split(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    train = S.split(docs, ["doc_id"], 0.2, 42, ["lang"]).where("split = 'train'").drop("split")
    inner = S.split(train, ["doc_id"], 0.2, 43, ["lang"])
    return inner.select("doc_id", F.when(F.col("split") == "test", "valid").otherwise("fit").alias("part"))


@query(
    "plain_split",
    f"""SELECT {KEY_SQL} AS row_key, CASE WHEN ('0x' || substr({ROW_HASH}, 1, 8))::BIGINT < 858993459
        THEN 'test' ELSE 'train' END AS split FROM lineitem""",
)
def plain_split(spark, sf):
    return S.split(raw_lines(spark, sf), ROW_KEY, 0.2, 42, exact=False).select("row_key", "split")


@query(
    "sample_fraction",
    f"SELECT doc_id FROM (SELECT doc_id, {first_sql(key_hash_sql(42, "doc_id"), ROUND_N.format(0.8))} AS picked FROM labels) WHERE picked",
)
def sample_fraction(spark, sf):
    return S.sample_fraction(table(spark, sf, "labels"), ["doc_id"], 0.8, 42).select("doc_id")


AB_SQL = f"""CASE WHEN {first_sql(ROW_HASH, "floor(count(*) OVER ({}) * 0.1::DOUBLE)")}
    THEN 'challenger' ELSE 'champion' END"""


@query("ab_assign", f"SELECT {KEY_SQL} AS row_key, {AB_SQL} AS model_variant FROM lineitem")
def ab_assign(spark, sf):
    return S.assign_ab(raw_lines(spark, sf), ROW_KEY, 0.1, 42).select("row_key", "model_variant")


@query(
    "canary_assign",
    f"""SELECT event_id, user_id, CASE WHEN ('0x' || substr({key_hash_sql(42, "user_id")}, 1, 8))::BIGINT % 100 < 10
        THEN 'v2' ELSE 'v1' END AS version FROM events""",
)
def canary_assign(spark, sf):
    weights = S.canary_weights("v2", "v1", 10)
    return S.assign_weighted(table(spark, sf, "events"), ["user_id"], weights, 42).select("event_id", "user_id", "version")


# ---- scoring ----


@query(
    "score",
    f"""SELECT {KEY_SQL} AS row_key, round(p, 6) AS survival_probability, round(1::DOUBLE - p, 6) AS non_survival_probability,
        (p > 0.5)::INT AS prediction, CASE WHEN p > 0.5 THEN 'Survived' ELSE 'Did not survive' END AS prediction_label
        FROM (SELECT *, {probability_sql(CHAMPION)} AS p FROM lineitem)""",
)
def score(spark, sf):
    return M.score(raw_lines(spark, sf), CHAMPION).select(
        "row_key",
        F.round("survival_probability", 6).alias("survival_probability"),
        F.round("non_survival_probability", 6).alias("non_survival_probability"),
        "prediction",
        "prediction_label",
    )


@query(
    "score_variant",
    f"""SELECT {KEY_SQL} AS row_key, (p > 0.5)::INT AS prediction, round(1::DOUBLE - p, 6) AS probability_negative,
        round(p, 6) AS probability_positive, round(greatest(p, 1::DOUBLE - p), 6) AS confidence,
        {AB_SQL} AS model_variant, 'unknown' AS model_version
        FROM (SELECT *, {probability_sql(CHAMPION)} AS p FROM lineitem)""",
)
def score_variant(spark, sf):
    rows = M.score_variant(S.assign_ab(raw_lines(spark, sf), ROW_KEY, 0.1, 42), CHAMPION)
    rounded = [F.round(c, 6).alias(c) for c in ("probability_negative", "probability_positive", "confidence")]
    return rows.select("row_key", "prediction", *rounded, "model_variant", "model_version")


REQUEST_SCHEMA = Schema(
    "requests",
    (
        Field("l_quantity", "double", (at_most(45),)),
        Field("status", "string", (isin("O", "F"),)),
    ),
)
REQUEST_FIELDS = [RequestField("status", "O", "upper", blank_is_missing=True), RequestField("l_discount", 0.0)]
REQUEST_SQL = f"""requests AS (
    SELECT l_orderkey, l_quantity, coalesce(discount, 0) AS l_discount, l_tax,
        upper(coalesce(nullif(lower(status_text), ''), 'O')) AS status FROM raw),
answered AS (SELECT *, {probability_sql(CHAMPION)} AS p FROM requests WHERE l_quantity <= 45)"""


def _requests(spark, sf):
    raw = raw_lines(spark, sf)
    logged = raw.select(
        "l_orderkey", "l_quantity", F.col("discount").alias("l_discount"), "l_tax", F.lower("status_text").alias("status")
    )
    return score_requests(logged, REQUEST_FIELDS, REQUEST_SCHEMA, CHAMPION, ["l_orderkey"])


@query(
    "score_request_table",
    f"""WITH {RAW_SQL}, {REQUEST_SQL} SELECT l_orderkey, count(*) AS total, count(*) FILTER (p > 0.5) AS positive_count,
        round(count(*) FILTER (p > 0.5) / count(*), 4) AS positive_rate FROM answered GROUP BY 1""",
)
def score_request_table(spark, sf):
    return _requests(spark, sf)[2]


@query(
    "score_request_rejects",
    f"WITH {RAW_SQL} SELECT l_orderkey, l_quantity, 'l_quantity: less_than_or_equal_to(45)' AS reason FROM raw WHERE l_quantity > 45",
)
def score_request_rejects(spark, sf):
    bad = _requests(spark, sf)[1]
    return bad.select("l_orderkey", "l_quantity", F.array_join("reasons", "; ").alias("reason"))


@query(
    "score_files",
    f"""SELECT concat_ws(',', l_orderkey, (p > 0.5)::INT, printf('%.4f', p),
            CASE WHEN p > 0.5 THEN 'Survived' ELSE 'Did not survive' END) AS line
        FROM (SELECT l_orderkey, {probability_sql(CHAMPION)} AS p FROM lineitem WHERE l_quantity <> 13)
        UNION ALL SELECT 'ERROR: ' || concat_ws(',', l_orderkey, 'thirteen', l_discount, l_tax)
        FROM lineitem WHERE l_quantity = 13""",
)
def score_files_query(spark, sf):
    root = fresh_dir(spark, "score-files")
    columns = ["l_orderkey", "l_quantity", "l_discount", "l_tax"]
    rows = raw_lines(spark, sf).withColumn(
        "l_quantity", F.when(F.col("l_quantity") == 13, "thirteen").otherwise(F.col("l_quantity").cast("string"))
    )
    for flag in ("A", "N", "R"):
        write_csv(rows.where(F.col("l_returnflag") == flag).select(columns), f"{root}/{flag}")
    schema = "l_orderkey long, l_quantity double, l_discount double, l_tax double"
    lines, errors = score_files(
        spark, [f"{root}/{f}" for f in "ANR"], spark.createDataFrame([], schema).schema, CHAMPION, "l_orderkey"
    )
    # the file name differs from run to run, so it is cut out of the error line here
    bare = errors.select(F.regexp_replace("line", r"^ERROR: .* - ", "ERROR: ").alias("line"))
    return lines.select("line").unionByName(bare)


@query(
    "scorer_contract",
    f"SELECT {KEY_SQL} AS row_key, round({probability_sql(CHAMPION)}, 6) AS p FROM lineitem",
)
def scorer_contract(spark, sf):
    model = CHAMPION

    def load():
        import numpy as np

        weights = np.array(model.weights)

        def run(pdf):
            z = pdf[list(model.features)].to_numpy() @ weights + model.intercept
            return pdf[["row_key"]].assign(p=1.0 / (1.0 + np.exp(-z)))

        return run

    rows = raw_lines(spark, sf).select("row_key", *model.features)
    return M.score_batches(rows, load, "row_key string, p double").withColumn("p", F.round("p", 6))


@query(
    "positional_attach",
    f"""WITH {LOG_SQL} SELECT d.doc_id, d.lang, l.prediction, l.probability FROM documents d JOIN log l ON d.doc_id = l.doc_id""",
)
def positional_attach(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    preds = prediction_log(spark, sf).select("doc_id", "prediction", "probability")
    return lookup_join(docs, preds, ["doc_id"], "inner")
