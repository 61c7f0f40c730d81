"""Queries over declared constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorewright.catalog.base import KEY_SQL, RAW_SQL, query, raw_lines, table
from scorewright.operators import validation as V

SCHEMA = V.Schema(
    "lines",
    (
        V.Field("l_orderkey", "bigint", (V.greater_than(0),)),
        V.Field("l_linenumber", "int", (V.isin(1, 2, 3, 4, 5),)),
        V.Field("l_quantity", "double", (V.at_least(1), V.at_most(45))),
        V.Field("quantity_text", "double"),
        V.Field("discount", "double"),
        V.Field("flag", "string", (V.isin("N"),), nullable=True),
        V.Field("status_text", "string", (V.non_empty(),)),
        V.Field("l_tax", "double", (V.custom("tax below 8%", lambda c: c < 0.08),)),
        V.Field("comment", "string", required=False),
    ),
    (V.min_rows(500), V.min_rate("l_discount", 0.25)),
)

# (column, check, violated?) of every row-level rule above
RULES = [
    ("l_orderkey", "dtype(bigint)", "false"),
    ("l_orderkey", "not_nullable", "l_orderkey IS NULL"),
    ("l_orderkey", "greater_than(0)", "l_orderkey <= 0"),
    ("l_linenumber", "dtype(int)", "false"),
    ("l_linenumber", "not_nullable", "l_linenumber IS NULL"),
    ("l_linenumber", "isin(1, 2, 3, 4, 5)", "l_linenumber NOT IN (1, 2, 3, 4, 5)"),
    ("l_quantity", "dtype(double)", "false"),
    ("l_quantity", "not_nullable", "l_quantity IS NULL"),
    ("l_quantity", "greater_than_or_equal_to(1)", "l_quantity < 1"),
    ("l_quantity", "less_than_or_equal_to(45)", "l_quantity > 45"),
    ("quantity_text", "dtype(double)", "quantity_text IS NOT NULL AND try_cast(quantity_text AS DOUBLE) IS NULL"),
    ("quantity_text", "not_nullable", "quantity_text IS NULL"),
    ("discount", "dtype(double)", "false"),
    ("discount", "not_nullable", "discount IS NULL"),
    ("flag", "dtype(string)", "false"),
    ("flag", "isin(N)", "flag NOT IN ('N')"),
    ("status_text", "dtype(string)", "false"),
    ("status_text", "not_nullable", "status_text IS NULL"),
    ("status_text", "length>0", "length(status_text) = 0"),
    ("l_tax", "dtype(double)", "false"),
    ("l_tax", "not_nullable", "l_tax IS NULL"),
    ("l_tax", "tax below 8%", "l_tax >= 0.08::DOUBLE"),
]


def counts_sql(wanted) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", '{n}' AS \"check\", count(*) FILTER ({cond}) AS violations FROM raw"
        for c, n, cond in RULES
        if wanted(n)
    ]
    return f"WITH {RAW_SQL} " + " UNION ALL ".join(parts)


def register_counts(name: str, wanted) -> None:
    @query(name, counts_sql(wanted))
    def run(spark, sf):
        names = [n for _, n, _ in RULES if wanted(n)]
        return V.check_counts(raw_lines(spark, sf), SCHEMA).where(F.col("check").isin(sorted(set(names))))


register_counts("check_coerce", lambda n: n.startswith("dtype"))
register_counts("check_not_null", lambda n: n == "not_nullable")
register_counts("check_isin", lambda n: n.startswith("isin"))
register_counts("check_range", lambda n: n.startswith(("greater_than", "less_than")))
register_counts("check_length", lambda n: n.startswith("length"))
register_counts("custom_check", lambda n: n.startswith("tax"))


@query(
    "check_required",
    """SELECT 'DataFrameSchema' AS schema_context, 'column_in_dataframe' AS "check", c AS failure_case,
           (SELECT count(*) FROM lineitem) AS n_rows
       FROM (VALUES ('quantity_text'), ('discount'), ('flag'), ('status_text')) v(c)""",
)
def check_required(spark, sf):
    li = table(spark, sf, "lineitem")
    missing = V.missing_columns(li, SCHEMA).select("schema_context", "check", "failure_case")
    return missing.withColumn("n_rows", li.agg(F.count(F.lit(1)).alias("n")).scalar())


@query(
    "check_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def check_unique(spark, sf):
    return V.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_min_rows",
    """SELECT l_linestatus, 'min_rows(500)' AS "check", count(*)::DOUBLE AS value, count(*) >= 500 AS passed
       FROM lineitem GROUP BY 1""",
)
def check_min_rows(spark, sf):
    rows = V.table_check_results(raw_lines(spark, sf), SCHEMA, ["l_linestatus"])
    return rows.where(F.col("check").startswith("min_rows"))


@query(
    "check_min_rate",
    """SELECT 'min_rate(quality, 0.25)' AS "check", round(avg(quality), 6) AS value,
        avg(quality) >= 0.25 AS passed FROM labels""",
)
def check_min_rate(spark, sf):
    schema = V.Schema("labels", (V.Field("quality", "int"),), (V.min_rate("quality", 0.25),))
    return V.table_check_results(table(spark, sf, "labels"), schema).withColumn("value", F.round("value", 6))


VIOLATION_CASES = " UNION ALL ".join(
    f"SELECT 'Column' AS schema_context, '{c}' AS \"column\", '{n}' AS \"check\", "
    f"coalesce({c}::VARCHAR, 'null') AS failure_case, row_key AS \"index\" FROM raw WHERE {cond}"
    for c, n, cond in RULES
    if cond != "false"
)


@query("violations", f"WITH {RAW_SQL} {VIOLATION_CASES}")
def violations(spark, sf):
    return V.violations(raw_lines(spark, sf), SCHEMA, ["row_key"]).drop("check_number")


@query(
    "violations_unique",
    """SELECT 'o_custkey' AS "column", 'field_uniqueness' AS "check", o_custkey::VARCHAR AS failure_case,
           o_orderkey::VARCHAR AS "index"
       FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)""",
)
def violations_unique(spark, sf):
    schema = V.Schema("orders", (V.Field("o_custkey", "bigint", unique=True),))
    listed = V.violations(table(spark, sf, "orders"), schema, ["o_orderkey"])
    return listed.drop("check_number", "schema_context")


SUMMARY_SQL = (
    f"WITH {RAW_SQL} SELECT l_linestatus, n = 0 AS passed, 'lines' AS schema_name, n AS error_count, "
    "n_rules AS n_broken_rules FROM (SELECT l_linestatus, ("
    + " + ".join(f"count(*) FILTER ({cond})" for _, _, cond in RULES)
    + " + (count(*) < 500)::INT + (avg(l_discount) < 0.25)::INT)::BIGINT AS n, ("
    + " + ".join(f"(count(*) FILTER ({cond}) > 0)::INT" for _, _, cond in RULES)
    + " + (count(*) < 500)::INT + (avg(l_discount) < 0.25)::INT)::INT AS n_rules "
    "FROM raw GROUP BY 1)"
)


@query("validation_summary", SUMMARY_SQL)
def validation_summary(spark, sf):
    counts = V.error_counts(raw_lines(spark, sf), SCHEMA, ["l_linestatus"])
    return V.summarize(counts, SCHEMA.name, ["l_linestatus"]).withColumn(
        "n_broken_rules", F.size("errors")
    ).drop("errors")


ANY_RULE = " OR ".join(f"coalesce({cond}, false)" for _, _, cond in RULES if cond != "false")


@query(
    "validation_policy",
    f"""WITH {RAW_SQL} SELECT CASE WHEN {ANY_RULE} THEN 'quarantined' ELSE 'good' END AS part,
        l_linestatus, count(*) AS n FROM raw GROUP BY 1, 2""",
)
def validation_policy(spark, sf):
    good, bad = V.quarantine(raw_lines(spark, sf), SCHEMA)
    both = good.select(F.lit("good").alias("part"), "l_linestatus").unionByName(
        bad.select(F.lit("quarantined").alias("part"), "l_linestatus")
    )
    return both.groupBy("part", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "quarantine",
    f"""WITH {RAW_SQL} SELECT {KEY_SQL} AS row_key, reasons FROM (
        SELECT *, concat_ws('; ', {', '.join(
            f"CASE WHEN {cond} THEN '{c}: {n}' END" for c, n, cond in RULES if cond != 'false')}) AS reasons
        FROM raw) WHERE reasons <> ''""",
)
def quarantine(spark, sf):
    _, bad = V.quarantine(raw_lines(spark, sf), SCHEMA)
    return bad.select("row_key", F.array_join("reasons", "; ").alias("reasons"))


@query(
    "request_defaults",
    """SELECT c_custkey, upper(coalesce(nullif(nullif(c_mktsegment, 'BUILDING'), ''), 'MACHINERY')) AS segment,
        lower(c_name) AS name, coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0) AS balance,
        upper(coalesce(nullif(nullif(c_mktsegment, 'BUILDING'), ''), 'MACHINERY')) IN ('MACHINERY', 'FURNITURE') AS ok
       FROM customer""",
)
def request_defaults(spark, sf):
    raw = table(spark, sf, "customer").select(
        "c_custkey",
        F.lower(F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("segment"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
    )
    fields = [
        V.RequestField("segment", "MACHINERY", "upper", blank_is_missing=True),
        V.RequestField("name", case="lower"),
        V.RequestField("balance", 0.0),
    ]
    schema = V.Schema("requests", (V.Field("segment", "string", (V.isin("MACHINERY", "FURNITURE"),)),))
    ready = V.normalize_requests(raw, fields)
    return ready.withColumn("ok", V.row_passes(ready, schema))


@query(
    "batch_size_bounds",
    "SELECT l_orderkey, count(*) AS n_rows, count(*) BETWEEN 1 AND 5 AS size_ok FROM lineitem GROUP BY 1",
)
def batch_size_bounds(spark, sf):
    return V.batch_sizes(table(spark, sf, "lineitem"), ["l_orderkey"], 1, 5)


@query(
    "first_errors",
    f"""WITH {RAW_SQL} SELECT "column", "check", failure_case, "index" FROM ({VIOLATION_CASES})
        ORDER BY "index", "column", "check" LIMIT 10""",
)
def first_errors(spark, sf):
    return violations(spark, sf).drop("schema_context").orderBy("index", "column", "check").limit(10)
