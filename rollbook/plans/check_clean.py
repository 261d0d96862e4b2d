"""Registered queries: cleaning, typing and row checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.functions import clean
from rollbook.operators import quality, shape
from rollbook.plans import dirty
from rollbook.plans.registered import query, table

RAW_ORDERS_SQL = f"SELECT o_orderkey, {dirty.select_list(dirty.orders(False))} FROM orders"
TYPED_ORDERS_SQL = f"SELECT {dirty.sql_typed(dirty.ORDERS)} FROM ({RAW_ORDERS_SQL})"


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", *dirty.columns(dirty.orders(True))
    )
    return cells.select(
        "o_orderkey",
        *[clean.null_token(F.col(c)).alias(c) for c in dirty.ORDERS.columns],
    )


@query(f"""SELECT p_partkey, {dirty.sql_string('x')} AS cleaned
FROM (SELECT p_partkey, {dirty.PART_TEXT} AS x FROM part)""")
def q_clean_string(spark, sf_dir):
    raw = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{dirty.PART_TEXT} AS x")
    x = F.col("x")
    return raw.select("p_partkey", clean.clean_string(x).alias("cleaned"))


@query(f"""SELECT p_partkey, {dirty.sql_int('p_brand')} AS brand, {dirty.sql_int('big')} AS big,
{dirty.sql_int('mixed')} AS mixed FROM (SELECT p_partkey, p_brand,
CASE WHEN p_partkey % 9 = 0 THEN '3000000000' ELSE '-' || CAST(p_size AS STRING) END AS big,
CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size AS STRING) || '-' WHEN p_partkey % 4 = 1 THEN '3.5'
ELSE '00' || CAST(p_size AS STRING) || ' un' END AS mixed FROM part)""")
def q_clean_int(spark, sf_dir):
    raw = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "p_brand",
        "CASE WHEN p_partkey % 9 = 0 THEN '3000000000' ELSE '-' || CAST(p_size AS STRING) END AS big",
        "CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size AS STRING) || '-' WHEN p_partkey % 4 = 1 "
        "THEN '3.5' ELSE '00' || CAST(p_size AS STRING) || ' un' END AS mixed",
    )
    return raw.select(
        "p_partkey",
        clean.clean_int(F.col("p_brand")).alias("brand"),
        clean.clean_int(F.col("big")).alias("big"),
        clean.clean_int(F.col("mixed")).alias("mixed"),
    )


@query(f"SELECT o_orderkey, {dirty.sql_decimal('total')} AS total FROM ({RAW_ORDERS_SQL})")
def q_clean_decimal(spark, sf_dir):
    return raw_orders(spark, sf_dir).select(
        "o_orderkey", clean.clean_decimal(F.col("total")).alias("total")
    )


@query(f"SELECT o_orderkey, {dirty.sql_date('ordered_on')} AS ordered_on FROM ({RAW_ORDERS_SQL})")
def q_clean_date(spark, sf_dir):
    return raw_orders(spark, sf_dir).select(
        "o_orderkey", clean.clean_date(F.col("ordered_on")).alias("ordered_on")
    )


@query(TYPED_ORDERS_SQL)
def q_typed_table(spark, sf_dir):
    return shape.typed(raw_orders(spark, sf_dir), dirty.ORDERS)


@query("""SELECT event_id, CAST(ts AS DATE) AS ts, user_id,
CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value,
CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_type END AS event_type,
event_id % 2 = 0 AS flag FROM events""")
def q_normalise(spark, sf_dir):
    raw = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "ts",
        "user_id",
        "CASE WHEN event_id % 10 = 0 THEN double('NaN') ELSE value END AS value",
        "CASE WHEN event_id % 17 = 0 THEN '   ' ELSE '  ' || event_type || chr(9) END AS event_type",
        "event_id % 2 = 0 AS flag",
    )
    return shape.normalised(raw)


@query("""SELECT o_orderkey, TRY_CAST(CASE WHEN o_custkey % 97 = 0 THEN 'x12'
WHEN o_custkey % 53 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS INTEGER) AS customer_code
FROM orders""")
def q_assign_cast(spark, sf_dir):
    return raw_orders(spark, sf_dir).select(
        "o_orderkey", clean.assign_int(F.col("customer_code")).alias("customer_code")
    )


@query("SELECT o_orderkey, CAST(o_custkey % 30 AS VARCHAR) AS clerk FROM orders")
def q_code_text(spark, sf_dir):
    return raw_orders(spark, sf_dir).select(
        "o_orderkey", clean.code_text(F.col("clerk")).alias("clerk")
    )


_TOKEN = """CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'NULL' WHEN 2 THEN 'null'
    WHEN 3 THEN ' NULL ' WHEN 4 THEN 'NA' ELSE p_name END"""


@query(f"SELECT p_partkey, {dirty.sql_null_token('x')} AS x FROM "
       f"(SELECT p_partkey, {_TOKEN} AS x FROM part)")
def q_null_tokens(spark, sf_dir):
    raw = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_TOKEN} AS x")
    return raw.select("p_partkey", clean.null_token(F.col("x")).alias("x"))


def _failures_sql() -> str:
    parts = []
    for f in dirty.ORDERS.fields:
        x = f"({dirty.sql_null_token(f.name)})"
        parts.append(
            f"SELECT '{f.name}' AS column_name, COUNT(*) FILTER (WHERE {dirty.sql_string(x)} "
            f"IS NOT NULL AND {dirty.sql_cell(f, x)} IS NULL) AS n FROM raw"
        )
    return f"WITH raw AS ({RAW_ORDERS_SQL}) " + " UNION ALL ".join(parts)


@query(_failures_sql())
def q_cast_failures(spark, sf_dir):
    return quality.cast_failures(raw_orders(spark, sf_dir), dirty.ORDERS)


_REASONS = {
    "customer_code:not_int": "o_custkey % 97 = 0",
    "status:length": "o_orderkey % 89 = 0",
    "priority:int_range": "o_orderkey % 83 = 0",
    "total:decimal_range": "o_orderkey % 79 = 0",
}


def _quarantine_sql() -> str:
    parts = [
        f"SELECT 'rejected' AS status, '{reason}' AS reason, COUNT(*) AS n FROM orders "
        f"WHERE {fault} HAVING COUNT(*) > 0"
        for reason, fault in _REASONS.items()
    ]
    good = " AND ".join(f"NOT ({fault})" for fault in _REASONS.values())
    parts.append(
        f"SELECT 'accepted' AS status, NULL AS reason, COUNT(*) AS n FROM orders WHERE {good} "
        "HAVING COUNT(*) > 0"
    )
    return " UNION ALL ".join(parts)


@query(_quarantine_sql())
def q_quarantine(spark, sf_dir):
    checked = shape.typed_with_reasons(raw_orders(spark, sf_dir), dirty.ORDERS)
    return quality.quarantine_report(checked)


@query("SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem "
       "GROUP BY l_orderkey, l_linenumber "
       "HAVING COUNT(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL")
def q_pk_violations(spark, sf_dir):
    return quality.key_violations(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("""SELECT 'text' AS column_name, COUNT(*) FILTER (WHERE length(text) > 1000) AS n FROM documents
UNION ALL SELECT 'source', COUNT(*) FILTER (WHERE length(source) > 4) FROM documents
UNION ALL SELECT 'p_name', COUNT(*) FILTER (WHERE length(p_name) > 10) FROM part
UNION ALL SELECT 'p_type', COUNT(*) FILTER (WHERE length(p_type) > 6) FROM part""")
def q_length_violations(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    part = table(spark, sf_dir, "part")
    return quality.length_violations(documents, {"text": 1000, "source": 4}).unionAll(
        quality.length_violations(part, {"p_name": 10, "p_type": 6})
    )


@query("SELECT COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def q_count_where(spark, sf_dir):
    return quality.count_where(
        table(spark, sf_dir, "orders"),
        F.col("o_orderstatus") == "F",
        F.col("o_orderpriority") == "1-URGENT",
    )


_COUNTED = ("customer", "orders", "lineitem", "part")


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{t}.parquet' AS file_name, COUNT(*) AS n FROM {t}"
    for t in _COUNTED
))
def q_load_counts(spark, sf_dir):
    counts = quality.load_counts({t: table(spark, sf_dir, t) for t in _COUNTED})
    name = F.regexp_extract("file", r"([^/]+\.parquet)(/|$)", 1)
    return counts.groupBy("table_name", name.alias("file_name")).agg(F.sum("n").alias("n"))
