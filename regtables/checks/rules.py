"""Quality rules and their report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from regtables.checks.registry import check as register, table
from regtables.operators.quality import check, in_range, in_set, invalid_values

_REPORT = "SELECT {no} AS rule_no, '{column}' AS \"column\", '{check}' AS \"check\", v = 0 AS passed, v AS violations FROM ({count})"


def _short(report: DataFrame) -> DataFrame:
    return report.drop("message")


@register("dq_not_null", _REPORT.format(no=0, column="priority", check="not_null",
    count="SELECT count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS v FROM orders"))
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("priority", F.expr("nullif(o_orderpriority, '1-URGENT')"))
    return _short(check(rows, [{"column": "priority", "check": "not_null"}]))


@register("dq_unique", """
SELECT 0 AS rule_no, 'o_custkey' AS "column", 'is_unique' AS "check", count(*) = 0 AS passed, count(*) AS violations,
       'Column ''o_custkey'' is not unique. Found ' || count(o_custkey) || ' duplicate values.' AS message
FROM (SELECT CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)
""")
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr("CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS o_custkey")
    return check(rows, [{"column": "o_custkey", "check": "is_unique"}])


@register("dq_type_numeric", _REPORT.format(no=0, column="size", check="has_type",
    count="SELECT count(*) FILTER (WHERE p_type IN ('ECONOMY', 'SMALL')) AS v FROM part"))
def dq_type_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.expr("CASE p_type WHEN 'ECONOMY' THEN 'about 3' WHEN 'SMALL' THEN NULL WHEN 'PROMO' THEN '3.5' ELSE cast(p_size AS string) END")
    return _short(check(table(spark, sf_dir, "part").withColumn("size", size), [{"column": "size", "check": "has_type", "type": "integer"}]))


@register("dq_type_datetime", _REPORT.format(no=0, column="written", check="has_type",
    count="SELECT count(*) FILTER (WHERE o_orderstatus = 'F' OR o_orderpriority = '2-HIGH') AS v FROM orders"))
def dq_type_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.expr("""
        CASE WHEN o_orderstatus = 'F' THEN 'in spring' WHEN o_orderpriority = '2-HIGH' THEN NULL
             WHEN o_orderpriority = '5-LOW' THEN date_format(o_orderdate, 'yyyy年M月d日') ELSE cast(o_orderdate AS string) END
    """)
    rows = table(spark, sf_dir, "orders").withColumn("written", written)
    return _short(check(rows, [{"column": "written", "check": "has_type", "type": "datetime"}]))


@register("dq_in_range", """
SELECT 0 AS rule_no, 'qty' AS "column", 'is_in_range' AS "check", v = 0 AS passed, v AS violations,
       'Column ''qty'' has ' || v || ' values outside the range [5, 40].' AS message
FROM (SELECT count(*) FILTER (WHERE l_returnflag = 'R' OR l_quantity NOT BETWEEN 5 AND 40) AS v FROM lineitem)
""")
def dq_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").selectExpr("CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS qty")
    return check(rows, [{"column": "qty", "check": "is_in_range", "min_value": 5, "max_value": 40}])


@register("dq_in_set", """
WITH b AS (SELECT nullif(c_mktsegment, 'FURNITURE') AS s FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD'))
SELECT 0 AS rule_no, 'segment' AS "column", 'is_in_set' AS "check", count(*) = 0 AS passed, count(*) AS violations,
       'Column ''segment'' contains values not in the allowed set: [' ||
       (SELECT string_agg(DISTINCT s, ', ' ORDER BY s) FROM b WHERE s IS NOT NULL) || ', None]' AS message FROM b
""")
def dq_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr("nullif(c_mktsegment, 'FURNITURE') AS segment")
    return check(rows, [{"column": "segment", "check": "is_in_set", "allowed_values": ["BUILDING", "HOUSEHOLD"]}])


@register("dq_invalid_values", """
SELECT CAST(l_suppkey AS VARCHAR) AS value, count(*) AS n_rows FROM lineitem
WHERE l_suppkey NOT IN (1, 2, 3, 5, 8) GROUP BY 1
""")
def dq_invalid_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = invalid_values(table(spark, sf_dir, "lineitem"), "l_suppkey", [1, 2, 3, 5, 8])
    return found.withColumn("value", F.col("value").cast("string"))


@register("row_predicates", "SELECT event_id, value BETWEEN 2 AND 30 AS in_range, event_type IN ('click', 'view') AS in_set FROM events")
def row_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return rows.select(
        "event_id", in_range(rows, "value", 2, 30).alias("in_range"), in_set(rows, "event_type", ["click", "view"]).alias("in_set")
    )


_RULES = [
    {"column": "doc_id", "check": "not_null"},
    {"column": "doc_id", "check": "is_unique"},
    {"column": "quality", "check": "is_in_set", "allowed_values": [1]},
    {"column": "toxic", "check": "is_in_range", "min_value": 0, "max_value": 0},
    {"column": "quality", "check": "has_type", "type": "int32"},
    {"column": "quality", "check": "has_type", "type": "float64"},
    {"column": "absent", "check": "not_null"},
    {"column": "doc_id", "check": "is_magic"},
    {"column": "quality", "check": "has_type", "type": "float"},
]


@register("dq_report", """
WITH c AS (SELECT count(*) FILTER (WHERE quality <> 1) AS q, count(*) FILTER (WHERE toxic <> 0) AS t,
                  count(*) - count(DISTINCT doc_id) AS d FROM labels)
SELECT 0 AS rule_no, 'doc_id' AS "column", 'not_null' AS "check", true AS passed, CAST(0 AS BIGINT) AS violations, CAST(NULL AS VARCHAR) AS message
UNION ALL SELECT 1, 'doc_id', 'is_unique', d = 0, d, CASE WHEN d > 0 THEN 'repeated' END FROM c
UNION ALL SELECT 2, 'quality', 'is_in_set', false, q, 'Column ''quality'' contains values not in the allowed set: [0]' FROM c
UNION ALL SELECT 3, 'toxic', 'is_in_range', false, t, 'Column ''toxic'' has ' || t || ' values outside the range [0, 0].' FROM c
UNION ALL SELECT 4, 'quality', 'has_type', true, 0, NULL
UNION ALL SELECT 5, 'quality', 'has_type', false, 1, 'Column ''quality'' has type int32, expected float64.'
UNION ALL SELECT 6, 'absent', 'not_null', false, 1, 'Validation failed: Column ''absent'' not found in DataFrame.'
UNION ALL SELECT 7, 'doc_id', 'is_magic', false, 1, 'Unknown validation check: is_magic'
UNION ALL SELECT 8, 'quality', 'has_type', true, 0, NULL
""")
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check(table(spark, sf_dir, "labels"), _RULES)
