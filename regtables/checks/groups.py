"""Rows of one key collapsed with order kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from regtables.checks.registry import check, table
from regtables.operators.collapse import collapse_by_key, rows_as_json
from regtables.sources.documents import assemble_documents

# Returned lines of all orders share the null key: a sixth of the rows in one group.
_LINES = """
  SELECT CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL ELSE l_orderkey END AS k,
         l_linenumber, l_partkey, l_suppkey, nullif(l_returnflag, 'R') AS flag,
         CASE WHEN l_linestatus = 'O' THEN l_shipdate END AS shipped, l_linestatus AS status
  FROM lineitem
"""
_ORDER = "l_linenumber, l_partkey, l_suppkey"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return rows.selectExpr(
        "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL ELSE l_orderkey END AS k",
        "l_linenumber", "l_partkey", "l_suppkey", "nullif(l_returnflag, 'R') AS flag",
        "CASE WHEN l_linestatus = 'O' THEN date_format(l_shipdate, 'yyyy-MM-dd') END AS shipped", "l_linestatus AS status",
    )


@check("collapse_by_key", f"""
WITH r AS ({_LINES}), n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY {_ORDER}) AS i FROM r),
     v AS (SELECT k, flag, min(i) AS i FROM n WHERE flag IS NOT NULL GROUP BY k, flag),
     j AS (SELECT k, string_agg(flag, chr(10) ORDER BY i) AS flag FROM v GROUP BY k)
SELECT g.k, g.shipped, g.status, coalesce(j.flag, '') AS flag, g.n_rows FROM
  (SELECT k, strftime(arg_min(shipped, i) FILTER (WHERE shipped IS NOT NULL), '%Y-%m-%d') AS shipped,
          arg_min(status, i) AS status, count(*) AS n_rows FROM n GROUP BY k) g
LEFT JOIN j ON g.k IS NOT DISTINCT FROM j.k
""")
def collapsed_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = collapse_by_key(
        _lines(spark, sf_dir), "k", ["l_linenumber", "l_partkey", "l_suppkey"], first=["shipped", "status"], joined=["flag"]
    )
    return done


@check("collapse_wide_groups", f"""
WITH r AS ({_LINES}), n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY {_ORDER}) AS i FROM r),
     v AS (SELECT k, flag, min(i) AS i FROM n WHERE flag IS NOT NULL GROUP BY k, flag),
     j AS (SELECT k, string_agg(flag, '/' ORDER BY i) AS flag FROM v GROUP BY k),
     m AS (SELECT k, sha256(CAST(json_object('place', {{'l_linenumber': l_linenumber, 'l_partkey': l_partkey, 'l_suppkey': l_suppkey}},
             'row', {{'flag': flag, 'status': status}}) AS VARCHAR)) AS h FROM r),
     s AS (SELECT k, sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS a, sum(CAST('0x' || substr(h, 16, 15) AS BIGINT)) AS b FROM m GROUP BY k)
SELECT g.k, g.status_first, coalesce(j.flag, '') AS flag, g.n_rows, sha256(g.n_rows || ':' || s.a || ':' || s.b) AS _meta_source_content_hash
FROM (SELECT k, arg_min(status, i) AS status_first, count(*) AS n_rows FROM n GROUP BY k) g
JOIN s ON g.k IS NOT DISTINCT FROM s.k LEFT JOIN j ON g.k IS NOT DISTINCT FROM j.k
""")
def collapsed_wide_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group with a sixth of all rows has the same layout as the others, and a hash over all its rows."""
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    rows = _lines(spark, sf_dir).withColumn("status_first", F.col("status"))
    done = collapse_by_key(rows, "k", order, first=["status_first"], joined=["flag"], record=["flag", "status"], separator="/")
    return done.select("k", "status_first", "flag", "n_rows", "_meta_source_content_hash")


@check("ordered_distinct_join", """
WITH r AS (SELECT user_id, event_id, nullif(event_type, 'error') AS t FROM events),
     v AS (SELECT user_id, t, min(event_id) AS i FROM r WHERE t IS NOT NULL GROUP BY user_id, t)
SELECT u.user_id, coalesce(j.types, '') AS types FROM (SELECT DISTINCT user_id FROM r) u
LEFT JOIN (SELECT user_id, string_agg(t, chr(10) ORDER BY i) AS types FROM v GROUP BY user_id) j ON u.user_id = j.user_id
""")
def ordered_distinct_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr("user_id", "event_id", "nullif(event_type, 'error') AS types")
    return collapse_by_key(rows, "user_id", ["event_id"], joined=["types"]).select("user_id", "types")


@check("group_rows_json", """
WITH r AS (SELECT o_custkey, o_orderkey, CAST(json_object('o_orderkey', o_orderkey, 'o_orderstatus', o_orderstatus,
             'priority', nullif(o_orderpriority, '5-LOW')) AS VARCHAR) AS j FROM orders),
     g AS (SELECT o_custkey, count(*) AS n_rows, '[' || string_agg(j, ',' ORDER BY o_orderkey) || ']' AS raw_data_full FROM r GROUP BY 1)
SELECT *, sha256(raw_data_full) AS _meta_source_content_hash FROM g
""")
def group_rows_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey", "o_orderkey", "o_orderstatus", "nullif(o_orderpriority, '5-LOW') AS priority"
    )
    return rows_as_json(rows, "o_custkey", ["o_orderkey"], ["o_orderkey", "o_orderstatus", "priority"])


@check("assemble_documents", """
WITH p AS (SELECT conv_id, turn, text AS t, role FROM conversations)
SELECT conv_id, coalesce(string_agg(t, chr(10) ORDER BY turn) FILTER (WHERE t <> ''), '') AS full_text,
       '[' || coalesce(string_agg('[' || CAST(json_object('role', role, 'turn', CAST(turn AS VARCHAR)) AS VARCHAR) || ']', ',' ORDER BY turn)
              FILTER (WHERE role <> 'user'), '') || ']' AS tables
FROM p GROUP BY conv_id
""")
def assembled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as pages; each page has one table, and those of users have an empty first row. An empty page
    without tables stands before each turn."""
    turns = table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "2 * turn + 1 AS turn", "text",
        """array(array(if(role = 'user', array(cast(NULL AS string), ''), array('role', 'turn')),
                       array(role, cast(turn AS string)))) AS tables""",
    )
    empty = turns.selectExpr("conv_id", "turn - 1 AS turn", "'' AS text", "cast(NULL AS array<array<array<string>>>) AS tables")
    done = assemble_documents(turns.unionByName(empty), doc="conv_id", page_no="turn")
    return done.select("conv_id", "full_text", F.to_json("tables").alias("tables"))
