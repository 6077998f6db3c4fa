"""Columns, lineage and hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from regtables.checks.registry import AS_OF, AS_OF_TEXT, check, table
from regtables.functions.records import content_hash, document_id, document_payload, lenient_int, lenient_number, raw_json, row_hash_id
from regtables.operators.conform import add_lineage, conform, rename_columns, require_columns, union_files
from regtables.operators.grid import drop_empty_rows, normalize_headers


@check("raw_json", """
SELECT o_orderkey, CAST(json_object('o_orderkey', o_orderkey, 'o_custkey', o_custkey, 'status', o_orderstatus,
       'priority', nullif(o_orderpriority, '1-URGENT')) AS VARCHAR) AS raw_data_full
FROM orders
""")
def raw_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.expr("nullif(o_orderpriority, '1-URGENT')").alias("priority")
    record = raw_json(["o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), priority])
    return table(spark, sf_dir, "orders").select("o_orderkey", record.alias("raw_data_full"))


@check("row_hash_id", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       sha256(CAST(json_object('flag', nullif(l_returnflag, 'N'), 'l_linenumber', CAST(l_linenumber AS VARCHAR),
              'l_orderkey', CAST(l_orderkey AS VARCHAR), 'l_partkey', CAST(l_partkey AS VARCHAR),
              'l_suppkey', CAST(l_suppkey AS VARCHAR)) AS VARCHAR)) AS row_id
FROM lineitem
""")
def row_hash_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("flag", F.expr("nullif(l_returnflag, 'N')"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return rows.select(*keys, row_hash_id([*keys, "flag"]).alias("row_id"))


@check("content_hash", "SELECT doc_id, sha256(text) AS content_hash FROM documents")
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", content_hash(F.col("text")).alias("content_hash"))


@check("document_id", "SELECT page_id, sha256(url) AS document_id FROM pages")
def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", document_id(F.col("url")).alias("document_id"))


@check("document_payload", """
SELECT doc_id, CAST(json_object('source_file_type', 'pdf', 'full_text', text,
       'extracted_tables', [[{'lang': lang, 'source': source}]]) AS VARCHAR) AS raw_data_full
FROM documents
""")
def document_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = F.create_map(F.lit("lang"), "lang", F.lit("source"), "source")
    payload = document_payload(F.col("text"), F.array(F.array(cells)))
    return table(spark, sf_dir, "documents").select("doc_id", payload.alias("raw_data_full"))


@check("add_lineage", f"""
SELECT s_suppkey, s_name, CAST(json_object('s_suppkey', s_suppkey, 's_name', s_name) AS VARCHAR) AS raw_data_full,
       '{AS_OF_TEXT}' AS load_ts, 'https://example.org/list' AS _meta_source_url, '1.0' AS _meta_pipeline_version,
       sha256(CAST(json_object('s_suppkey', s_suppkey, 's_name', s_name) AS VARCHAR)) AS _meta_source_content_hash
FROM supplier
""")
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    rows = rows.withColumn("raw_data_full", raw_json(["s_suppkey", "s_name"]))
    done = add_lineage(rows, "https://example.org/list", AS_OF, "1.0")
    return done.select(
        "s_suppkey", "s_name", "raw_data_full",
        F.date_format(F.to_utc_timestamp("_meta_load_ts_utc", F.current_timezone()), "yyyy-MM-dd HH:mm:ss").alias("load_ts"),
        "_meta_source_url", "_meta_pipeline_version", "_meta_source_content_hash",
    )


@check("lenient_numeric", """
SELECT p_partkey,
       CASE p_type WHEN 'ECONOMY' THEN NULL WHEN 'PROMO' THEN p_size + 0.5 ELSE p_size END::DOUBLE AS amount,
       CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN NULL ELSE p_size END::BIGINT AS whole
FROM part
""")
def lenient_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("""
        CASE p_type WHEN 'ECONOMY' THEN 'n/a' WHEN 'PROMO' THEN concat(p_size, '.5')
                    WHEN 'STANDARD' THEN concat(p_size, '.0') WHEN 'LARGE' THEN concat(' ', p_size)
                    ELSE cast(p_size AS string) END
    """)
    return table(spark, sf_dir, "part").select(
        "p_partkey", lenient_number(text).alias("amount"), lenient_int(text).alias("whole")
    )


@check("normalize_headers", "SELECT n_nationkey AS nationkey, n_name AS nation_name, n_regionkey AS region FROM nation")
def normalized_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_headers(table(spark, sf_dir, "nation").toDF(" nation\nkey ", "nation_ name", "re gi\ton"))


@check("rename_columns", "SELECT c_custkey AS id, c_name AS brand, c_mktsegment AS remarks FROM customer")
def renamed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {"c_custkey": "id", "c_name": "brand", "c_mktsegment": "remarks"}
    return rename_columns(table(spark, sf_dir, "customer"), mapping, keep_unmapped=False)


@check("conform_schema", """
SELECT o_orderkey AS approval_id, CAST(NULL AS VARCHAR) AS indication, o_orderstatus AS application_type,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority
FROM orders
""")
def conformed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("application_type"), "o_custkey",
        F.expr("substr(o_orderpriority, 1, 1)").alias("priority"), F.col("o_orderkey").alias("approval_id"),
    )
    target = T.StructType([
        T.StructField("approval_id", T.LongType()), T.StructField("indication", T.StringType()),
        T.StructField("application_type", T.StringType()), T.StructField("priority", T.IntegerType()),
    ])
    return conform(require_columns(rows, ["approval_id", "priority", "remarks"], ["remarks"]), target)


@check("drop_empty_rows", """
SELECT event_id, event_type, props FROM
  (SELECT event_id, nullif(event_type, 'click') AS event_type,
          CASE WHEN event_type NOT IN ('click', 'view') THEN props END AS props FROM events)
WHERE event_type IS NOT NULL OR props IS NOT NULL
""")
def non_empty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.expr("nullif(event_type, 'click')").alias("event_type"),
        F.expr("CASE WHEN event_type NOT IN ('click', 'view') THEN props END").alias("props"),
    )
    return drop_empty_rows(rows, ["event_type", "props"])


@check("union_files", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier
UNION ALL SELECT p_partkey, p_name, NULL, NULL FROM part
""")
def united_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_files([
        table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment"),
        table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS nation", "s_name AS name", "s_suppkey AS id"),
        table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_name AS name"),
    ])
