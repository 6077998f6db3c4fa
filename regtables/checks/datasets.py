"""The datasets end to end: source rows, transform, rules, load, published table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from regtables.checks.registry import AS_OF, check, new_folder, new_schema, table
from regtables.checks.sources import written_archives
from regtables.plans.datasets import ADVERSE_EVENT_COLUMNS, adverse_events, approval_records, approval_rows, approval_tables, approvals, package_inserts, review_reports
from regtables.plans.pipeline import run_dataset, run_sources
from regtables.plans.specs import ADVERSE_EVENTS, APPROVALS, PACKAGE_INSERTS, REVIEW_REPORTS, XML_REPORT, DatasetSpec, with_config
from regtables.sinks.tables import table_name
from regtables.sources.archives import archive_tables
from regtables.sources.files import xml_rows

_URL = "https://example.org/approvals.xlsx"
_LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey")


def _run(spark: SparkSession, spec: DatasetSpec, build, **options) -> tuple[DatasetSpec, str]:
    spec, root = with_config(spec, {"schema_name": new_schema()}), new_folder(spark)
    run_dataset(spark, spec, lambda: build(root), root, AS_OF, **options)
    return spec, root


def _rows(spark: SparkSession, spec: DatasetSpec, key: str) -> DataFrame:
    return spark.table(table_name(spec.schema_name, spec.tables[key]))


def _text_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes if t == "date"})


# --- approvals: order lines as list rows, orders as approvals ---------------------------------------


def approval_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey AS string) AS approval_id",
        "CASE l_returnflag WHEN 'R' THEN '医薬品' WHEN 'A' THEN '医療機器' ELSE '再生医療等製品' END AS application_type",
        "concat('Brand ', l_partkey % 7) AS brand_name_jp",
        "CASE WHEN l_linestatus = 'O' THEN concat('Generic ', l_suppkey % 3) END AS generic_name_jp",
        "concat('Supplier ', l_suppkey) AS applicant_name_jp",
        """CASE WHEN year(l_shipdate) < 2001 THEN concat('平成', year(l_shipdate) - 1988, '年', month(l_shipdate), '月', day(l_shipdate), '日')
                ELSE date_format(l_shipdate, 'yyyy/MM/dd') END AS approval_date""",
        "nullif(l_returnflag, 'N') AS remarks",
        "l_linenumber", "l_partkey", "l_suppkey",
    )


@check("approvals_dataset", f"""
WITH r AS (SELECT l_orderkey AS k, CASE l_returnflag WHEN 'R' THEN '医薬品' WHEN 'A' THEN '医療機器' ELSE '再生医療等製品' END AS t,
             'Brand ' || (l_partkey % 7) AS b, CASE WHEN l_linestatus = 'O' THEN 'Generic ' || (l_suppkey % 3) END AS g, 'Supplier ' || l_suppkey AS a,
             CAST(l_shipdate AS DATE) AS d, CASE WHEN year(l_shipdate) < 2001 THEN '平成' || (year(l_shipdate) - 1988) || '年' || month(l_shipdate) || '月' || day(l_shipdate) || '日'
               ELSE strftime(l_shipdate, '%Y/%m/%d') END AS dt, nullif(l_returnflag, 'N') AS rem, l_linenumber, l_partkey, l_suppkey,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem),
     f AS (SELECT *, sha256(CAST(json_object('place', {{'l_linenumber': l_linenumber, 'l_partkey': l_partkey, 'l_suppkey': l_suppkey}},
             'row', {{'approval_id': CAST(k AS VARCHAR), 'application_type': t, 'brand_name_jp': b, 'generic_name_jp': g,
               'applicant_name_jp': a, 'approval_date': dt, 'remarks': rem}}) AS VARCHAR)) AS h,
             i = min(i) OVER (PARTITION BY k, b) AS fb, i = min(i) OVER (PARTITION BY k, g) AS fg, i = min(i) OVER (PARTITION BY k, a) AS fa FROM r),
     c AS (SELECT CAST(k AS INTEGER) AS approval_id, arg_min(t, i) AS application_type,
             string_agg(b, chr(10) ORDER BY i) FILTER (WHERE fb) AS brand_name_jp,
             coalesce(string_agg(g, chr(10) ORDER BY i) FILTER (WHERE fg AND g IS NOT NULL), '') AS generic_name_jp,
             string_agg(a, chr(10) ORDER BY i) FILTER (WHERE fa) AS applicant_name_jp,
             strftime(arg_min(d, i), '%Y-%m-%d') AS approval_date, CAST(NULL AS VARCHAR) AS indication, CAST(NULL AS VARCHAR) AS review_report_url,
             count(*) AS n, sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS h_a, sum(CAST('0x' || substr(h, 16, 15) AS BIGINT)) AS h_b
           FROM f GROUP BY k)
SELECT * EXCLUDE (n, h_a, h_b), sha256(n || ':' || h_a || ':' || h_b) AS _meta_source_content_hash, '{_URL}' AS _meta_source_url FROM c
""")
def approvals_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(root: str) -> dict[str, DataFrame]:
        return approval_tables(approval_lines(spark, sf_dir), _URL, AS_OF, _LINE_ORDER)

    spec, _ = _run(spark, APPROVALS, build)
    return _text_dates(_rows(spark, spec, "approvals")).drop("_meta_load_ts_utc", "_meta_pipeline_version")


@check("approvals_wide_records", """
WITH r AS (SELECT l_orderkey AS k, CASE l_returnflag WHEN 'R' THEN '医薬品' WHEN 'A' THEN '医療機器' ELSE '再生医療等製品' END AS t,
             'Brand ' || (l_partkey % 7) AS b, CASE WHEN l_linestatus = 'O' THEN 'Generic ' || (l_suppkey % 3) END AS g, 'Supplier ' || l_suppkey AS a,
             CASE WHEN year(l_shipdate) < 2001 THEN '平成' || (year(l_shipdate) - 1988) || '年' || month(l_shipdate) || '月' || day(l_shipdate) || '日'
               ELSE strftime(l_shipdate, '%Y/%m/%d') END AS dt, nullif(l_returnflag, 'N') AS rem, l_linenumber, l_partkey, l_suppkey FROM lineitem)
SELECT CAST(k AS VARCHAR) AS approval_id,
       CAST(json_object('l_linenumber', l_linenumber, 'l_partkey', l_partkey, 'l_suppkey', l_suppkey) AS VARCHAR) AS source_order,
       CAST(json_object('approval_id', CAST(k AS VARCHAR), 'application_type', t, 'brand_name_jp', b, 'generic_name_jp', g,
            'applicant_name_jp', a, 'approval_date', dt, 'remarks', rem) AS VARCHAR) AS raw_data_full
FROM r
""")
def approvals_wide_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source rows of all approvals, as loaded beside them."""
    spec, _ = _run(spark, APPROVALS, lambda root: approval_tables(approval_lines(spark, sf_dir), _URL, AS_OF, _LINE_ORDER))
    return _rows(spark, spec, "records").drop("_meta_load_ts_utc")


@check("approvals_from_sheets", """
SELECT CAST(s_suppkey AS INTEGER) AS approval_id, '医薬品' AS application_type,
       s_name AS brand_name_jp, 'g' || s_nationkey AS generic_name_jp, n_name AS applicant_name_jp, '2019-05-01' AS approval_date
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def approvals_from_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sheet per nation: titles, a header with blanks, merged cells in the type column, a blank row."""
    names = ["No.", "申請 区分", "販売名", "一般名", "申請者名", "承認\n年月日", "備考"]
    nations = table(spark, sf_dir, "nation")
    blank = ", ".join(["cast(NULL AS string)"] * len(names))
    cells = ", ".join(f"'{n}'" for n in names)
    top = nations.selectExpr(
        "n_name AS file",
        f"""explode(array(struct(0L AS row_no, array('list', {blank[:-len(', cast(NULL AS string)')]}) AS cells),
                          struct(1L AS row_no, array({cells}) AS cells), struct(2L AS row_no, array({blank}) AS cells))) AS r""",
    ).select("file", "r.row_no", "r.cells")
    suppliers = table(spark, sf_dir, "supplier").join(nations, F.expr("s_nationkey = n_nationkey"))
    first = suppliers.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("lowest"))
    rows = suppliers.join(first, "s_nationkey").selectExpr(
        "n_name AS file", "s_suppkey + 3 AS row_no",
        """array(cast(s_suppkey AS string), if(s_suppkey = lowest, '医薬品', NULL), s_name, concat('g', s_nationkey), n_name, '令和元年5月1日', NULL) AS cells""",
    )
    records = approval_records(top.unionByName(rows))
    return _text_dates(approvals(records, _URL, AS_OF)).select(
        "approval_id", "application_type", "brand_name_jp", "generic_name_jp", "applicant_name_jp", "approval_date"
    )


@check("approval_rows", """
SELECT CAST(o_orderkey AS VARCHAR) AS approval_id, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS approval_date,
       CAST(json_object('source_file_name', o_orderpriority || '.xlsx', 'original_values', {'approval_id': CAST(o_orderkey AS VARCHAR),
         'application_type': nullif(o_orderstatus, 'P'), 'approval_date': CASE WHEN o_orderstatus = 'F' THEN '未定' ELSE strftime(o_orderdate, '%Y.%m.%d') END}) AS VARCHAR) AS raw_data_full
FROM orders
""")
def single_approval_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "orders").selectExpr(
        "concat(o_orderpriority, '.xlsx') AS file", "o_orderkey AS row_no", "cast(o_orderkey AS string) AS approval_id",
        "nullif(o_orderstatus, 'P') AS application_type",
        "CASE WHEN o_orderstatus = 'F' THEN '未定' ELSE date_format(o_orderdate, 'yyyy.MM.dd') END AS approval_date",
    )
    return _text_dates(approval_rows(records, _URL, AS_OF)).select("approval_id", "approval_date", "raw_data_full")


# --- adverse events: archives of four members, merged into four tables ------------------------------


def _star(spark: SparkSession, sf_dir: str, again: bool = False) -> DatasetSpec:
    folder = written_archives(spark, sf_dir)

    def build(root: str) -> dict[str, DataFrame]:
        return adverse_events(archive_tables(spark, folder, ADVERSE_EVENT_COLUMNS), "https://example.org/case.zip", AS_OF)

    # Equal source rows share a row id, and one of them stays.
    spec, root = _run(spark, ADVERSE_EVENTS, build, on_duplicate="last", watermark={"etag": "1"})
    if again:
        run_dataset(spark, spec, lambda: build(root), root, AS_OF, on_duplicate="last", watermark={"etag": "2"})
        # Unchanged since: not built.
        run_dataset(spark, spec, lambda: {"none": None}, root, AS_OF, watermark={"etag": "2"})
    return spec


@check("adverse_events_reactions", """
WITH r AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS identification_number, o_orderpriority AS adverse_event_name,
             strftime(o_orderdate, '%Y-%m-%d') AS onset_date, strftime(o_orderdate, '%Y%m%d') AS raw_date FROM orders)
SELECT sha256(CAST(json_object('adverse_event_name', adverse_event_name, 'identification_number', identification_number, 'onset_date', onset_date) AS VARCHAR)) AS reac_id,
       identification_number, adverse_event_name, onset_date,
       CAST(json_object('識別番号', identification_number, '副作用名', adverse_event_name, '発現日', raw_date) AS VARCHAR) AS raw_data_full
FROM r
""")
def adverse_events_reactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _star(spark, sf_dir)
    return _text_dates(_rows(spark, spec, "REAC")).select("reac_id", "identification_number", "adverse_event_name", "onset_date", "raw_data_full")


@check("load_star", """
SELECT 'adverse_demo' AS table_name, count(*) AS n_rows, count(DISTINCT c_custkey) AS n_keys FROM customer
UNION ALL SELECT 'adverse_hist', count(*), count(DISTINCT c_custkey) FROM customer
UNION ALL SELECT 'adverse_drug', count(*), count(DISTINCT k) FROM (SELECT DISTINCT o_custkey AS k, o_orderstatus, o_orderpriority FROM orders)
UNION ALL SELECT 'adverse_reac', count(*), count(DISTINCT k) FROM (SELECT DISTINCT o_custkey AS k, o_orderdate, o_orderpriority FROM orders)
""")
def adverse_events_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _star(spark, sf_dir, again=True)
    counts = [
        _rows(spark, spec, key).agg(
            F.lit(spec.tables[key].name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("identification_number").alias("n_keys"),
        )
        for key in spec.tables
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


# --- documents: conversations as PDFs, a turn a page --------------------------------------------------


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").selectExpr(
        "concat('https://example.org/', conv_id, '.pdf') AS url", "turn AS page_no", "text",
        "if(turn = 1, array(array(array('role'), array(role))), array()) AS tables",
    )


def _package_inserts(spark: SparkSession, sf_dir: str) -> DatasetSpec:
    return _run(spark, PACKAGE_INSERTS, lambda root: package_inserts(_pages(spark, sf_dir), AS_OF))[0]


@check("package_inserts_dataset", """
WITH p AS (SELECT 'https://example.org/' || conv_id || '.pdf' AS url,
             sha256(CAST(json_object('page_no', turn, 'text', text, 'tables', CASE WHEN turn = 1 THEN [[['role'], [role]]] ELSE [] END) AS VARCHAR)) AS h FROM conversations)
SELECT sha256(url) AS document_id, count(*) AS n_pages, url AS _meta_source_url,
       sha256(count(*) || ':' || sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) || ':' || sum(CAST('0x' || substr(h, 16, 15) AS BIGINT))) AS _meta_source_content_hash
FROM p GROUP BY url
""")
def package_inserts_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, _package_inserts(spark, sf_dir), "package_inserts")
    return rows.select("document_id", "n_pages", "_meta_source_url", "_meta_source_content_hash")


@check("package_insert_pages", """
SELECT sha256('https://example.org/' || conv_id || '.pdf') AS document_id, turn AS page_no, text AS page_text,
       CASE WHEN turn = 1 THEN '[[["role"],["' || role || '"]]]' ELSE '[]' END AS page_tables
FROM conversations
""")
def package_insert_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, _package_inserts(spark, sf_dir), "pages")


@check("sources_incremental", """
SELECT sha256('https://example.org/' || conv_id || '.pdf') AS document_id, 'https://example.org/' || conv_id || '.pdf' AS _meta_source_url,
       CASE WHEN count(*) > 6 THEN 2 ELSE 1 END AS version,
       CASE WHEN count(*) > 6 THEN count(*) + 1 ELSE count(*) END AS n_pages, CASE WHEN count(*) > 6 THEN count(*) + 1 ELSE count(*) END AS page_rows
FROM conversations GROUP BY conv_id HAVING count(*) > 2
""")
def sources_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run in which long conversations got a page more and short ones lost all: only those are built again."""
    spec, root = with_config(PACKAGE_INSERTS, {"schema_name": new_schema()}), new_folder(spark)
    old = _pages(spark, sf_dir)
    sources = old.groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    more = sources.where("n > 6").select("url", F.lit(-1).cast(old.schema["page_no"].dataType).alias("page_no"), F.lit("new").alias("text"), F.lit(None).cast(old.schema["tables"].dataType).alias("tables"))
    sized = old.join(sources, "url")
    same = sized.where("n BETWEEN 3 AND 6").withColumn("text", F.lit("never built"))
    new = same.unionByName(sized.where("n > 6")).drop("n").unionByName(more)
    token = lambda version: F.concat(F.lit("v"), F.when(F.col("n").between(3, 6), 1).otherwise(version)).alias("etag")
    for version, pages in ((1, old), (2, new)):
        listed = sources.select("url", token(version), F.lit(None).cast("string").alias("last_modified"))
        build = lambda changed, p=pages, v=version: package_inserts(p.join(changed.select("url"), "url", "left_semi"), AS_OF, pipeline_version=str(v))
        run_sources(spark, spec, listed, build, root, AS_OF)
    rows = _rows(spark, spec, "pages").groupBy("document_id").agg(F.count(F.lit(1)).alias("page_rows"))
    found = _rows(spark, spec, "package_inserts").join(rows, "document_id", "left")
    return found.select("document_id", "_meta_source_url", F.col("_meta_pipeline_version").cast("int").alias("version"), "n_pages", "page_rows")


@check("review_reports_dataset", """
WITH p AS (
  SELECT doc_id, 1 AS page_no, '販売名: B ' || source || chr(10) || '申請者名: A' || lang || chr(10) || '申請年月日: 令和7年1月15日' AS text FROM documents
  UNION ALL SELECT doc_id, 2, CASE WHEN lang <> 'en' THEN '承認年月日: 2025年9月10日' ELSE '承認年月日: 未定' END || chr(10) || '1. 審査の概要' FROM documents
  UNION ALL SELECT doc_id, 3, text FROM documents
  UNION ALL SELECT doc_id, 4, '2. 審査の結果' || chr(10) || text FROM documents),
  h AS (SELECT doc_id, sha256(CAST(json_object('page_no', page_no, 'text', text, 'tables', [[['lang']]]) AS VARCHAR)) AS h FROM p),
  s AS (SELECT doc_id, sha256(count(*) || ':' || sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) || ':' || sum(CAST('0x' || substr(h, 16, 15) AS BIGINT))) AS hash FROM h GROUP BY doc_id)
SELECT sha256('https://example.org/' || doc_id) AS document_id, 4 AS n_pages, 'B ' || source AS brand_name_jp, CAST(NULL AS VARCHAR) AS generic_name_jp,
       'A' || lang AS applicant_name_jp, '2025-01-15' AS application_date, CASE WHEN lang <> 'en' THEN '2025-09-10' END AS approval_date,
       nullif(regexp_replace(text, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), '') AS review_summary_text, hash AS _meta_source_content_hash
FROM documents JOIN s USING (doc_id)
""")
def review_reports_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of four pages: labels on two, the heading of the summary at the end of one, its text on the next."""
    pages = table(spark, sf_dir, "documents").selectExpr(
        "concat('https://example.org/', doc_id) AS url",
        r"""posexplode(array(
              concat('販売名: B ', source, '\n申請者名: A', lang, '\n申請年月日: 令和7年1月15日'),
              concat(if(lang <> 'en', '承認年月日: 2025年9月10日', '承認年月日: 未定'), '\n1. 審査の概要'),
              text, concat('2. 審査の結果\n', text))) AS (at, text)""",
        "array(array(array('lang'))) AS tables",
    ).selectExpr("url", "at + 1 AS page_no", "text", "tables")
    spec, _ = _run(spark, REVIEW_REPORTS, lambda root: review_reports(pages, AS_OF))
    return _text_dates(_rows(spark, spec, "review_reports")).select(
        "document_id", "n_pages", "brand_name_jp", "generic_name_jp", "applicant_name_jp", "application_date", "approval_date",
        "review_summary_text", "_meta_source_content_hash",
    )


@check("xml_report_dataset", "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_type AS category, p_brand AS status FROM part")
def xml_report_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(root: str) -> dict[str, DataFrame]:
        table(spark, sf_dir, "part").selectExpr(
            "cast(p_partkey AS string) AS _id", "p_name AS name", "p_type AS category", "struct(p_brand AS _VALUE, 'true' AS _approved) AS status"
        ).write.format("xml").option("rootTag", "products").option("rowTag", "product").save(f"{root}/source")
        return {"xml_reports": xml_rows(spark, f"{root}/source", "./product", ["id", "name", "category", "status"])}

    spec, _ = _run(spark, XML_REPORT, build)
    return _rows(spark, spec, "xml_reports")
