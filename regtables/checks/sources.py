"""Files written from the tables and read back."""

from __future__ import annotations

import io
import zipfile
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from regtables.checks.registry import check, new_folder, table
from regtables.sources.archives import archive_csv, archive_members, archive_tables, decode_files, in_pieces
from regtables.sources.files import binary_files, csv_records, parquet_table, with_source_file, xml_nodes, xml_rows
from regtables.sources.ranges import file_system

_FILES = pa.schema([("path", pa.string()), ("content", pa.binary())])


@check("scan_parquet", "SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS customers, min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parquet_table(spark, f"{sf_dir}/orders.parquet")
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_custkey").alias("customers"),
        F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"),
    )


@check("source_file", "SELECT 'orders.parquet' AS source_file, count(*) AS n_rows FROM orders")
def source_file_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_source_file(parquet_table(spark, f"{sf_dir}/orders.parquet"))
    return rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))


@check("scan_csv", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS id, o_orderstatus AS status,
       'a "' || o_orderpriority || '", b' AS note, nullif(o_orderpriority, '5-LOW') AS priority
FROM orders
""")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    table(spark, sf_dir, "orders").selectExpr(
        "lpad(cast(o_orderkey AS string), 12, '0') AS id", "o_orderstatus AS status",
        """concat('a "', o_orderpriority, '", b') AS note""", "nullif(o_orderpriority, '5-LOW') AS priority",
    ).write.option("header", True).option("escape", '"').csv(folder)
    return csv_records(spark, folder)


@check("scan_xml", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, nullif(c_mktsegment, 'BUILDING') AS category FROM customer")
def xml_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey AS string) AS _id", "struct(c_name AS _VALUE, 'true' AS _approved) AS name",
        "nullif(c_mktsegment, 'BUILDING') AS category",
    ).write.format("xml").option("rootTag", "products").option("rowTag", "product").save(folder)
    return xml_rows(spark, folder, "./product", ["id", "name", "category"])


@check("scan_xml_path", """
SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS id, 'n' || o_orderstatus AS name, nullif(o_orderpriority, '5-LOW') AS status FROM orders
""")
def xml_path_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per order; the same tag under another parent is no row."""
    documents = table(spark, sf_dir, "orders").selectExpr("o_custkey", """
        concat('<report><other><product id="x"/></other><products><product id="', o_orderkey, '"><name>n', o_orderstatus, '</name>',
               if(o_orderpriority = '5-LOW', '', concat('<status approved="true">', o_orderpriority, '</status>')), '</product></products></report>') AS text
    """)
    return xml_nodes(documents, "text", "./products/product", ["id", "name", "status"])


@check("decode_files", """
SELECT doc_id, CASE WHEN lang = 'de' AND strlen(text) > length(text) THEN 'cp1252' WHEN lang = 'es' THEN 'utf-8-sig' ELSE 'utf-8' END AS charset,
       CAST(0 AS BIGINT) AS decode_errors, text
FROM documents
""")
def decoded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    def encoded(batches):
        codecs = {"de": "cp1252", "es": "utf-8-sig"}
        for b in batches:
            for path, lang, text in zip(b.column("path"), b.column("lang"), b.column("text")):
                content = text.as_py().encode(codecs.get(lang.as_py(), "utf-8"))
                yield len(content), (path.as_py(), content)

    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), "lang", "text")
    files = texts.mapInArrow(lambda batches: in_pieces(encoded(batches), _FILES), "path string, content binary")
    return decode_files(files, ("utf-8", "cp1252"), "cp1252").withColumn("doc_id", F.col("path").cast("bigint")).drop("path")


@check("decode_cp932", """
SELECT o_orderkey, 'cp932' AS charset, CAST(0 AS BIGINT) AS decode_errors, '識別番号,医薬品名' || chr(10) || o_orderkey || ',薬' || o_orderpriority AS text FROM orders
""")
def decoded_japanese(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("concat('識別番号,医薬品名\n', o_orderkey, ',薬', o_orderpriority)")
    files = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("path"), text.alias("text"))

    def encoded(batches):
        for b in batches:
            for path, text in zip(b.column("path"), b.column("text")):
                content = text.as_py().encode("cp932")
                yield len(content), (path.as_py(), content)

    files = files.mapInArrow(lambda batches: in_pieces(encoded(batches), _FILES), "path string, content binary")
    return decode_files(files).withColumn("o_orderkey", F.col("path").cast("bigint")).drop("path")


@check("scan_binary", "SELECT CAST(p_partkey AS VARCHAR) AS part, sha256(p_name || p_brand) AS hash FROM part")
def binary_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text file per task; each line is a record."""
    folder = new_folder(spark)
    table(spark, sf_dir, "part").selectExpr("concat(p_partkey, ',', p_name, p_brand) AS line").write.text(folder)
    lines = decode_files(binary_files(spark, folder, "part-*")).select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    return lines.select(F.split("line", ",")[0].alias("part"), F.sha2(F.split("line", ",")[1], 256).alias("hash"))


def event_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives ``(path, content)`` as the regulator ships them: DEMO and HIST from customers, DRUG and
    REAC from orders. An archive holds up to 500 customers or 5000 orders by construction. Members are
    in two charsets and two letter cases; archives without orders lack two members."""
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey div 500 AS archive", "0 AS kind", "c_custkey AS id", "c_name AS a", "c_mktsegment AS b", "cast(c_nationkey AS string) AS c"
    )
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey div 5000 AS archive", "1 AS kind", "o_custkey AS id", "o_orderpriority AS a",
        "date_format(o_orderdate, 'yyyyMMdd') AS b", "o_orderstatus AS c",
    )

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        archive = int(rows["archive"].iloc[0])
        people, cases = rows[rows["kind"] == 0], rows[rows["kind"] == 1]
        members = {
            "DEMO": pd.DataFrame({"識別番号": people["id"], "性別": people["b"].str[:1], "年齢": people["c"] + "0代", "体重": None, "身長": "170",
                                  "報告年度・四半期": "2025・1", "転帰": people["b"], "報告区分": people["a"], "報告者職種": "医師, \"他\"\n行"}),
            "HIST": pd.DataFrame({"原疾患等": people["b"].str.lower(), "識別番号": people["id"]}),
            "DRUG": pd.DataFrame({"識別番号": cases["id"], "医薬品の関与": cases["c"], "医薬品名": cases["a"], "使用理由": cases["c"].where(cases["c"] != "F")}),
            "REAC": pd.DataFrame({"識別番号": cases["id"], "副作用名": cases["a"], "発現日": cases["b"], "余分": "x"}),
        }
        out = io.BytesIO()
        charset = "cp932" if archive % 2 else "utf-8"
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for stem, frame in members.items():
                if len(frame):
                    z.writestr(f"{stem}.csv" if archive % 2 else f"{stem.lower()}.CSV", frame.to_csv(index=False).encode(charset))
        return pd.DataFrame({"path": [f"case-{archive}.zip"], "content": [out.getvalue()]})

    return customers.unionByName(orders).groupBy("archive").applyInPandas(pack, "path string, content binary")


def written_archives(spark: SparkSession, sf_dir: str) -> str:
    """The archives as files in a folder of the shared one."""
    folder = new_folder(spark)

    def write(batches):
        for b in batches:
            system, place = file_system(folder)
            system.create_dir(place)
            for name, content in zip(b["path"], b["content"]):
                with system.open_output_stream(f"{place}/{name}") as out:
                    out.write(content)
            yield b[["path"]]

    event_archives(spark, sf_dir).mapInPandas(write, "path string").write.format("noop").mode("overwrite").save()
    return folder


@check("scan_zip_source", """
SELECT 'DEMO' AS stem, 'case-' || (c_custkey // 500) || '.zip' AS archive, CAST(c_custkey AS VARCHAR) AS "id", 'case ' || c_name AS value FROM customer
UNION ALL SELECT 'HIST', 'case-' || (c_custkey // 500) || '.zip', CAST(c_custkey AS VARCHAR), lower(c_mktsegment) FROM customer
UNION ALL SELECT 'DRUG', 'case-' || (o_orderkey // 5000) || '.zip', CAST(o_custkey AS VARCHAR), o_orderpriority FROM orders
UNION ALL SELECT 'REAC', 'case-' || (o_orderkey // 5000) || '.zip', CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%Y%m%d') FROM orders
""")
def zip_source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All members of archive files in one pass, a task per member."""
    columns = {"DEMO": ["識別番号", "報告区分"], "HIST": ["識別番号", "原疾患等"], "DRUG": ["識別番号", "医薬品名"], "REAC": ["識別番号", "発現日"]}
    frames = archive_tables(spark, written_archives(spark, sf_dir), columns)
    value = lambda stem: F.concat(F.lit("case "), F.col("value")) if stem == "DEMO" else F.col("value")
    parts = [f.drop("record_no").toDF("archive", "id", "value").select(F.lit(s).alias("stem"), F.element_at(F.split("archive", "/"), -1).alias("archive"), "id", value(s).alias("value")) for s, f in frames.items()]
    return reduce(DataFrame.unionByName, parts)


@check("scan_zip_csv", """
SELECT 'case-' || (c_custkey // 500) || '.zip' AS archive, CAST(c_custkey AS VARCHAR) AS "id", substr(c_mktsegment, 1, 1) AS gender,
       CAST(NULL AS VARCHAR) AS weight, 'case ' || c_name AS source, '医師, "他"' || chr(10) || '行' AS job, CAST(NULL AS VARCHAR) AS absent
FROM customer
""")
def zip_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["識別番号", "性別", "体重", "報告区分", "報告者職種", "無い列"]
    rows = archive_csv(event_archives(spark, sf_dir), "demo", columns)
    named = rows.drop("record_no").toDF("archive", "id", "gender", "weight", "source", "job", "absent")
    return named.withColumn("source", F.concat(F.lit("case "), F.col("source")))


@check("archive_members", """
WITH n AS (SELECT a AS archive, (SELECT count(*) FROM customer WHERE c_custkey // 500 = a) AS customers,
                  (SELECT count(*) FROM orders WHERE o_orderkey // 5000 = a) AS orders
           FROM (SELECT c_custkey // 500 AS a FROM customer UNION SELECT o_orderkey // 5000 FROM orders)),
     s AS (SELECT archive, 'DEMO' AS stem, customers AS n FROM n UNION ALL SELECT archive, 'REAC', orders FROM n UNION ALL SELECT archive, 'CASE', 0 FROM n)
SELECT 'case-' || archive || '.zip' AS archive, stem, CASE WHEN n > 0 THEN 'ok' ELSE 'missing' END AS status,
       CASE WHEN n > 0 THEN CASE WHEN archive % 2 = 0 THEN 'utf-8' ELSE 'cp932' END END AS charset, n AS n_rows FROM s
""")
def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_members(event_archives(spark, sf_dir), ["DEMO", "REAC", "CASE"]).drop("member", "problem")
