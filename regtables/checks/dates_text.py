"""Dates, fields, sections and urls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from regtables.checks.registry import check, table
from regtables.functions.dates import to_iso_date
from regtables.functions.text import label_value, section_text
from regtables.functions.urls import url_file_name, url_suffix

# Order dates moved into five eras, then written in ten ways, one of them unreadable.
_SHIFT_YEARS = "CASE o_orderpriority WHEN '1-URGENT' THEN -22 WHEN '2-HIGH' THEN 20 WHEN '3-MEDIUM' THEN 72 WHEN '4-NOT SPECIFIED' THEN 100 ELSE 0 END"
_STYLE = "o_custkey % 10"


@check("parse_mixed_dates", f"""
SELECT o_orderkey, CASE WHEN {_STYLE} = 9 THEN NULL
       ELSE strftime(CAST(o_orderdate AS DATE) - to_months(CAST(12 * ({_SHIFT_YEARS}) AS INTEGER)), '%Y-%m-%d') END AS iso_date
FROM orders
""")
def mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.expr(f"add_months(CAST(o_orderdate AS DATE), -12 * ({_SHIFT_YEARS}))").alias("d")
    )
    era = """
        CASE WHEN d >= '2019-05-01' THEN struct('令和' AS name, year(d) - 2018 AS n)
             WHEN d >= '1989-01-08' THEN struct('平成' AS name, year(d) - 1988 AS n)
             WHEN d >= '1926-12-25' THEN struct('昭和' AS name, year(d) - 1925 AS n)
             WHEN d >= '1912-07-30' THEN struct('大正' AS name, year(d) - 1911 AS n)
             ELSE struct('明治' AS name, year(d) - 1867 AS n) END
    """
    written = dated.withColumn("era", F.expr(era)).withColumn("era_year", F.expr("if(era.n = 1, '元', cast(era.n AS string))"))
    text = F.expr(f"""
        CASE {_STYLE}
          WHEN 0 THEN date_format(d, 'yyyy-MM-dd') WHEN 1 THEN date_format(d, 'yyyy/M/d')
          WHEN 2 THEN date_format(d, 'yyyy.MM.dd') WHEN 3 THEN date_format(d, 'yyyyMMdd')
          WHEN 4 THEN date_format(d, 'yyyy年M月d日') WHEN 5 THEN concat(' ', date_format(d, 'yyyy/MM/dd'), ' ')
          WHEN 6 THEN concat('　', era.name, era_year, '年 ', month(d), '月 ', day(d), '日　')
          WHEN 9 THEN concat(era.name, era_year, '年', month(d), '月')
          ELSE concat(era.name, era_year, '年', month(d), '月', day(d), '日') END
    """)
    return written.select("o_orderkey", to_iso_date(text).cast("string").alias("iso_date"))


_CARD_SQL = """
    concat_ws(chr(10), '名簿: ' || c_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN '区分:  ' || c_mktsegment || ' ' END,
              'x 区分: no', '国 (番号): ' || c_nationkey, '区分: second')
"""


@check("label_values", """
SELECT c_custkey, c_name AS name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment ELSE 'second' END AS segment,
       CAST(c_nationkey AS VARCHAR) AS nation, CAST(NULL AS VARCHAR) AS absent
FROM customer
""")
def label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = F.expr(_CARD_SQL)
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        label_value(card, "名簿").alias("name"),
        label_value(card, "区分").alias("segment"),
        label_value(card, "国 (番号)").alias("nation"),
        label_value(card, "承認").alias("absent"),
    )


@check("section_text", r"""
WITH r AS (SELECT doc_id, lang, regexp_extract(t, '(?s)審査の概要\s*\n(.*)', 1) AS rest
           FROM (SELECT doc_id, lang, CASE WHEN lang = 'es' THEN text ELSE '1. 表題' || chr(10) || '審査の概要 ' || chr(10) || text ||
                 CASE WHEN lang = 'fr' THEN '' ELSE chr(10) || ' 2. 次の節' || chr(10) || text END END AS t FROM documents)),
     e AS (SELECT *, regexp_extract(rest, '\n\s*\d+\.') AS mark FROM r)
SELECT doc_id, CASE WHEN lang <> 'es' THEN regexp_replace(
         CASE WHEN mark = '' THEN rest ELSE left(rest, instr(rest, mark) - 1) END, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') END AS summary
FROM e
""")
def section_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr(r"""
        CASE WHEN lang = 'es' THEN text ELSE concat('1. 表題\n審査の概要 \n', text,
             CASE WHEN lang = 'fr' THEN '' ELSE concat('\n 2. 次の節\n', text) END) END
    """)
    return table(spark, sf_dir, "documents").select("doc_id", section_text(text, "審査の概要").alias("summary"))


@check("url_file_name", r"""
SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS file_name,
       regexp_extract(regexp_replace(regexp_extract(url, '([^/]*)$', 1), '[?#].*$', ''), '(\.[^.]+)$', 1) AS suffix
FROM pages
""")
def url_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", url_file_name(url).alias("file_name"), url_suffix(url).alias("suffix")
    )
