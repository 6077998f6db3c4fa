"""Raw sheets: one per nation, with title rows above the header and suppliers below it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from regtables.checks.registry import check, table
from regtables.operators.grid import detect_header, files_without_header, fill_down, grid_records


def _sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header of nation n is in row n % 12, so some lie below the searched rows;
    sheets of odd nations have their columns in another order."""
    nations = table(spark, sf_dir, "nation").withColumn("h", F.expr("n_nationkey % 12"))
    titles = nations.selectExpr("n_name AS file", "explode(sequence(0, h)) AS row_no", "h", "n_nationkey").selectExpr(
        "file", "CAST(row_no AS bigint) AS row_no",
        """CASE WHEN row_no < h THEN array('list of', cast(NULL AS string), file)
                WHEN n_nationkey % 2 = 0 THEN array('No.', '販 売\n名', '申請者名')
                ELSE array('申請者名', 'No.', ' 販売名 ') END AS cells""",
    )
    rows = table(spark, sf_dir, "supplier").join(nations, F.expr("s_nationkey = n_nationkey")).selectExpr(
        "n_name AS file", "s_suppkey + 100 AS row_no",
        """CASE WHEN n_nationkey % 2 = 0 THEN array(cast(s_suppkey AS string), s_name, n_name)
                ELSE array(n_name, cast(s_suppkey AS string), s_name) END AS cells""",
    )
    return titles.unionByName(rows)


@check("detect_header", """
SELECT n_name AS file, CAST(n_nationkey % 12 AS BIGINT) AS header_row,
       CASE WHEN n_nationkey % 2 = 0 THEN 'No.|販売名|申請者名' ELSE '申請者名|No.|販売名' END AS names
FROM nation WHERE n_nationkey % 12 < 10
""")
def header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_header(_sheets(spark, sf_dir), "販売名")
    return found.select("file", "header_row", F.array_join("names", "|").alias("names"))


@check("sheets_without_header", "SELECT n_name AS file FROM nation WHERE n_nationkey % 12 >= 10")
def sheets_without_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets = _sheets(spark, sf_dir)
    return files_without_header(sheets, detect_header(sheets, "販売名"))


@check("grid_records", """
SELECT n_name AS file, s_suppkey + 100 AS row_no, CAST(s_suppkey AS VARCHAR) AS id, s_name AS brand,
       n_name AS applicant, CAST(NULL AS VARCHAR) AS remarks
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 12 < 10
""")
def sheet_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets = _sheets(spark, sf_dir)
    rows = grid_records(sheets, detect_header(sheets, "販売名"), ["No.", "販売名", "申請者名", "備考"])
    return rows.toDF("file", "row_no", "id", "brand", "applicant", "remarks")


@check("fill_down", """
SELECT event_type AS file, event_id AS row_no,
       last_value(CASE WHEN value > 60 THEN user_id END IGNORE NULLS) OVER w AS a,
       last_value(CASE WHEN value < 2 THEN props END IGNORE NULLS) OVER w AS b,
       value > 30 AS c
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def filled_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_type AS file", "event_id AS row_no", "CASE WHEN value > 60 THEN user_id END AS a",
        "CASE WHEN value < 2 THEN props END AS b", "value > 30 AS c",
    )
    return fill_down(rows, ["a", "b"])
