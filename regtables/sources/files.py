"""CSV, XML, Parquet and binary files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from regtables.sources.ranges import RANGE_BYTES, is_readable_by_range
from regtables.sources.xml import xml_node_texts


def csv_records(
    spark: SparkSession, path: str, encoding: str = "UTF-8", multi_line: bool = False, bad_line: str | None = None
) -> DataFrame:
    """Rows of CSV files with a header. All columns are text: a key such as ``007`` stays what it is.

    Files in one call must have the same header; a file that differs fails instead of being misread.
    ``multi_line`` reads quoted line breaks, at the price that a file is not split. ``bad_line`` names a
    column that keeps a line with more or fewer cells than the header; without it, a line with more
    cells is an error and missing cells are null.
    """
    # Without all columns parsed, a line with more cells than the header would go unnoticed.
    reader = spark.read.options(header=True, encoding=encoding, escape='"', multiLine=multi_line, columnPruning=False)
    names = reader.csv(path).columns
    kept = bad_line or "_bad_line"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, kept]])
    rows = reader.schema(schema).options(enforceSchema=False, columnNameOfCorruptRecord=kept).csv(path)
    if bad_line:
        return rows
    # A line short of cells is flagged as well; only one with more cells than the header loses any.
    cells = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    surplus = F.from_csv(F.col(kept), cells, {"escape": '"'})[f"c{len(names)}"]
    complaint = F.raise_error(F.concat(F.lit("more cells than the header: "), F.col(kept))).cast("boolean")
    # A filter stays whatever is selected later. It names a column of the file, as one of complaints alone is refused,
    # and a row number, as later filters would else be moved before it.
    fine = F.coalesce(F.length(f"`{names[0]}`") >= 0, F.lit(True)) & (F.monotonically_increasing_id() >= 0)
    return rows.where(F.when(surplus.isNotNull(), complaint).otherwise(fine)).drop(kept)


def _steps(xpath: str) -> list[str]:
    """Steps below the root element. ``./a/b`` starts at the root element, ``/root/a/b`` above it."""
    steps = [s for s in xpath.split("/") if s not in ("", ".")]
    if xpath.startswith("/"):
        steps = steps[1:]
    if not steps or "//" in xpath:
        raise ValueError(f"a path of steps below the root element is required, not {xpath!r}")
    return steps


def xml_rows(
    spark: SparkSession, path: str, xpath: str, columns: Sequence[str], require_rows: bool = True, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """One row per node at ``xpath``: its attributes and child texts as text columns. Every step of the path
    counts. Attributes of children are dropped.

    A large file is read by several tasks, each a range of bytes, see :mod:`regtables.sources.xml`; where tasks cannot
    open files themselves, a file is one row of at most 2 GB. An empty path is an error, and so are malformed XML
    and, unless ``require_rows`` is off, a path without a match.
    """
    if not xpath:
        raise ValueError("an xpath is required")
    steps = _steps(xpath)
    if is_readable_by_range(spark, path):
        texts = xml_node_texts(spark, path, steps, range_bytes).select(F.concat(F.lit("<r>"), "node", F.lit("</r>")).alias("_text"))
        rows = xml_nodes(texts, "_text", steps[-1], columns)
    else:
        texts = spark.read.text(path, wholetext=True).select(F.col("value").alias("_text"))
        rows = xml_nodes(texts, "_text", xpath, columns)
    if require_rows and rows.isEmpty():
        raise ValueError(f"no node at {xpath} in {path}")
    return rows


def xml_nodes(documents: DataFrame, text: str, xpath: str, columns: Sequence[str]) -> DataFrame:
    """As :func:`xml_rows`, for XML held in a text column, one document a row. The other columns are kept.
    Malformed XML is an error."""
    steps = _steps(xpath)
    kind = T.StructType([T.StructField(p + c, T.StringType()) for c in columns for p in ("", "_")])
    for step in reversed(steps):
        kind = T.StructType([T.StructField(step, T.ArrayType(kind))])
    others = [c for c in documents.columns if c != text]
    found = documents.select(*others, F.from_xml(F.col(text), kind, {"attributePrefix": "_", "mode": "FAILFAST"}).alias("_node"))
    for step in steps:
        found = found.select(*others, F.explode(F.col(f"_node.`{step}`")).alias("_node"))
    return found.select(*others, *[F.coalesce(f"_node.`{c}`", f"_node.`_{c}`").alias(c) for c in columns])


def parquet_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """The name of the file each row was read from; for DataFrames straight from a file source."""
    return df.withColumn(name, F.col("_metadata.file_name"))


def binary_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, content)``, one row per file of at most 2 GB (the limit of one cell)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
