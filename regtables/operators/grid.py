"""Raw grids: sheets read without a header, ``(file, row_no, cells array<string>)``.

``row_no`` counts from 0 in each file. A file may hold any share of the rows, so no operator
here puts one file into one task.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from regtables.functions.text import remove_whitespace
from regtables.operators.sizing import small_side

HEADER_SEARCH_ROWS = 10
SLICE_ROWS = 100_000


def _quoted(name: str) -> Column:
    """A column by its exact name: source headers hold dots."""
    return F.col(f"`{name}`")


def detect_header(grid: DataFrame, keyword: str, search_rows: int = HEADER_SEARCH_ROWS) -> DataFrame:
    """``(file, header_row, names)`` of the first of the first rows that has a cell with the keyword,
    whitespace apart. Files without one do not appear; see :func:`files_without_header`."""
    is_header = F.exists("cells", lambda c: F.coalesce(remove_whitespace(c).contains(keyword), F.lit(False)))
    return (
        grid.where((F.col("row_no") < search_rows) & is_header)
        .groupBy("file")
        .agg(F.min_by(F.struct("row_no", "cells"), "row_no").alias("h"))
        .select(
            "file",
            F.col("h.row_no").alias("header_row"),
            F.transform("h.cells", remove_whitespace).alias("names"),
        )
    )


def files_without_header(grid: DataFrame, headers: DataFrame) -> DataFrame:
    """Files whose first rows have no header: the error list of :func:`detect_header`."""
    # A file may begin at any row. Only the names are read, and each once per task moved.
    return grid.select("file").distinct().join(headers, "file", "left_anti")


def grid_records(grid: DataFrame, headers: DataFrame, columns: Sequence[str], pinned: bool = False) -> DataFrame:
    """Rows below the header as ``(file, row_no, *columns)``, looked up by header name.
    A column a file does not have is null. ``columns`` are names without whitespace.
    ``pinned`` says that ``headers`` is computed already."""
    joined = grid.join(small_side(headers, pinned=pinned), "file").where(F.col("row_no") > F.col("header_row"))
    # array_position gives 0 for a missing name, and get() gives null for the index before the first.
    cell = lambda name: F.get("cells", (F.array_position("names", F.lit(name)) - 1).cast("int"))
    return joined.select("file", "row_no", *[cell(name).alias(name) for name in columns])


def normalize_headers(df: DataFrame) -> DataFrame:
    """Column names without any whitespace."""
    return df.toDF(*[re.sub(r"\s+", "", name) for name in df.columns])


def drop_empty_rows(df: DataFrame, data_columns: Sequence[str]) -> DataFrame:
    """Without the rows that are null in all data columns."""
    return df.where(reduce(operator.or_, [_quoted(c).isNotNull() for c in data_columns]))


def fill_down(
    df: DataFrame,
    columns: Sequence[str],
    file: str = "file",
    row_no: str = "row_no",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Nulls in ``columns`` replaced by the last value above in the same file (merged cells).

    Files are cut into slices of ``slice_rows`` rows. Within a slice a window fills; what a slice
    takes from above comes from a small table with one row per slice. So the largest task holds
    one slice, and the window over slices sees ``rows / slice_rows`` rows per file.
    """
    sliced = df.withColumn("_slice", F.expr(f"`{row_no}` div {slice_rows}"))
    ends = sliced.groupBy(file, "_slice").agg(
        *[F.max_by(_quoted(c), F.when(_quoted(c).isNotNull(), F.col(row_no))).alias(c) for c in columns]
    )
    above = Window.partitionBy(file).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        file,
        "_slice",
        *[F.last(_quoted(c), ignorenulls=True).over(above).alias(f"_above_{c}") for c in columns],
    )
    within = Window.partitionBy(file, "_slice").orderBy(row_no).rowsBetween(Window.unboundedPreceding, 0)
    filled = sliced.withColumns({c: F.last(_quoted(c), ignorenulls=True).over(within) for c in columns})
    # The window has already placed the rows by file and slice, so the join moves only the small table.
    joined = filled.join(carried, [file, "_slice"], "left")

    def value(c: str) -> Column:
        return F.coalesce(_quoted(c), _quoted(f"_above_{c}")).alias(c) if c in columns else _quoted(c)

    return joined.select(*[value(c) for c in df.columns])
