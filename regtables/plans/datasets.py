"""Transforms of the datasets: source rows in, target tables out."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from regtables import __version__
from regtables.functions.dates import to_iso_date
from regtables.functions.records import (
    document_id, lenient_int, raw_json, raw_json_of_file, row_hash_id,
)
from regtables.functions.text import label_value
from regtables.operators.collapse import collapse_by_key, source_rows
from regtables.operators.conform import add_lineage, conform, rename_columns, require_columns
from regtables.operators.grid import detect_header, drop_empty_rows, fill_down, files_without_header, grid_records
from regtables.operators.sizing import pin
from regtables.plans.specs import ADVERSE_EVENTS, APPROVAL_ROWS, APPROVALS, PACKAGE_INSERTS, REVIEW_REPORTS, DatasetSpec
from regtables.sources.archives import Frames
from regtables.sources.documents import document_marks, page_section

# Header names of the sources and the target columns they feed.
APPROVAL_COLUMNS = {
    "No.": "approval_id",
    "申請区分": "application_type",
    "販売名": "brand_name_jp",
    "一般名": "generic_name_jp",
    "申請者名": "applicant_name_jp",
    "承認年月日": "approval_date",
    "備考": "remarks",
}
APPROVAL_HEADER_KEYWORD = "販売名"
OLD_APPROVAL_COLUMNS = {
    "承認番号": "approval_id",
    "申請区分": "application_type",
    "販売名": "brand_name_jp",
    "一般名": "generic_name_jp",
    "申請者": "applicant_name_jp",
    "承認日": "approval_date",
    "効能・効果": "indication",
    "審査報告書": "review_report_url",
}
ADVERSE_EVENT_COLUMNS = {
    "DEMO": {
        "識別番号": "identification_number",
        "性別": "gender",
        "年齢": "age",
        "体重": "weight",
        "身長": "height",
        "報告年度・四半期": "report_fiscal_year_quarter",
        "転帰": "outcome",
        "報告区分": "report_source",
        "報告者職種": "reporter_qualification",
    },
    "DRUG": {
        "識別番号": "identification_number",
        "医薬品の関与": "drug_involvement",
        "医薬品名": "drug_name",
        "使用理由": "usage_reason",
    },
    "REAC": {
        "識別番号": "identification_number",
        "副作用名": "adverse_event_name",
        "発現日": "onset_date",
    },
    "HIST": {
        "識別番号": "identification_number",
        "原疾患等": "past_medical_history",
    },
}
ROW_ID_COLUMNS = {"DRUG": "drug_id", "REAC": "reac_id", "HIST": "hist_id"}
REVIEW_LABELS = {
    "brand_name_jp": "販売名",
    "generic_name_jp": "一般的名称",
    "applicant_name_jp": "申請者名",
    "application_date": "申請年月日",
    "approval_date": "承認年月日",
}
REVIEW_SUMMARY_HEADING = "審査の概要"

FILL_DOWN_COLUMNS = 3
_OPTIONAL = ("remarks",)


def unreadable_sheets(grid: DataFrame, headers: DataFrame, mapping: Mapping[str, str] = APPROVAL_COLUMNS) -> DataFrame:
    """``(file, problem)`` of every sheet without a header or without a needed column. ``headers`` is what
    :func:`detect_header` gives."""
    needed = F.array(*[F.lit(k) for k, v in mapping.items() if v not in _OPTIONAL])
    lacking = headers.select("file", F.array_except(needed, "names").alias("lacking")).where(F.size("lacking") > 0)
    return (
        files_without_header(grid, headers)
        .select("file", F.lit(f"no header with {APPROVAL_HEADER_KEYWORD}").alias("problem"))
        .unionByName(lacking.select("file", F.concat(F.lit("missing columns: "), F.array_join("lacking", ", ")).alias("problem")))
    )


def approval_records(grid: DataFrame, mapping: Mapping[str, str] = APPROVAL_COLUMNS) -> DataFrame:
    """Raw sheets to ``(file, row_no, renamed columns)``: header found, empty rows dropped, the first
    three columns filled down. A sheet without a header or without a needed column is an error."""
    headers = pin(detect_header(grid, APPROVAL_HEADER_KEYWORD))
    told = unreadable_sheets(grid, headers, mapping).agg(F.count(F.lit(1)).alias("n"), F.min(F.concat("file", F.lit(": "), "problem")).alias("first")).first()
    if told.n:
        raise ValueError(f"{told.n} sheets cannot be read, the first is {told.first}; unreadable_sheets() lists all")
    names = list(mapping)
    rows = drop_empty_rows(grid_records(grid, headers, names, pinned=True), names)
    filled = fill_down(rows, names[:FILL_DOWN_COLUMNS])
    return rename_columns(filled, {**mapping, "file": "file", "row_no": "row_no"}, keep_unmapped=False)


def approvals(
    records: DataFrame,
    source_url: str | Column,
    as_of: datetime,
    order: tuple[str, ...] = ("file", "row_no"),
    pipeline_version: str = __version__,
) -> DataFrame:
    """Records of the list, one row per approval id: texts joined, first date and type kept, a hash over
    all source rows."""
    require_columns(records, [v for v in APPROVAL_COLUMNS.values()], _OPTIONAL)
    first = {
        "application_type": "application_type",
        "approval_date": to_iso_date(F.col("approval_date")),
        "review_report_url": "review_report_url",
    }
    collapsed = collapse_by_key(
        records,
        "approval_id",
        list(order),
        first=first,
        joined=["brand_name_jp", "generic_name_jp", "applicant_name_jp", "indication"],
        record=[c for c in records.columns if c not in order],
        sized=True,
    )
    table = collapsed.withColumn("approval_id", lenient_int(F.col("approval_id")))
    table = add_lineage(table, source_url, as_of, pipeline_version)
    return conform(table, APPROVALS.tables["approvals"].schema)


def approval_tables(
    records: DataFrame,
    source_url: str | Column,
    as_of: datetime,
    order: tuple[str, ...] = ("file", "row_no"),
    pipeline_version: str = __version__,
) -> dict[str, DataFrame]:
    """The tables of the dataset: the approvals, and the source rows they were made of."""
    record = [c for c in records.columns if c not in order]
    rows = source_rows(records, "approval_id", order, record).withColumn("_meta_load_ts_utc", F.lit(as_of))
    return {"approvals": approvals(records, source_url, as_of, order, pipeline_version), "records": rows}


def approval_rows(
    records: DataFrame, source_url: str | Column, as_of: datetime, pipeline_version: str = __version__
) -> DataFrame:
    """Records of the list as they are, one row each: the older layout, in which the id is text and the
    raw record names its file. ``records`` has ``file`` besides the renamed columns."""
    record = [c for c in records.columns if c not in ("file", "row_no")]
    rows = records.withColumn("raw_data_full", raw_json_of_file(record, F.col("file")))
    rows = rows.withColumn("approval_date", to_iso_date(F.col("approval_date")))
    return conform(add_lineage(rows, source_url, as_of, pipeline_version), APPROVAL_ROWS.schema)


def adverse_events(
    frames: Mapping[str, DataFrame],
    source_url: str | Column,
    as_of: datetime,
    extraction_ts: datetime | None = None,
    pipeline_version: str = __version__,
) -> dict[str, DataFrame]:
    """The four record tables. ``frames`` maps DEMO, DRUG, REAC, HIST to rows with the source headers;
    other columns (archive, record number) are left out of the record."""
    tables = {}
    for stem, raw in frames.items():
        mapping = ADVERSE_EVENT_COLUMNS[stem]
        names = [c for c in raw.columns if c in mapping]
        require_columns(raw, mapping)
        table = raw.withColumn("raw_data_full", raw_json(names))
        table = rename_columns(table, {**mapping, "raw_data_full": "raw_data_full"}, keep_unmapped=False)
        if "onset_date" in table.columns:
            table = table.withColumn("onset_date", to_iso_date(F.col("onset_date")))
        if stem in ROW_ID_COLUMNS:
            table = table.withColumn(ROW_ID_COLUMNS[stem], row_hash_id(mapping.values()))
        table = add_lineage(table, source_url, as_of, pipeline_version, extraction_ts or as_of)
        tables[stem] = conform(table, ADVERSE_EVENTS.tables[stem].schema)
    # What became of the archives goes with the tables.
    return Frames(tables, getattr(frames, "account", None))


def _document_tables(
    pages: DataFrame, name: str, spec: DatasetSpec, documents: DataFrame, as_of: datetime, extraction_ts: datetime | None, version: str
) -> dict[str, DataFrame]:
    """The documents and the pages of exactly those documents."""
    rows = documents.withColumn("document_id", document_id(F.col("url")))
    table = conform(add_lineage(rows, F.col("url"), as_of, version, extraction_ts or as_of), spec.tables[name].schema)
    own = pages.join(documents.select("url"), "url", "left_semi").select(
        document_id(F.col("url")).alias("document_id"), F.col("page_no").cast("bigint").alias("page_no"),
        F.col("text").alias("page_text"), F.to_json("tables").alias("page_tables"),
    )
    return {name: table, "pages": own}


def package_inserts(
    pages: DataFrame, as_of: datetime, extraction_ts: datetime | None = None, pipeline_version: str = __version__
) -> dict[str, DataFrame]:
    """``(url, page_no, text, tables)`` to one row per document and its pages; documents without text and
    tables are skipped."""
    documents = document_marks(pages, {}, doc="url").where("has_text OR has_tables")
    return _document_tables(pages, "package_inserts", PACKAGE_INSERTS, documents, as_of, extraction_ts, pipeline_version)


def review_reports(
    pages: DataFrame, as_of: datetime, extraction_ts: datetime | None = None, pipeline_version: str = __version__
) -> dict[str, DataFrame]:
    """``(url, page_no, text, tables)`` to one row of fields per document and its pages; documents without text
    are skipped. A label and its value share a line and so a page; the summary may run over pages."""
    fields = {column: label_value(F.col("text"), label) for column, label in REVIEW_LABELS.items()}
    documents = document_marks(pages, fields, doc="url").where("has_text")
    dated = documents.withColumns({c: to_iso_date(F.col(c)) for c in REVIEW_LABELS if c.endswith("_date")})
    summaries = page_section(pages, REVIEW_SUMMARY_HEADING, "review_summary_text", doc="url")
    found = dated.join(summaries, "url", "left")
    return _document_tables(pages, "review_reports", REVIEW_REPORTS, found, as_of, extraction_ts, pipeline_version)
