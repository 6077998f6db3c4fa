"""Table and dataset specs: columns, keys, rules, load mode."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import types as T

from regtables.plans.types import is_required, schema_of

LOAD_MODES = ("append", "overwrite", "merge")


@dataclass(frozen=True)
class TableSpec:
    """``buckets``: into how many parts a large table is laid out by its primary key. A merge with a
    source too large to broadcast then shuffles the source only. Take at least
    ``spark.sql.shuffle.partitions``; 0 leaves the files as they are written. Key columns must not be
    null there: nulls share one bucket. ``replaced_by``: columns of a parent; a merge replaces all rows of
    each parent it brings rows for, so none is left over from an earlier, longer version."""

    name: str
    columns: Mapping[str, str]
    primary_key: tuple[str, ...] = ()
    rules: tuple[Mapping[str, Any], ...] = ()
    buckets: int = 0
    replaced_by: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return schema_of(dict(self.columns))

    @property
    def all_rules(self) -> list[Mapping[str, Any]]:
        """The declared rules, and ``not_null`` for required columns without one."""
        declared = {r.get("column") for r in self.rules if r.get("check") == "not_null"}
        required = [c for c, t in self.columns.items() if is_required(t) and c not in declared]
        return [*self.rules, *({"column": c, "check": "not_null"} for c in required)]


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    load_mode: str
    tables: Mapping[str, TableSpec] = field(default_factory=dict)
    schema_name: str = "public"

    def __post_init__(self):
        if self.load_mode not in LOAD_MODES:
            raise ValueError(f"load mode must be one of {LOAD_MODES}, not {self.load_mode!r}")
        for table in self.tables.values():
            if self.load_mode == "merge" and not table.primary_key:
                raise ValueError(f"load mode 'merge' needs a primary key for table '{table.name}'")


def with_config(spec: DatasetSpec, config: Mapping[str, Any]) -> DatasetSpec:
    """The spec with the settings of one run: ``schema_name``, ``load_mode``, and per table (or at the
    top for a dataset of one table) ``table_name``, ``primary_key``, ``validation``, ``buckets``."""

    def adjusted(key: str, table: TableSpec) -> TableSpec:
        # Settings at the top are for the main table.
        at_top = config if key == next(iter(spec.tables)) else {}
        own = config.get("tables", {}).get(key, at_top)
        return replace(
            table,
            name=own.get("table_name", table.name),
            primary_key=tuple(own.get("primary_key", table.primary_key)),
            rules=tuple(own.get("validation", table.rules)),
            buckets=own.get("buckets", table.buckets),
        )

    return replace(
        spec,
        schema_name=config.get("schema_name", spec.schema_name),
        load_mode=config.get("load_mode", spec.load_mode),
        tables={key: adjusted(key, t) for key, t in spec.tables.items()},
    )


# --- fixed values: columns and types of the target tables ----------------------------------------

_LINEAGE = {
    "raw_data_full": "JSONB",
    "_meta_load_ts_utc": "TIMESTAMPTZ",
    "_meta_extraction_ts_utc": "TIMESTAMPTZ",
    "_meta_source_url": "TEXT",
    "_meta_pipeline_version": "VARCHAR(50)",
    "_meta_source_content_hash": "VARCHAR(64)",
}

INGESTION_STATE = TableSpec(
    "ingestion_state",
    {
        "dataset_id": "VARCHAR(100) NOT NULL",
        "last_run_ts_utc": "TIMESTAMPTZ",
        "last_successful_run_ts_utc": "TIMESTAMPTZ",
        "status": "VARCHAR(50)",
        "last_watermark": "JSONB",
        "pipeline_version": "VARCHAR(50)",
    },
    ("dataset_id",),
)

# One row per source of a dataset that is loaded source by source.
SOURCE_STATE = TableSpec(
    "source_state",
    {
        "dataset_id": "VARCHAR(100) NOT NULL",
        "url": "TEXT NOT NULL",
        "etag": "TEXT",
        "last_modified": "TEXT",
        "last_loaded_ts_utc": "TIMESTAMPTZ",
    },
    ("url", "dataset_id"),
)

RUN_INPUTS = TableSpec(
    "run_inputs",
    {"dataset_id": "VARCHAR(100) NOT NULL", "run_ts_utc": "TIMESTAMPTZ", "status": "VARCHAR(50)", "input": "JSONB"},
)

RULE_VALUES = TableSpec("rule_values", {"table_name": "TEXT", "column_name": "TEXT", "value": "TEXT", "n_rows": "BIGINT"})

APPROVALS = DatasetSpec(
    "approvals",
    "overwrite",
    {
        "approvals": TableSpec(
            "approvals",
            {
                "approval_id": "INTEGER",
                "application_type": "VARCHAR(50)",
                "brand_name_jp": "TEXT",
                "generic_name_jp": "TEXT",
                "applicant_name_jp": "TEXT",
                "approval_date": "DATE",
                "indication": "TEXT",
                "review_report_url": "TEXT",
                "_meta_load_ts_utc": "TIMESTAMPTZ",
                "_meta_source_content_hash": "VARCHAR(64)",
                "_meta_source_url": "TEXT",
                "_meta_pipeline_version": "VARCHAR(50)",
            },
            ("approval_id",),
            (
                {"column": "approval_id", "check": "not_null"},
                {"column": "approval_id", "check": "is_unique"},
                {"column": "approval_date", "check": "not_null"},
                {"column": "approval_date", "check": "has_type", "type": "datetime"},
                {
                    "column": "application_type",
                    "check": "is_in_set",
                    "allowed_values": ["医薬品", "医療機器", "再生医療等製品", "体外診断用医薬品"],
                },
            ),
        ),
        # The source rows of the approvals; rows of one load share their load time.
        "records": TableSpec(
            "approval_records",
            {
                "approval_id": "TEXT",
                "source_order": "JSONB",
                "raw_data_full": "JSONB",
                "_meta_load_ts_utc": "TIMESTAMPTZ",
            },
            ("approval_id", "source_order"),
        ),
    },
)

# The older layout: the licence number is the id, and rows are not collapsed.
APPROVAL_ROWS = TableSpec(
    "approvals",
    {**APPROVALS.tables["approvals"].columns, "approval_id": "VARCHAR(100)", "raw_data_full": "JSONB"},
    ("approval_id",),
)

ADVERSE_EVENTS = DatasetSpec(
    "adverse_events",
    "merge",
    {
        "DEMO": TableSpec(
            "adverse_demo",
            {
                "identification_number": "VARCHAR(50) NOT NULL",
                "gender": "VARCHAR(10)",
                "age": "VARCHAR(20)",
                "weight": "VARCHAR(20)",
                "height": "VARCHAR(20)",
                "report_fiscal_year_quarter": "VARCHAR(50)",
                "outcome": "TEXT",
                "report_source": "TEXT",
                "reporter_qualification": "TEXT",
                **_LINEAGE,
            },
            ("identification_number",),
        ),
        "DRUG": TableSpec(
            "adverse_drug",
            {
                "drug_id": "VARCHAR(64) NOT NULL",
                "identification_number": "VARCHAR(50) NOT NULL",
                "drug_involvement": "TEXT",
                "drug_name": "TEXT",
                "usage_reason": "TEXT",
                **_LINEAGE,
            },
            ("drug_id",),
        ),
        "REAC": TableSpec(
            "adverse_reac",
            {
                "reac_id": "VARCHAR(64) NOT NULL",
                "identification_number": "VARCHAR(50) NOT NULL",
                "adverse_event_name": "TEXT",
                "onset_date": "DATE",
                **_LINEAGE,
            },
            ("reac_id",),
        ),
        "HIST": TableSpec(
            "adverse_hist",
            {
                "hist_id": "VARCHAR(64) NOT NULL",
                "identification_number": "VARCHAR(50) NOT NULL",
                "past_medical_history": "TEXT",
                **_LINEAGE,
            },
            ("hist_id",),
        ),
    },
)


# What a document holds is in its pages.
_DOCUMENT_LINEAGE = {"n_pages": "BIGINT", **{c: t for c, t in _LINEAGE.items() if c != "raw_data_full"}}


def _pages_table(name: str) -> TableSpec:
    """Pages of documents. A document loaded again brings all its pages."""
    columns = {"document_id": "VARCHAR(64) NOT NULL", "page_no": "BIGINT NOT NULL", "page_text": "TEXT", "page_tables": "JSONB"}
    return TableSpec(name, columns, ("document_id", "page_no"), replaced_by=("document_id",))


PACKAGE_INSERTS = DatasetSpec(
    "package_inserts",
    "merge",
    {
        "package_inserts": TableSpec("package_inserts", {"document_id": "VARCHAR(64) NOT NULL", **_DOCUMENT_LINEAGE}, ("document_id",)),
        "pages": _pages_table("package_insert_pages"),
    },
)

REVIEW_REPORTS = DatasetSpec(
    "review_reports",
    "merge",
    {
        "review_reports": TableSpec(
            "review_reports",
            {
                "document_id": "VARCHAR(64) NOT NULL",
                "brand_name_jp": "TEXT",
                "generic_name_jp": "TEXT",
                "applicant_name_jp": "TEXT",
                "application_date": "DATE",
                "approval_date": "DATE",
                "review_summary_text": "TEXT",
                **_DOCUMENT_LINEAGE,
            },
            ("document_id",),
        ),
        "pages": _pages_table("review_report_pages"),
    },
)

XML_REPORT = DatasetSpec(
    "xml_report",
    "overwrite",
    {
        "xml_reports": TableSpec(
            "xml_reports", {"id": "TEXT", "name": "TEXT", "category": "TEXT", "status": "TEXT"}, ("id",)
        )
    },
)

DATASETS = {d.name: d for d in (APPROVALS, ADVERSE_EVENTS, PACKAGE_INSERTS, REVIEW_REPORTS, XML_REPORT)}
