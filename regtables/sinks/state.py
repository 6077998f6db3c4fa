"""What was loaded, when, and from which version of the source."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from regtables.functions.dates import display_timestamp
from regtables.plans.specs import INGESTION_STATE
from regtables.sinks.log import Edit, Part, Snapshot
from regtables.sinks.tables import commit, read_parts, schema_folder, stage, table_name


def run_row(
    spark: SparkSession, dataset_id: str, as_of: datetime, status: str, watermark: Mapping, pipeline_version: str
) -> DataFrame:
    """One finished run as a row of the state table."""
    success = as_of if status == "SUCCESS" else None
    text = json.dumps(watermark, ensure_ascii=False, sort_keys=True)
    return spark.createDataFrame(
        [(dataset_id, as_of, success, status, text, pipeline_version)], INGESTION_STATE.schema
    )


def upsert_state(states: DataFrame, runs: DataFrame) -> DataFrame:
    """States after the runs (one per dataset). The last success moves only if the run was one."""
    before = states.select("dataset_id", F.col("last_successful_run_ts_utc").alias("_before"))
    success = F.when(F.col("status") == "SUCCESS", F.col("last_run_ts_utc")).otherwise(F.col("_before"))
    updated = runs.join(before, "dataset_id", "left").withColumn("last_successful_run_ts_utc", success)
    others = states.join(runs, "dataset_id", "left_anti")
    return others.unionByName(updated.select(*states.columns))


def latest_state(states: DataFrame, dataset_id: str) -> DataFrame:
    """The state of one dataset; no row if it never ran."""
    return states.where(F.col("dataset_id") == dataset_id).limit(1)


def list_states(states: DataFrame) -> DataFrame:
    """All states for display, times as text, in dataset order."""
    return states.select(
        "dataset_id",
        F.coalesce("status", F.lit("UNKNOWN")).alias("status"),
        display_timestamp(F.col("last_run_ts_utc")).alias("last_run"),
        display_timestamp(F.col("last_successful_run_ts_utc")).alias("last_successful_run"),
        F.coalesce("pipeline_version", F.lit("N/A")).alias("pipeline_version"),
    ).orderBy("dataset_id")


def read_states(spark: SparkSession, schema_name: str) -> DataFrame:
    return spark.table(table_name(schema_name, INGESTION_STATE))


def get_watermark(spark: SparkSession, schema_name: str, dataset_id: str) -> dict:
    """The stored version token of a dataset; ``{}`` if it never ran."""
    row = latest_state(read_states(spark, schema_name), dataset_id).select("last_watermark").first()
    return json.loads(row.last_watermark) if row and row.last_watermark else {}


def state_edit(spark: SparkSession, schema_name: str, root: str, run: DataFrame, snapshot: Snapshot) -> dict[str, Edit]:
    """The state table after a run, to be committed with the tables that the run loaded."""
    parts = snapshot.parts(INGESTION_STATE.name)
    states = read_parts(spark, schema_folder(schema_name, root), INGESTION_STATE, parts)
    staged = stage(upsert_state(states, run), INGESTION_STATE, schema_name, root)
    return {INGESTION_STATE.name: Edit("rewrite", (Part(staged.folder, staged.n_rows),), parts)}


def save_run(spark: SparkSession, schema_name: str, root: str, run: DataFrame) -> None:
    """Stores a run. Runs that end at the same time each keep their row: whoever commits second starts again
    from the other's states."""
    commit(spark, schema_name, root, [INGESTION_STATE], lambda snapshot: state_edit(spark, schema_name, root, run, snapshot))
