"""Run state: event types as datasets, their errors and purchases as runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from regtables.checks.registry import check, table
from regtables.functions.dates import display_timestamp
from regtables.sinks.state import latest_state, list_states, upsert_state

_COLUMNS = ["dataset_id", "last_run_ts_utc", "last_successful_run_ts_utc", "status", "last_watermark", "pipeline_version"]


def _runs(spark: SparkSession, sf_dir: str, condition: str) -> DataFrame:
    """One run per user: it failed if the last event was an error or a click."""
    last = table(spark, sf_dir, "events").where(condition).groupBy("user_id").agg(F.max_by(F.struct("ts", "event_type", "event_id"), "event_id").alias("e"))
    ts = F.date_trunc("second", F.col("e.ts").cast("timestamp"))
    status = F.when(F.col("e.event_type").isin("error", "click"), "FAILED").otherwise("SUCCESS")
    return last.select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("dataset_id"),
        ts.alias("last_run_ts_utc"),
        F.when(status == "SUCCESS", ts).alias("last_successful_run_ts_utc"),
        status.alias("status"),
        F.to_json(F.create_map(F.lit("etag"), F.col("e.event_id").cast("string"))).alias("last_watermark"),
        F.lit("1.0").alias("pipeline_version"),
    )


_RUNS = """
  SELECT 'user-' || user_id AS dataset_id, strftime(arg_max(ts, event_id), '%Y-%m-%d %H:%M:%S') AS last_run,
         CASE WHEN arg_max(event_type, event_id) IN ('error', 'click') THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         '{"etag":"' || max(event_id) || '"}' AS last_watermark
  FROM events"""
_STATES = f"""
WITH b AS ({_RUNS} WHERE value < 40 OR value IS NULL GROUP BY user_id), a AS ({_RUNS} WHERE value >= 40 GROUP BY user_id),
     u AS (SELECT coalesce(a.dataset_id, b.dataset_id) AS dataset_id, coalesce(a.last_run, b.last_run) AS last_run,
             CASE WHEN a.status = 'SUCCESS' THEN a.last_run WHEN b.status = 'SUCCESS' THEN b.last_run END AS last_successful_run,
             coalesce(a.status, b.status) AS status, coalesce(a.last_watermark, b.last_watermark) AS last_watermark, '1.0' AS pipeline_version
           FROM a FULL JOIN b ON a.dataset_id = b.dataset_id)
"""


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert_state(_runs(spark, sf_dir, "value < 40 OR value IS NULL").select(*_COLUMNS), _runs(spark, sf_dir, "value >= 40"))


@check("state_upsert", _STATES + "SELECT * FROM u")
def state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = _states(spark, sf_dir)
    return states.select(
        "dataset_id", display_timestamp(F.col("last_run_ts_utc")).alias("last_run"),
        F.date_format("last_successful_run_ts_utc", "yyyy-MM-dd HH:mm:ss").alias("last_successful_run"),
        "status", "last_watermark", "pipeline_version",
    )


@check("state_latest", _STATES + "SELECT dataset_id, status, last_watermark FROM u WHERE dataset_id = 'user-7'")
def state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_state(_states(spark, sf_dir), "user-7").select("dataset_id", "status", "last_watermark")


@check("state_status", _STATES + """
SELECT dataset_id, status, last_run, coalesce(last_successful_run, '') AS last_successful_run, pipeline_version FROM u ORDER BY dataset_id
""")
def state_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_states(_states(spark, sf_dir))


@check("display_timestamp", """
SELECT event_id, CASE event_type WHEN 'click' THEN 'soon' WHEN 'error' THEN '' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS shown FROM events
""")
def displayed_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("""
        CASE event_type WHEN 'click' THEN 'soon' WHEN 'error' THEN NULL
             WHEN 'view' THEN concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), 'Z') ELSE cast(ts AS string) END
    """)
    return table(spark, sf_dir, "events").select("event_id", display_timestamp(text).alias("shown"))
