"""Where queries are registered, and what they share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from regtables.operators.sizing import shared_folder

AS_OF = datetime(2025, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
AS_OF_TEXT = "2025-01-02 03:04:05"


@dataclass(frozen=True)
class Check:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None):
    """Registers a query and the SQL that DuckDB runs for it on the same tables."""

    def register(run):
        if name in CHECKS:
            raise ValueError(f"query {name} is registered twice")
        CHECKS[name] = Check(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    """A folder of this call's own in the shared folder."""
    return f"{shared_folder(spark)}/regtables/{uuid.uuid4().hex}"


def new_schema() -> str:
    return f"reg_{uuid.uuid4().hex[:12]}"
