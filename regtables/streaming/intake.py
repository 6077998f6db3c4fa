"""New files merged into a table as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from regtables.operators.quality import failures
from regtables.plans.pipeline import ValidationError
from regtables.plans.specs import TableSpec
from regtables.sinks.tables import execute_merge, stage, table_name


def read_new_files(
    spark: SparkSession, folder: str, schema: StructType, file_format: str = "parquet", glob: str = "*",
    max_files: int | None = None,
) -> DataFrame:
    """Files of a folder as a stream: each file is read once per checkpoint."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(file_format).load(folder)


def stream_upsert(
    rows: DataFrame,
    spec: TableSpec,
    schema_name: str,
    root: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    rules: Sequence[Mapping[str, Any]] | None = None,
    on_duplicate: str = "error",
    order: Sequence[str] = (),
) -> None:
    """Merges all files not seen before into the table, then stops.

    A batch is staged, checked and merged like any load; one that breaks a rule stops the stream and
    is tried again on the next run. A batch that ran before a crash is merged again with the same
    result. A batch writes anew only the files of the table that hold one of its keys.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        written = stage(transform(batch) if transform else batch, spec, schema_name, root)
        found = failures(written.rows, spec.all_rules if rules is None else rules)
        if found:
            raise ValidationError(f"batch {batch_id}:\n" + "\n".join(found))
        execute_merge(written, spec, schema_name, root, on_duplicate=on_duplicate, order=order)

    (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    # Batches run in a session of their own; this one may still remember the table's old location.
    rows.sparkSession.catalog.refreshTable(table_name(schema_name, spec))
