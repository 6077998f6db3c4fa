"""Bringing source columns to the target schema, with lineage."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from regtables.functions.records import content_hash


def rename_columns(df: DataFrame, mapping: Mapping[str, str], keep_unmapped: bool = True) -> DataFrame:
    """Columns renamed by the map; columns outside it are kept or dropped."""
    renamed = df.withColumnsRenamed(dict(mapping))
    if keep_unmapped:
        return renamed
    return renamed.select(*[mapping[c] for c in df.columns if c in mapping])


def require_columns(df: DataFrame, expected: Iterable[str], optional: Iterable[str] = ()) -> DataFrame:
    """``df`` itself, or an error that names the columns it lacks. Runs no job."""
    missing = set(expected) - set(optional) - set(df.columns)
    if missing:
        raise ValueError(f"columns missing from the source: {sorted(missing)}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of the schema, in its order and types: missing ones null, others cut.
    Text that does not fit the type becomes null."""
    have = set(df.columns)

    def column(field: T.StructField):
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if df.schema[field.name].dataType == field.dataType:
            return F.col(f"`{field.name}`")
        return F.col(f"`{field.name}`").try_cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def union_files(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns are matched by name, absent ones are null."""
    if not frames:
        raise ValueError("no frames to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def add_lineage(
    df: DataFrame,
    source_url,
    as_of: datetime,
    pipeline_version: str,
    extraction_ts: datetime | None = None,
    raw: str = "raw_data_full",
) -> DataFrame:
    """Run metadata and the content hash of the raw record. The load time is a parameter,
    so a rerun gives the same rows. ``source_url`` is a text or a Column."""
    added = {
        "_meta_load_ts_utc": F.lit(as_of),
        "_meta_source_url": F.lit(source_url),
        "_meta_pipeline_version": F.lit(pipeline_version),
    }
    if extraction_ts is not None:
        added["_meta_extraction_ts_utc"] = F.lit(extraction_ts)
    if raw in df.columns and "_meta_source_content_hash" not in df.columns:
        added["_meta_source_content_hash"] = content_hash(F.col(raw))
    return df.withColumns(added)
