"""Size checks that decide how a join is run."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# What may be sent to every executor: keys, names or urls, by rows and by bytes.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it: ``spark.checkpoint.dir``, and where that is not
    set, a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/regtables-shared"


def pin(df: DataFrame) -> DataFrame:
    """The rows of ``df`` computed once and kept in the shared folder, without lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a query go as soon as it has ended. Else they stay until the driver happens to
    collect its garbage, and those of all queries of a load lie beside each other."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def text_bytes(df: DataFrame, columns: Sequence[str]) -> Column:
    """Bytes a row takes. Only columns of texts, bytes and nested values are read for it; others count 16."""
    is_text = lambda c: isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType))
    is_nested = lambda c: isinstance(df.schema[c].dataType, (T.ArrayType, T.StructType, T.MapType))
    size = F.lit(16 * len(columns)).cast("bigint")
    for c in columns:
        if is_text(c):
            size = size + F.coalesce(F.octet_length(F.col(c)), F.lit(0))
        elif is_nested(c):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return size


def size_of(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes, summed up in the tasks."""
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(text_bytes(df, df.columns)).alias("b")).first()
    return found.n, found.b or 0


def is_small(n_rows: int, n_bytes: int) -> bool:
    return n_rows <= MAX_BROADCAST_ROWS and n_bytes <= MAX_BROADCAST_BYTES


def small_side(df: DataFrame, pinned: bool = False) -> DataFrame:
    """``df`` for the small side of a join. Its size is taken first: a small one is broadcast; any other
    is left to a shuffled join, where AQE splits skewed partitions. ``pinned``: it is computed already."""
    kept = df if pinned else pin(df)
    return F.broadcast(kept) if is_small(*size_of(kept)) else kept
