"""What the operators share: folders, Arrow batches of bounded size, ASCII folding."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regtables.operators.sizing import shared_folder

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SLICE_BYTES = 4 << 20  # text that a task works on at once, if a single text isn't longer
GIVE_BACK_BYTES = 16 << 20  # text after which a task gives back what it has freed


def work_folder(spark: SparkSession, what: str) -> str:
    """A new folder of this call's own in the folder that driver and executors share."""
    return f"{shared_folder(spark)}/llm/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str, **options) -> DataFrame:
    """``df`` as a table in ``folder``: computed once, and read again by whoever loses an executor."""
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ranked(df: DataFrame, order: Sequence[Column], folder: str, **options) -> tuple[DataFrame, int]:
    """``df`` with each row's ``place`` (0, 1, ...) in ``order``, written to ``folder``, and how many rows there are.
    Rows are dealt by ranges and sorted there; a row per partition comes to the driver for its count."""
    dealt = df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    # Partition and row number within it, as this function defines its values.
    rows = written(dealt.withColumn("place", F.monotonically_increasing_id()), folder, **options)
    part, at = F.shiftrightunsigned("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r.part: r.n for r in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, n = [], 0
    for k in range(max(sizes, default=-1) + 1):
        starts.append(n)
        n += sizes.get(k, 0)
    start = F.element_at(F.lit(starts), part.cast("int") + 1) if starts else F.lit(0)
    return rows.withColumn("place", (start + at).cast("bigint")), n


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


@lru_cache
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):  # not glibc
        return lambda pad: 0


def give_back() -> None:
    """Returns memory that was freed to the system. Arrow and the C library keep it otherwise, and a Python worker lives
    on after its task: those that wait would hold their peak beside those that work."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches with about ``limit`` bytes of text each; a longer text stands alone."""
    passed = 0
    try:
        for batch in batches:
            start, size = 0, 0
            column = batch.column(text)
            for i in range(batch.num_rows):
                value = column[i]
                own = value.as_buffer().size if value.is_valid else 0
                if i > start and size + own > limit:
                    yield batch.slice(start, i - start)
                    start, size = i, 0
                size += own
                passed += own
            if start < batch.num_rows:
                yield batch.slice(start)
            if passed > GIVE_BACK_BYTES:
                give_back()
                passed = 0
    finally:
        give_back()


def free_names(columns: Sequence[str], *names: str) -> list[str]:
    """The names, with underscores added where a column has such a name already."""
    taken = {c.lower() for c in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    return [t or "" for t in batch.column(text).to_pylist()]


def parts_of(data: bytes, overlap: int = 0, size: int = 1 << 20) -> Iterator[bytes]:
    """``data`` in parts of at most ``size`` bytes, each with the ``overlap`` bytes before it."""
    for start in range(0, max(1, len(data)), size):
        yield data[max(0, start - overlap) : start + size]
