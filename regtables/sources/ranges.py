"""Files by byte ranges, so that one file can be read by several tasks."""

from __future__ import annotations

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

RANGE_BYTES = 64 << 20


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it (``file:/…``, ``hdfs://…``, ``s3://…``) and the path in it.
    Raises an ArrowInvalid for a scheme that Arrow doesn't know."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def is_readable_by_range(spark: SparkSession, path: str) -> bool:
    """Whether tasks can open files under the path themselves."""
    full = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = full.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(full).toString()
    try:
        file_system(found)
    except Exception:
        return False
    return True


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, length)`` of the files; their contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length")


def byte_ranges(spark: SparkSession, path: str, glob: str = "*", size: int = RANGE_BYTES) -> DataFrame:
    """``(path, length, start, end)``, a row per range of at most ``size`` bytes; an empty file has an empty one.
    Each range is its own partition as far as the session has partitions for them."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size).cast("bigint"))
    rows = files(spark, path, glob).withColumn("start", F.explode(starts))
    rows = rows.withColumn("end", F.least(F.col("start") + size, F.col("length")))
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), "path", "start")
