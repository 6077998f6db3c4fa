"""Tables: create, stage, append, overwrite, merge.

Every load writes new files first, checks them, and then publishes them by one commit to the schema's log (see
:mod:`regtables.sinks.log`): the tables of one commit change together, and loads that run side by side lose nothing.
:func:`read_table` resolves the last commit. For SQL, each table is also a view in the catalog, which is put in place
right after a commit; a table laid out in buckets is a catalog table at the folder of its last version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from regtables.operators.conform import conform
from regtables.operators.sizing import is_small, text_bytes
from regtables.operators.upsert import check_merge_keys, last_of_files, one_row_per_key, with_keys, without_keys
from regtables.plans.specs import TableSpec
from regtables.sinks.log import CommitLog, Edit, Part, Snapshot, without_files
from regtables.sinks.storage import Storage

RANGES = 1024
# Hashes in hex and JSON take half of what they do with Spark's default.
COMPRESSION = "zstd"
_FILES = "_files.json"  # in a folder of a load: rows and range of keys of each file


@dataclass(frozen=True)
class Staged:
    """Rows written beside the table, not yet visible in it."""

    rows: DataFrame
    location: str
    n_rows: int
    key_bytes: int = 0
    resolved: bool = False  # each key has one row

    @property
    def folder(self) -> str:
        """Below the schema's folder."""
        return "/".join(self.location.split("/")[-2:])

    @property
    def schema_folder(self) -> str:
        return self.location.rsplit("/", 2)[0]


def table_name(schema_name: str, spec: TableSpec) -> str:
    return f"`{schema_name}`.`{spec.name}`"


def schema_folder(schema_name: str, root: str) -> str:
    return f"{root.rstrip('/')}/{schema_name}"


def log_of(spark: SparkSession, schema_name: str, root: str) -> CommitLog:
    return CommitLog(spark, schema_folder(schema_name, root))


def _new_location(root: str, schema_name: str, spec: TableSpec) -> str:
    return f"{schema_folder(schema_name, root)}/{spec.name}/{uuid.uuid4().hex}"


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _write(df: DataFrame, spec: TableSpec, schema_name: str, location: str) -> None:
    """Files of one load. Those of a bucketed table are written as an external table of their own, which is
    dropped again: its files stay."""
    out = df.write.option("compression", COMPRESSION)
    if not spec.buckets:
        out.parquet(location)
        return
    version = f"`{schema_name}`.`{spec.name}_{uuid.uuid4().hex}`"
    out.bucketBy(spec.buckets, *spec.primary_key).option("path", location).saveAsTable(version)
    df.sparkSession.sql(f"DROP TABLE {version}")


def _by_bucket(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows placed so that each bucket is written by one task."""
    return df.repartition(spec.buckets, *spec.primary_key) if spec.buckets else df


# --- reading ------------------------------------------------------------------------------------


def _part_paths(spark: SparkSession, folder: str, part: Part) -> list[str]:
    """Paths below the schema's folder: that of the part, or of the files of it that are left."""
    if not part.without:
        return [part.folder]
    names = (e.name for e in Storage(spark, folder).entries(part.folder) if e.name[:1] not in "._")
    return [f"{part.folder}/{n}" for n in sorted(set(names).difference(part.without))]


def read_parts(spark: SparkSession, schema_folder: str, spec: TableSpec, parts: Sequence[Part]) -> DataFrame:
    paths = [f"{schema_folder}/{p}" for part in parts for p in _part_paths(spark, schema_folder, part)]
    if not paths:
        return spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in spec.schema]))
    return spark.read.schema(spec.schema).parquet(*paths)


def read_table(spark: SparkSession, schema_name: str, spec: TableSpec, root: str, version: int | None = None) -> DataFrame:
    """Rows of the last version, or of an earlier one that has not expired."""
    log = log_of(spark, schema_name, root)
    snapshot = log.latest() if version is None else log.snapshot(version)
    return read_parts(spark, log.storage.folder, spec, snapshot.parts(spec.name))


def _show(spark: SparkSession, schema_name: str, spec: TableSpec, folder: str, parts: Sequence[Part]) -> None:
    """The catalog shows these parts as the table."""
    table = table_name(schema_name, spec)
    if spec.buckets:
        if parts:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}/{parts[-1].folder}'")
            spark.catalog.refreshTable(table)
        return
    paths = [p for part in parts for p in _part_paths(spark, folder, part)]
    if paths:
        files = f"{folder}/{paths[0]}" if len(paths) == 1 else f"{folder}/{{{','.join(paths)}}}"
        query = f"SELECT {_names([f.name for f in spec.schema])} FROM parquet.`{files}`"
    else:
        columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in spec.schema)
        query = f"SELECT {columns} WHERE false"
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS {query}")


def show_last(spark: SparkSession, schema_name: str, specs: Sequence[TableSpec], root: str, snapshot: Snapshot | None = None) -> None:
    """The catalog shows the last version of the tables. If another load commits meanwhile, its version."""
    log = log_of(spark, schema_name, root)
    snapshot = snapshot or log.latest()
    while True:
        for spec in specs:
            _show(spark, schema_name, spec, log.storage.folder, snapshot.parts(spec.name))
        last = log.versions()[-1:] or [0]
        if last[0] <= snapshot.version:
            return
        snapshot = log.snapshot(last[0])


def ensure_tables(spark: SparkSession, schema_name: str, specs: Sequence[TableSpec], root: str) -> None:
    """Schema and tables, if absent; tables that the log knows show their last version. A spec without columns
    is skipped."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema_name}`")
    snapshot = log_of(spark, schema_name, root).latest()
    for spec in specs:
        if not spec.columns:
            continue
        absent = not spark.catalog.tableExists(table_name(schema_name, spec))
        if spec.buckets and absent:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema)
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {table_name(schema_name, spec)} ({columns}) USING parquet "
                f"CLUSTERED BY ({_names(spec.primary_key)}) INTO {spec.buckets} BUCKETS LOCATION '{_new_location(root, schema_name, spec)}' "
                f"TBLPROPERTIES ('primary_key' = '{','.join(spec.primary_key)}')"
            )
        if absent or snapshot.parts(spec.name):
            show_last(spark, schema_name, [spec], root, snapshot)


# --- staging ------------------------------------------------------------------------------------


def stage(df: DataFrame, spec: TableSpec, schema_name: str, root: str) -> Staged:
    """Writes the rows in the columns of the spec, matched by name, and counts them in the files."""
    location = _new_location(root, schema_name, spec)
    _write(_by_bucket(conform(df, spec.schema), spec), spec, schema_name, location)
    return _counted(df.sparkSession, spec, location)


def _counted(spark: SparkSession, spec: TableSpec, location: str, resolved: bool = False) -> Staged:
    rows = spark.read.schema(spec.schema).parquet(location)
    # Not by an Observation: a session that has made one can't train a model of Spark ML any more (4.1).
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(text_bytes(rows, spec.primary_key)), F.lit(0)).alias("key_bytes")).first()
    return Staged(rows, location, found.n, found.key_bytes, resolved)


def _one_row_per_key(staged: Staged, keys: Sequence[str], on_duplicate: str, order: Sequence[str]) -> DataFrame:
    if staged.resolved:
        return staged.rows
    return last_of_files(staged.rows, keys, order) if on_duplicate == "last" else one_row_per_key(staged.rows, keys, on_duplicate, order)


def resolved(staged: Staged, spec: TableSpec, schema_name: str, on_duplicate: str) -> Staged:
    """Staged rows with their repeated keys resolved, for a merge by the primary key. They are written in place of the
    staged ones, which only the caller knows of: those are removed, so a load never holds both of all its tables."""
    check_merge_keys(list(spec.columns), list(spec.primary_key))
    source = _one_row_per_key(staged, spec.primary_key, on_duplicate, ())
    if source is staged.rows:
        return replace(staged, resolved=True)
    spark, folder = source.sparkSession, staged.schema_folder
    location = f"{folder}/{spec.name}/{uuid.uuid4().hex}"
    _write(_by_bucket(source, spec), spec, schema_name, location)
    Storage(spark, folder).delete(staged.folder)
    return _counted(spark, spec, location, resolved=True)


def _key_rank(column: Column, kind: T.DataType) -> Column | None:
    """A number that does not fall where the key rises; None for kinds that have none here."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.StringType):  # the first seven bytes
        return F.conv(F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
    return None


def _files_of(spark: SparkSession, folder: str, spec: TableSpec, part: str) -> dict[str, tuple[int, int | None, int | None]]:
    """Of each file of a part: rows, lowest and highest rank of the first key column. Counted once and kept beside
    the files; only that column is read."""
    storage = Storage(spark, folder)
    if storage.exists(f"{part}/{_FILES}"):
        return {name: tuple(f) for name, f in json.loads(storage.read(f"{part}/{_FILES}")).items()}
    rows = spark.read.schema(spec.schema).parquet(f"{folder}/{part}")
    key = spec.primary_key[0]
    rank = _key_rank(F.col(f"`{key}`"), spec.schema[key].dataType)
    rank = F.lit(None).cast("bigint") if rank is None else rank
    found = rows.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("low"), F.max(rank).alias("high"))
    files = {r.f: (r.n, r.low, r.high) for r in found.collect()}  # a row per file
    storage.write(f"{part}/{_FILES}", json.dumps(files).encode())
    return files


def _part_of(staged: Staged, spec: TableSpec, schema_name: str, parts: Sequence[Part]) -> Part:
    """The staged files as a part. Files that the table has already are written once more."""
    spark, folder, at = staged.rows.sparkSession, staged.schema_folder, staged.folder
    if any(p.folder == at for p in parts):
        at = f"{spec.name}/{uuid.uuid4().hex}"
        _write(_by_bucket(staged.rows, spec), spec, schema_name, f"{folder}/{at}")
    if spec.primary_key and not spec.buckets:
        _files_of(spark, folder, spec, at)
    return Part(at, staged.n_rows)


# --- publishing ---------------------------------------------------------------------------------


def commit(
    spark: SparkSession, schema_name: str, root: str, specs: Sequence[TableSpec], make: Callable[[Snapshot], Mapping[str, Edit]]
) -> Snapshot:
    """Publishes the edits of tables that ``make`` works out, all at once, and shows them in the catalog."""
    snapshot = log_of(spark, schema_name, root).commit(make)
    show_last(spark, schema_name, specs, root, snapshot)
    return snapshot


def edit_of(
    staged: Staged, spec: TableSpec, schema_name: str, mode: str, parts: tuple[Part, ...],
    keys: Sequence[str] | None = None, on_duplicate: str = "error", order: Sequence[str] = (),
) -> Edit:
    """What a load of the staged rows makes of a table that has ``parts``."""
    if mode == "overwrite":
        return Edit("overwrite", (Part(staged.folder, staged.n_rows),))
    if mode == "merge":
        return _merged(staged, spec, schema_name, parts, keys, on_duplicate, order)
    if not spec.buckets or not parts:
        return Edit("append", (_part_of(staged, spec, schema_name, parts),))
    # The buckets of a version lie in one folder.
    table = _bucketed(staged.rows.sparkSession, spec, schema_name, staged.schema_folder, parts)
    return _rewritten(table.unionByName(_by_bucket(staged.rows, spec)), spec, schema_name, staged.schema_folder, parts)


def bulk_load(staged: Staged, spec: TableSpec, schema_name: str, mode: str = "append") -> int:
    """Staged rows appended to the table, or in its place. Nothing happens if there are none, so an
    overwrite with no rows leaves the table as it is. Returns the number of rows loaded."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be either 'append' or 'overwrite'")
    return _load(staged, spec, schema_name, mode)


def _load(staged: Staged, spec: TableSpec, schema_name: str, mode: str, **settings) -> int:
    if staged.n_rows:
        root = staged.schema_folder.rsplit("/", 1)[0]
        make = lambda s: {spec.name: edit_of(staged, spec, schema_name, mode, s.parts(spec.name), **settings)}
        commit(staged.rows.sparkSession, schema_name, root, [spec], make)
    return staged.n_rows


def _bucketed(spark: SparkSession, spec: TableSpec, schema_name: str, folder: str, parts: Sequence[Part]) -> DataFrame:
    """A bucketed table as the catalog knows it, so that its buckets count."""
    _show(spark, schema_name, spec, folder, parts)
    return spark.table(table_name(schema_name, spec))


def _rewritten(rows: DataFrame, spec: TableSpec, schema_name: str, folder: str, parts: tuple[Part, ...]) -> Edit:
    new = f"{spec.name}/{uuid.uuid4().hex}"
    _write(rows, spec, schema_name, f"{folder}/{new}")
    n_rows = rows.sparkSession.read.schema(spec.schema).parquet(f"{folder}/{new}").count()
    return Edit("rewrite", (Part(new, n_rows),), parts)


def compact(spark: SparkSession, schema_name: str, spec: TableSpec, root: str) -> None:
    """Writes the table anew as one part, after many small loads."""
    folder = schema_folder(schema_name, root)
    make = lambda s: {spec.name: _rewritten(_by_bucket(read_parts(spark, folder, spec, s.parts(spec.name)), spec), spec, schema_name, folder, s.parts(spec.name))}
    commit(spark, schema_name, root, [spec], make)


# --- merging ------------------------------------------------------------------------------------


def _key_ranges(rows: DataFrame, rank: Column) -> list[tuple[int, int]]:
    """What the ranks of the keys span: the lowest and highest in each of RANGES cells of the same width."""
    ends = rows.agg(F.min(rank).alias("low"), F.max(rank).alias("high")).first()
    if ends.low is None:
        return []
    cell = F.floor((rank.cast("double") - ends.low) / ((ends.high - ends.low) / RANGES + 1))
    found = rows.where(rank.isNotNull()).groupBy(cell.alias("cell")).agg(F.min(rank).alias("low"), F.max(rank).alias("high"))
    return [(r.low, r.high) for r in found.collect()]


def _may_match(spark: SparkSession, folder: str, spec: TableSpec, parts: Sequence[Part], keys: DataFrame, by: str) -> dict[str, dict[str, int]]:
    """Rows of the files, by part, whose range of keys meets one of ``keys``."""
    rank = _key_rank(F.col(f"`{by}`"), spec.schema[by].dataType) if by == spec.primary_key[0] else None
    ranges = None if rank is None or not parts else _key_ranges(keys, rank)

    def meets(low: int | None, high: int | None) -> bool:
        return ranges is None or (low is not None and any(low <= b and a <= high for a, b in ranges))

    found = {}
    for p in parts:
        files = _files_of(spark, folder, spec, p.folder)
        found[p.folder] = {name: n for name, (n, low, high) in files.items() if name not in p.without and meets(low, high)}
    return found


def _without(
    spark: SparkSession, spec: TableSpec, schema_name: str, folder: str, parts: tuple[Part, ...], gone: DataFrame, by: Sequence[str], few: bool | None
) -> tuple[Part, ...]:
    """The parts without the rows whose ``by`` is in ``gone``. Files that hold none of these stay, by reference: of
    those whose range of keys meets them ``by`` is read, and only files with a match are read whole. The rows that
    stay of those are written anew."""
    candidates = _may_match(spark, folder, spec, parts, gone, by[0])
    paths = [f"{folder}/{p}/{name}" for p, files in candidates.items() for name in files]
    if not paths:
        return parts
    touched: dict[str, dict[str, int]] = {}
    rows = spark.read.schema(spec.schema).parquet(*paths)
    hits = with_keys(rows.select(*by, F.col("_metadata.file_path").alias("_file")), gone, by, few)
    for r in hits.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per file
        *_, part, name = r["_file"].split("/")
        touched.setdefault(f"{spec.name}/{part}", {})[name] = r.n
    rest = [f"{folder}/{p}/{name}" for p, files in touched.items() for name, n in files.items() if n < candidates[p][name]]
    left = {p.folder: p.n_rows - sum(candidates[p.folder][n] for n in touched[p.folder]) for p in parts if p.folder in touched}
    found = without_files(parts, {p: set(files) for p, files in touched.items()}, left)
    if not rest:
        return found
    kept = without_keys(spark.read.schema(spec.schema).parquet(*rest), gone, by, few)
    return (*found, *_rewritten(kept, spec, schema_name, folder, ()).parts)


def _merged(
    staged: Staged, spec: TableSpec, schema_name: str, parts: tuple[Part, ...], keys: Sequence[str] | None, on_duplicate: str, order: Sequence[str]
) -> Edit:
    """The table with the staged rows merged in; the staged files themselves become part of it."""
    spark, folder = staged.rows.sparkSession, staged.schema_folder
    keys = list(keys if keys is not None else spec.primary_key)
    check_merge_keys(list(spec.columns), keys)
    source = _one_row_per_key(staged, keys, on_duplicate, order)
    few = is_small(staged.n_rows, staged.key_bytes) if tuple(keys) == tuple(spec.primary_key) else None
    by = list(spec.replaced_by) or keys
    if spec.buckets:
        # The rows kept of the table are in their buckets already.
        kept = without_keys(_bucketed(spark, spec, schema_name, folder, parts), staged.rows, by, few)
        return _rewritten(kept.unionByName(_by_bucket(source, spec)), spec, schema_name, folder, parts)
    if source is staged.rows:
        added = _part_of(staged, spec, schema_name, parts)
    else:  # repeated keys were resolved
        added = _rewritten(source, spec, schema_name, folder, ()).parts[0]
    return Edit("rewrite", (*_without(spark, spec, schema_name, folder, parts, staged.rows, by, few), added), parts)


def replaced_sources(staged: Staged, spec: TableSpec, schema_name: str, parts: tuple[Part, ...], sources: DataFrame) -> Edit:
    """The table with all rows of some sources replaced by the staged ones. ``sources`` has the column that tells a
    row's source; one that has no rows any more leaves none."""
    spark, folder, by = staged.rows.sparkSession, staged.schema_folder, sources.columns
    if spec.buckets:
        kept = without_keys(_bucketed(spark, spec, schema_name, folder, parts), sources, by)
        return _rewritten(kept.unionByName(_by_bucket(staged.rows, spec)), spec, schema_name, folder, parts)
    added = (_part_of(staged, spec, schema_name, parts),) if staged.n_rows else ()
    return Edit("rewrite", (*_without(spark, spec, schema_name, folder, parts, sources, by, None), *added), parts)


def execute_merge(
    staged: Staged,
    spec: TableSpec,
    schema_name: str,
    root: str,
    keys: Sequence[str] | None = None,
    on_duplicate: str = "error",
    order: Sequence[str] = (),
) -> int:
    """Staged rows merged into the table on its keys: matches updated, others inserted. Returns the number of rows
    merged in. Only files with a matching key are written anew (all, if the table is laid out in buckets).

    In a catalog whose table format has row-level changes, :func:`merge_statement` gives the statement instead.
    """
    check_merge_keys(list(spec.columns), list(keys if keys is not None else spec.primary_key))
    return _load(staged, spec, schema_name, "merge", keys=keys, on_duplicate=on_duplicate, order=order)


def merge_statement(target: str, source: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """``MERGE INTO`` for catalogs whose tables take row-level changes."""
    check_merge_keys(columns, keys)
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    updates = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns if c not in keys)
    names = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(f"s.`{c}`" for c in columns)
    return (
        f"MERGE INTO {target} AS t USING {source} AS s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {updates} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", batch_size: int = 10_000, connections: int = 16, **options
) -> None:
    """Rows into a warehouse table over JDBC, with at most ``connections`` writers at a time."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be either 'append' or 'overwrite'")
    settings = {"batchsize": batch_size, "numPartitions": connections, "truncate": True, **options}
    df.write.options(**settings).mode(mode).jdbc(url, table)


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A warehouse table over JDBC; filters and columns are pushed down. Pass ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` to read it in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
