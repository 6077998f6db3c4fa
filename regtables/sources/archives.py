"""Archives of CSV members, and the charset of files.

:func:`archive_tables` reads archives of any size where they lie: a data source looks at their central directories and
plans a partition for each member, which a task finds by its place in the archive; of many archives the small ones are
put together, whole, into tasks of about the same size. All members are read in one pass, and an account of what could not be read comes with the tables. A deflated member cannot be split.

The functions on ``(path, content)`` are for archives that are rows already, at most 2 GB each. Tasks decode and parse
a member as a stream, a bounded number of rows at a time.
"""

from __future__ import annotations

import codecs
import fnmatch
import io
import json
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from regtables.operators.sizing import shared_folder
from regtables.sources.ranges import file_system

CHARSETS = ("utf-8", "cp932")
FALLBACK_CHARSET = "cp932"
CHUNK_ROWS = 20_000
_BLOCK = 1 << 20
# Into how many tasks many small archives are put together at least, and what such a task reads at most.
_TASKS, _TASK_BYTES = 64, 16 << 20
_HELD_BYTES = 32 << 20
# What a task gives on at once, if a single file isn't longer: rows, and bytes of the files.
_PIECE_ROWS, _PIECE_BYTES = 4096, 1 << 20
# What a broken archive or member raises; pandas parse errors are ValueErrors.
_UNREADABLE = (zipfile.BadZipFile, zlib.error, OSError, EOFError, ValueError, RuntimeError, NotImplementedError)


def _decodes(stream, charset: str) -> bool:
    decoder = codecs.getincrementaldecoder(charset)("strict")
    try:
        while block := stream.read(_BLOCK):
            decoder.decode(block)
        decoder.decode(b"", final=True)
    except UnicodeDecodeError:
        return False
    return True


def resolve_charset(open_stream, candidates: Sequence[str], fallback: str) -> tuple[str, bool]:
    """The first charset that decodes the whole stream, else the fallback. True if it decodes strictly."""
    for charset in candidates:
        with open_stream() as stream:
            if _decodes(stream, charset):
                with open_stream() as again:
                    has_bom = charset == "utf-8" and again.read(3) == codecs.BOM_UTF8
                return ("utf-8-sig" if has_bom else charset), True
    return fallback, False


_DECODED = pa.schema([("path", pa.string()), ("charset", pa.string()), ("decode_errors", pa.int64()), ("text", pa.string())])


def in_pieces(rows: Iterable[tuple[int, tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows, each with the bytes it stands for, as batches that are bounded in rows and in bytes: a task holds one of
    these, however many rows it has and however short they are."""
    done, held = [], 0
    for size, row in rows:
        done.append(row)
        held += size
        if held >= _PIECE_BYTES or len(done) >= _PIECE_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
            done, held = [], 0
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)


def decode_files(
    files: DataFrame, candidates: Sequence[str] = CHARSETS, fallback: str = FALLBACK_CHARSET
) -> DataFrame:
    """``(path, charset, decode_errors, text)`` of binary files. Bytes the fallback cannot read
    become U+FFFD, and ``decode_errors`` counts them."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
        for batch in batches:
            for path, content in zip(batch.column("path"), (c.as_py() for c in batch.column("content"))):
                charset, strict = resolve_charset(lambda: io.BytesIO(content), candidates, fallback)
                text = content.decode(charset, "strict" if strict else "replace")
                yield len(content), (path.as_py(), charset, 0 if strict else text.count("\ufffd"), text)

    return files.select("path", "content").mapInArrow(
        lambda batches: in_pieces(decoded(batches), _DECODED), "path string, charset string, decode_errors bigint, text string"
    )


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    """Object columns with None for what is absent: what Arrow takes for a nullable column."""
    return frame.astype(object).where(frame.notna(), None)


def _find_member(archive: zipfile.ZipFile, stem: str) -> str | None:
    wanted = f"{stem}.csv".lower()
    return next((name for name in archive.namelist() if name.lower() == wanted), None)


class _Member:
    """One CSV member of an archive: what is known of it before its rows are read."""

    def __init__(self, content: bytes | Callable[[], BinaryIO], stem: str, candidates: Sequence[str], fallback: str):
        self.status, self.name, self.charset, self.problem = "missing", None, None, None
        try:
            self.archive = zipfile.ZipFile(content() if callable(content) else io.BytesIO(content))
            self.name = _find_member(self.archive, stem)
            if self.name is None:
                return
            self.size = self.archive.getinfo(self.name).file_size
            if self.size == 0:
                self.status = "empty"
                return
            self.charset, self.strict = resolve_charset(lambda: self.archive.open(self.name), candidates, fallback)
            self.status = "ok"
        except _UNREADABLE as problem:
            self._fail(problem)

    def _fail(self, problem: Exception) -> None:
        self.status, self.problem = "unreadable", f"{type(problem).__name__}: {problem}"

    def _parse(self) -> Iterator[pd.DataFrame]:
        """All cells are text as written; only an empty cell is null. A line with more cells than the header
        is an error, one with fewer ends in nulls."""
        options = dict(
            encoding=self.charset, encoding_errors="strict" if self.strict else "replace",
            dtype=str, index_col=False, header=None, keep_default_na=False, na_values=[""],
        )
        with self.archive.open(self.name) as stream:
            header = [None if pd.isna(c) else c for c in pd.read_csv(stream, nrows=1, **options).iloc[0]]
        while header and header[-1] is None:
            header.pop()
        # One column more than the header has shows a line with more cells.
        with self.archive.open(self.name) as stream:
            done = -1  # the header is the first row
            for frame in pd.read_csv(stream, names=range(len(header) + 1), chunksize=CHUNK_ROWS, **options):
                frame.index = range(done, done + len(frame))
                done += len(frame)
                frame = frame.loc[0:]
                surplus = frame[len(header)].notna()
                if surplus.any():
                    raise ValueError(f"record {surplus.idxmax()} has more cells than the header")
                own = frame.iloc[:, : len(header)]
                own.columns = header
                yield own.loc[:, ~own.columns.duplicated(keep="last")]

    def frames(self) -> Iterator[pd.DataFrame]:
        """The rows in chunks. A member broken in the middle gives none: a small one is parsed to its end
        before the first row leaves, a large one is read through first."""
        if self.status != "ok":
            return
        try:
            if self.size <= _HELD_BYTES:
                parsed = list(self._parse())
            else:
                for _ in self._parse():
                    pass
                parsed = self._parse()
        except _UNREADABLE as problem:
            self._fail(problem)
            return
        yield from parsed


def archive_members(
    files: DataFrame,
    stems: Sequence[str],
    candidates: Sequence[str] = CHARSETS,
    fallback: str = FALLBACK_CHARSET,
) -> DataFrame:
    """What each archive holds: ``(archive, stem, member, status, charset, n_rows, problem)`` with status
    ``ok``, ``missing``, ``empty`` or ``unreadable``."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["archive", "stem", "member", "status", "charset", "n_rows", "problem"]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                found = []
                for stem in stems:
                    m = _Member(content, stem, candidates, fallback)
                    n_rows = sum(len(frame) for frame in m.frames())
                    found.append((path, stem, m.name, m.status, m.charset, n_rows, m.problem))
                yield _plain(pd.DataFrame(found, columns=names))

    return files.select("path", "content").mapInPandas(
        look,
        "archive string, stem string, member string, status string, charset string, n_rows bigint, problem string",
    )


def archive_csv(
    files: DataFrame,
    stem: str,
    columns: Sequence[str],
    candidates: Sequence[str] = CHARSETS,
    fallback: str = FALLBACK_CHARSET,
) -> DataFrame:
    """Rows of member ``<stem>.csv`` (any case) of every archive: ``(archive, record_no, *columns)``, all text.

    Columns are looked up by header name; one a member does not have is null. A missing, empty or
    unreadable member gives no rows, and :func:`archive_members` tells which.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                for frame in _Member(content, stem, candidates, fallback).frames():
                    out = _plain(frame.reindex(columns=list(columns)))
                    out.insert(0, "archive", path)
                    out.insert(1, "record_no", frame.index)
                    yield out

    fields = ", ".join(f"`{c}` string" for c in columns)
    return files.select("path", "content").mapInPandas(read, f"archive string, record_no bigint, {fields}")


# --- all members in one pass ----------------------------------------------------------------------

_FOUND = pa.schema([
    ("archive", pa.string()), ("stem", pa.string()), ("member", pa.string()), ("status", pa.string()), ("charset", pa.string()),
    ("problem", pa.string()), ("n_rows", pa.int64()), ("record_no", pa.int64()), ("cells", pa.list_(pa.string())),
])
_FOUND_DDL = "archive string, stem string, member string, status string, charset string, problem string, n_rows bigint, record_no bigint, cells array<string>"
_ACCOUNT = ["archive", "stem", "member", "status", "charset", "n_rows", "problem"]


class Frames(dict):
    """Tables by name, with the ``account`` of the inputs they were read from: a row per input with its ``status``."""

    def __init__(self, frames: Mapping[str, DataFrame], account: DataFrame | None):
        super().__init__(frames)
        self.account = account


def _member_rows(
    archive: str, content: bytes | Callable[[], BinaryIO], stem: str, columns: Sequence[str], candidates: Sequence[str], fallback: str
) -> Iterator[pa.RecordBatch]:
    """The rows of a member, and one of its account, which has no record_no."""
    member, n_rows = _Member(content, stem, candidates, fallback), 0
    for frame in member.frames():
        n_rows += len(frame)
        cells = _plain(frame.reindex(columns=list(columns))).to_numpy().tolist()
        rows = {"archive": [archive] * len(frame), "stem": [stem] * len(frame), "record_no": [int(i) for i in frame.index], "cells": cells}
        yield pa.RecordBatch.from_arrays([pa.array(rows.get(f.name, [None] * len(frame)), f.type) for f in _FOUND], schema=_FOUND)
    account = {"archive": archive, "stem": stem, "member": member.name, "status": member.status, "charset": member.charset, "problem": member.problem, "n_rows": n_rows}
    yield pa.RecordBatch.from_pylist([account], schema=_FOUND)


@dataclass
class _Members(InputPartition):
    """Members of one archive that one task reads."""

    path: str
    stems: tuple[str, ...]


@dataclass
class _Archives(InputPartition):
    """Small archives that one task reads whole, one after the other."""

    paths: tuple[str, ...]


class _ArchiveReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.path, self.glob = options["path"], options.get("glob", "*.zip")
        self.tables: dict[str, list[str]] = json.loads(options["tables"])
        self.candidates = json.loads(options.get("candidates", json.dumps(CHARSETS)))
        self.fallback = options.get("fallback", FALLBACK_CHARSET)
        self.tasks = int(options.get("tasks", _TASKS))

    def _files(self) -> list[tuple[str, int]]:
        """Paths and sizes."""
        system, name = file_system(self.path)
        own = system.get_file_info(name)
        if own.type == pafs.FileType.File:
            return [(self.path, own.size or 0)]
        found = system.get_file_info(pafs.FileSelector(name))
        names = sorted((f.base_name, f.size or 0) for f in found if f.type == pafs.FileType.File and fnmatch.fnmatch(f.base_name, self.glob))
        return [(f"{self.path.rstrip('/')}/{n}", size) for n, size in names]

    @staticmethod
    def _open(path: str) -> BinaryIO:
        system, name = file_system(path)
        return system.open_input_file(name)

    def _plan(self, path: str) -> list[_Members]:
        """A partition per member that holds data; one for all that is missing, empty or unreadable."""
        try:
            with zipfile.ZipFile(self._open(path)) as archive:
                names = {stem: _find_member(archive, stem) for stem in self.tables}
                full = [s for s, n in names.items() if n is not None and archive.getinfo(n).file_size]
        except _UNREADABLE:
            full = []
        rest = tuple(s for s in self.tables if s not in full)
        return [_Members(path, (s,)) for s in full] + ([_Members(path, rest)] if rest else [])

    def partitions(self) -> Sequence[InputPartition]:
        """A few archives are dealt out by member. Of many, those that are small beside a task's share of the bytes are
        put together until they make one up, so tasks grow in size and not in number; they are not opened here."""
        found = self._files()
        share = min(_TASK_BYTES, sum(size for _, size in found) // self.tasks) if len(found) > self.tasks else 0
        packs, held = [], 0
        for path, size in found:
            if size < share:
                if not packs or held + size > share:
                    packs.append([])
                    held = 0
                packs[-1].append(path)
                held += size
        # Only central directories are read here, many at a time.
        with ThreadPoolExecutor(max_workers=32) as pool:
            planned = [p for own in pool.map(self._plan, [path for path, size in found if size >= share]) for p in own]
        return [*planned, *(_Archives(tuple(p)) for p in packs)] or [_Members("", ())]

    def read(self, partition: _Members | _Archives) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, _Members):
            yield from self._rows(partition.path, lambda: self._open(partition.path), partition.stems)
            return
        for path in partition.paths:
            # A small archive is fetched once, not once for each look at each member.
            try:
                with self._open(path) as file:
                    content = file.read()
            except OSError:
                yield from self._rows(path, lambda: self._open(path), tuple(self.tables))
                continue
            yield from self._rows(path, content, tuple(self.tables))

    def _rows(self, path: str, content: bytes | Callable[[], BinaryIO], stems: Sequence[str]) -> Iterator[pa.RecordBatch]:
        for stem in stems:
            yield from _member_rows(path, content, stem, self.tables[stem], self.candidates, self.fallback)


class ArchiveSource(DataSource):
    """``spark.read.format("archive_csv")``: CSV members of zip archives. Options: ``path``, ``glob``, ``tables`` (JSON: columns
    by member name without ``.csv``), ``candidates`` (JSON: charsets), ``fallback``, ``tasks`` (more archives than that are put
    together to about as many). A row per record, and one per member
    without a ``record_no``, which tells what became of it."""

    @classmethod
    def name(cls) -> str:
        return "archive_csv"

    def schema(self) -> str:
        return _FOUND_DDL

    def reader(self, schema) -> DataSourceReader:
        return _ArchiveReader(self.options)


def _kept(found: DataFrame, tables: Mapping[str, Sequence[str]]) -> Frames:
    """What a pass found, kept in the shared folder by member, so that the pass is made once."""
    spark = found.sparkSession
    folder = f"{shared_folder(spark)}/regtables/archives-{uuid.uuid4().hex}"
    found.write.partitionBy("stem").option("compression", "zstd").parquet(folder)
    kept = spark.read.schema(found.schema).parquet(folder)

    def table(stem: str) -> DataFrame:
        rows = kept.where((F.col("stem") == stem) & F.col("record_no").isNotNull())
        return rows.select("archive", "record_no", *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(tables[stem])])

    return Frames({stem: table(stem) for stem in tables}, kept.where("record_no IS NULL").select(*_ACCOUNT))


def archive_tables(
    spark: SparkSession, path: str, tables: Mapping[str, Sequence[str]], glob: str = "*.zip",
    candidates: Sequence[str] = CHARSETS, fallback: str = FALLBACK_CHARSET,
) -> Frames:
    """For each member name the rows of ``<name>.csv`` (any case) of all archives under the path, as
    :func:`archive_csv` gives them, and their account."""
    spark.dataSource.register(ArchiveSource)
    options = {"glob": glob, "tables": json.dumps({s: list(c) for s, c in tables.items()}), "candidates": json.dumps(list(candidates)), "fallback": fallback, "tasks": str(max(_TASKS, 4 * spark.sparkContext.defaultParallelism))}
    return _kept(spark.read.format("archive_csv").options(**options).load(path), tables)


def archive_frames(
    files: DataFrame, tables: Mapping[str, Sequence[str]], candidates: Sequence[str] = CHARSETS, fallback: str = FALLBACK_CHARSET
) -> Frames:
    """As :func:`archive_tables`, for archives that are rows ``(path, content)``."""
    columns = {s: list(c) for s, c in tables.items()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                data = content.as_py()
                for stem, names in columns.items():
                    yield from _member_rows(path, data, stem, names, candidates, fallback)

    return _kept(files.select("path", "content").mapInArrow(read, _FOUND_DDL), tables)
