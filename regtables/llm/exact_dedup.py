"""Exact copies of whole texts, by an extendible-hash index on shared files.

Keys are 64-bit hashes of the text with A-Z lower-cased. A directory maps the leading bits of a key to a
bucket; an overfull bucket is split by its next bit, and where it already used all bits of the directory,
the directory doubles. Buckets are dealt to owners as ranges of keys that follow each other. An owner reads
its entries in key order, chains texts whose keys collide, compares them byte by byte, and writes index files:

- ``entries``: bucket, key, chain, keep_id, n_rows, sha256, text: one row per distinct text
- ``members``: doc_id, key, sha256: which rows have that text

Copies within a slice of a task are counted before they are dealt out, and a text that the task sent lately goes as its
hash alone. So a text that makes up a third of all rows reaches its owner about once per task, its rows never
do, and an owner holds the distinct texts of a single key only.

A null text counts as empty, and empty texts are copies of each other. Of copies the largest doc_id stays; a
null doc_id is the smallest, and where a doc_id repeats within a group all its rows count as kept. Other
columns are ignored, whatever their names; an empty table gives no rows. A long text is an entry like others, held
by one task at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from regtables.llm.common import SLICE_BYTES, ascii_lower, partitions, slices, work_folder, written

BUCKET_KEYS = 1024
ROUND_BITS = 11  # a round of counting tells apart this many more bits of the overfull buckets' keys
MAX_DEPTH = 22  # bounds the directory, which goes to every task; deeper buckets only get longer
KEY_BITS = 64

SENT_BYTES = 16 << 20  # texts a task remembers as sent

_ENTRY = pa.schema([("owner", pa.int32()), ("bucket", pa.int32()), ("key", pa.int64()), ("sha256", pa.binary()), ("text", pa.binary()), ("keep_id", pa.int64()), ("n_rows", pa.int64())])
_ENTRY_DDL = "owner int, bucket int, key bigint, sha256 binary, text binary, keep_id bigint, n_rows bigint"
_PAGE = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("chain", pa.int32()), ("keep_id", pa.int64()), ("n_rows", pa.int64()), ("sha256", pa.binary()), ("text", pa.binary())])
_PAGE_DDL = "bucket int, key bigint, chain int, keep_id bigint, n_rows bigint, sha256 binary, text binary"
_MEMBER_DDL = "doc_id bigint, key bigint, sha256 binary"


def hash_key(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text)


class Directory:
    """Buckets as (prefix, depth): the keys whose first ``depth`` bits are ``prefix``. ``slots`` has the
    bucket of each value of the first ``depth`` bits, ``depth`` being that of the deepest bucket."""

    def __init__(self):
        self.depth = 0
        self.slots = np.zeros(1, np.int32)
        self.buckets: list[tuple[int, int]] = [(0, 0)]
        self.keys: list[int] = [0]

    def split(self, bucket: int) -> int:
        """Splits a bucket by its next bit; gives the new bucket, which has the keys with that bit set."""
        prefix, depth = self.buckets[bucket]
        if depth == self.depth:
            self.slots = np.repeat(self.slots, 2)
            self.depth += 1
        new = len(self.buckets)
        self.buckets[bucket] = (prefix << 1, depth + 1)
        self.buckets.append((prefix << 1 | 1, depth + 1))
        self.keys.append(0)
        width = 1 << (self.depth - depth - 1)
        at = (prefix << 1 | 1) * width
        self.slots[at : at + width] = new
        return new

    def grow(self, bucket: int, counts: np.ndarray, limit: int) -> list[int]:
        """Splits ``bucket`` until no part has more than ``limit`` keys. counts: its keys by their next
        bits. Gives the parts that are still overfull when those bits are used up."""
        overfull, left = [], [(bucket, counts)]
        while left:
            b, own = left.pop()
            self.keys[b] = int(own.sum())
            if self.keys[b] <= limit:
                continue
            if len(own) == 1:
                overfull.append(b)
                continue
            half = len(own) // 2
            left += [(self.split(b), own[half:]), (b, own[:half])]
        return overfull

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Buckets of unsigned 64-bit keys."""
        if self.depth == 0:
            return np.zeros(len(keys), np.int32)
        return self.slots[(keys >> np.uint64(KEY_BITS - self.depth)).astype(np.int64)]

    def owners(self, n: int) -> np.ndarray:
        """An owner for each bucket: runs of buckets in key order with about as many keys each."""
        order = sorted(range(len(self.buckets)), key=lambda b: self.buckets[b][0] << (KEY_BITS - self.buckets[b][1]))
        own = np.array([self.keys[b] for b in order], np.float64)
        before = np.cumsum(own) - own / 2
        found = np.zeros(len(order), np.int32)
        found[order] = np.minimum(n - 1, before / max(own.sum(), 1.0) * n).astype(np.int32)
        return found


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
        # bytes.lower() changes A-Z only
        yield doc_id, text.as_buffer().to_pybytes().lower() if text.is_valid else b""


def _members(key_of):
    """Per row its key and the hash of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(doc_id, key_of(data), hashlib.sha256(data).digest()) for doc_id, data in _texts(batch)]
            keys = np.array([k for _, k, _ in rows], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys), pa.array([h for _, _, h in rows], pa.binary())], names=["doc_id", "key", "sha256"])

    return run


def build_directory(members: DataFrame, folder: str, bucket_keys: int = BUCKET_KEYS) -> Directory:
    """The directory for the keys of ``members``. Each round counts the distinct keys of the overfull buckets
    by their next bits. What is collected is counts by prefix, 2 ** MAX_DEPTH of them at most."""
    keys = written(members.select("key").distinct(), f"{folder}/keys")
    directory, todo = Directory(), [0]
    for base in range(0, MAX_DEPTH, ROUND_BITS):
        prefix = F.shiftrightunsigned("key", KEY_BITS - base - ROUND_BITS)
        counted = keys.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
        if base:
            known = [(directory.buckets[b][0],) for b in todo]
            deeper = keys.sparkSession.createDataFrame(known, "above bigint")
            counted = counted.join(F.broadcast(deeper), F.shiftrightunsigned("prefix", ROUND_BITS) == F.col("above"), "left_semi")
        found = counted.toPandas()
        prefixes, n = found["prefix"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
        following = []
        for b in todo:
            own = prefixes >> ROUND_BITS == directory.buckets[b][0]
            counts = np.zeros(1 << ROUND_BITS, np.int64)
            counts[prefixes[own] & ((1 << ROUND_BITS) - 1)] = n[own]
            following += directory.grow(b, counts, bucket_keys)
        todo = following
        if not todo:
            break
    return directory


def _entries(directory, key_of):
    """Texts for their owners, a row per text and slice. A text that the task sent lately goes as its hash only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, owners = directory.value
        sent: dict[bytes, tuple[int, bytes]] = {}  # by the text itself, so that equal means byte by byte
        held = 0
        for batch in slices(batches):
            found: dict[bytes, list] = {}
            for doc_id, data in _texts(batch):
                link = found.setdefault(data, [None, 0])
                link[0] = max((d for d in (link[0], doc_id) if d is not None), default=None)
                link[1] += 1
            is_new = [data not in sent for data in found]
            for data, new in zip(found, is_new, strict=True):
                if new:
                    if held > SENT_BYTES:
                        sent, held = {}, 0
                    sent[data] = key_of(data), hashlib.sha256(data).digest()
                    held += len(data) + 100
            named = [sent.get(data) or (key_of(data), hashlib.sha256(data).digest()) for data in found]
            keys = np.array([k for k, _ in named], np.uint64)
            buckets = known.lookup(keys)
            columns = [
                owners[buckets], buckets, keys.view(np.int64), [h for _, h in named], [t if n else None for t, n in zip(found, is_new, strict=True)],
                [keep for keep, _ in found.values()], [n for _, n in found.values()],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ENTRY, strict=True)], schema=_ENTRY)

    return run


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owner's work: entries in key order; the texts of one key are a chain. Of the entries of a text those that bring
    it come first."""
    here, chain, pages = None, [], []  # chain: [text, sha256, keep_id, n_rows]

    def entries():
        return [(*here, i, keep, n, sha, text) for i, (text, sha, keep, n) in enumerate(chain)]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PAGE, strict=True)], schema=_PAGE)

    for batch in batches:
        size = 0
        for bucket, key, sha, text, keep, n in zip(*(batch.column(c).to_pylist() for c in ("bucket", "key", "sha256", "text", "keep_id", "n_rows")), strict=True):
            if (bucket, key) != here:
                pages += entries()
                here, chain = (bucket, key), []
            is_same = (lambda link: link[1] == sha) if text is None else (lambda link: link[0] == text)
            link = next(filter(is_same, chain), None)
            if link is None:
                link = [text, sha, None, 0]
                chain.append(link)
            link[2] = max((d for d in (link[2], keep) if d is not None), default=None)
            link[3] += n
            size += len(text or b"")
            if size > SLICE_BYTES and pages:
                yield batch_of(pages)
                pages, size = [], 0
        if pages:
            yield batch_of(pages)
            pages = []
    pages = entries()
    if pages:
        yield batch_of(pages)


def write_index(docs: DataFrame, folder: str, key_of: Callable[[bytes], int] = hash_key, bucket_keys: int = BUCKET_KEYS) -> None:
    """Indexes the texts of ``docs`` (doc_id, text) in ``folder``: the tables ``entries`` and ``members``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    members = written(rows.mapInArrow(_members(key_of), _MEMBER_DDL), f"{folder}/members")
    directory = build_directory(members, folder, bucket_keys)
    n = partitions(spark)
    shared = spark.sparkContext.broadcast((directory, directory.owners(n)))  # MAX_DEPTH bounds it
    dealt = rows.mapInArrow(_entries(shared, key_of), _ENTRY_DDL).repartitionById(n, F.col("owner")).sortWithinPartitions("key", "sha256", F.col("text").isNull())
    dealt.mapInArrow(_resolve, _PAGE_DDL).write.parquet(f"{folder}/entries")


def exact_copies(docs: DataFrame, folder: str | None = None, **settings) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "exact")
    write_index(docs, folder, **settings)
    entries = spark.read.schema(_PAGE_DDL).parquet(f"{folder}/entries").select("key", "sha256", "keep_id", "n_rows")
    # A row of a text finds its entry by an inner join, of which AQE splits the side of a text with very many rows.
    found = spark.read.schema(_MEMBER_DDL).parquet(f"{folder}/members").join(entries, ["key", "sha256"])
    return found.select(
        "doc_id", "keep_id", F.col("n_rows").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha256")).alias("text_sha256")
    )


def without_copies(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one row of each group of copies, all columns kept. Of rows that repeat the doc_id and the text
    that stay, one does: the first by its text and its other columns as JSON."""
    kept = exact_copies(docs, **settings).where("kept").groupBy(F.col("doc_id").alias("__kept"), F.col("text_sha256").alias("__hash")).agg(F.count(F.lit(1)).alias("__rows"))
    kept = written(kept, work_folder(docs.sparkSession, "kept"))
    names = [f"__{i}" for i in range(len(docs.columns))]  # whatever the columns are called
    rows = docs.select(
        *(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)),
        F.col("doc_id").cast("bigint").alias("__id"), F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256).alias("__sha"),
    )
    same = lambda k: F.col("__id").eqNullSafe(F.col("__kept")) & (F.col("__sha") == F.col("__hash"))
    once = rows.join(kept.where("__rows = 1"), same(kept), "left_semi").select(*names)
    repeated = kept.where("__rows > 1")
    if not repeated.isEmpty():
        row = F.struct(*names)
        several = rows.join(repeated, same(repeated), "left_semi").groupBy("__id", "__sha").agg(F.min_by(row, F.to_json(row)).alias("r"))
        once = once.unionByName(several.select("r.*"))
    return once.toDF(*docs.columns)
