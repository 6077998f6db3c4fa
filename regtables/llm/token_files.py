"""Token ids as binary blocks coded by a static range asymmetric numeral system.

A folder of token files holds three tables:

- ``table``: id, count. The frequencies that all blocks share, counted over the whole corpus.
- ``shards``: shard, start, n_tokens. Shards follow each other in ascending doc_id.
- ``blocks``: shard, start (ids of the shard before it), n_tokens, doc_ids, doc_lengths, words, states,
  places, ids_crc32, data_crc32. A block holds whole documents, in order, and is decoded on its own;
  within it, decoding may start at any checkpoint (states, places).

A null text counts as empty, a null doc_id comes first, rows that repeat a doc_id keep a place each, other
columns are ignored. An empty table gives empty files. A block is cut after the document that fills it, so
only a very long document makes a longer one."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from regtables.llm import rans
from regtables.llm.common import partitions, slices, texts_of, work_folder, written
from regtables.llm.tokens import BYTE_BPE, encoder

BLOCK_TOKENS = 1 << 16
BLOCKS_AT_ONCE = 32
MAX_VOCABULARY = 1 << 20  # bounds the shared table, which goes to every task

_IDS = "doc_id bigint, shard int, start bigint, n_tokens bigint, ids binary, counts binary"
_BLOCKS = (
    "shard int, start bigint, n_tokens bigint, doc_ids array<bigint>, doc_lengths array<bigint>, "
    "words binary, states binary, places binary, ids_crc32 bigint, data_crc32 bigint"
)
_DOCS = "shard int, in_shard bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def _tokenize(tokenizer: str, end_id: int):
    """A row per document, and at a partition's end one with the counts of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, start = TaskContext.get().partitionId(), 0
        counts, width = np.zeros(0, np.int64), _width(encoder(tokenizer).size, end_id)
        for batch in slices(batches):
            ids, lengths = encoder(tokenizer).encode_all(texts_of(batch))
            ids, lengths = np.insert(ids.astype(f"<u{width}"), np.cumsum(lengths), end_id), lengths + 1
            ends = np.cumsum(lengths)
            counts = _added(counts, np.bincount(ids))
            offsets = pa.py_buffer(np.concatenate([[0], width * ends]).astype(np.int32))
            data = pa.Array.from_buffers(pa.binary(), len(ends), [None, offsets, pa.py_buffer(ids)])
            n = len(ends)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(n, shard, np.int32)), pa.array(start + ends - lengths), pa.array(lengths), data, pa.nulls(n, pa.binary())],
                schema=_arrow(_IDS),
            )
            start += int(ends[-1])
        used = np.flatnonzero(counts)
        found = np.stack([used, counts[used]]).astype("<i8").tobytes()
        yield pa.RecordBatch.from_pylist([{"shard": shard, "counts": found}], schema=_arrow(_IDS))

    return run


def _width(vocabulary: int, end_id: int) -> int:
    """Bytes of an id as kept between the passes."""
    return 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4


def _added(counts: np.ndarray, own: np.ndarray) -> np.ndarray:
    if len(own) > MAX_VOCABULARY:
        raise ValueError(f"an id of {len(own) - 1} is beyond the vocabulary bound")
    if len(own) > len(counts):
        counts = np.pad(counts, (0, len(own) - len(counts)))
    counts[: len(own)] += own
    return counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, np.int64)
    for batch in batches:
        for found in batch.column("counts"):
            used, own = np.frombuffer(found.as_buffer(), "<i8").reshape(2, -1)
            counts = _added(counts, np.bincount(used, own).astype(np.int64) if len(used) else used)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["id", "n"])


def _blocks_of(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, int, list, list, np.ndarray]]:
    """Rows of one shard that follow each other, gathered into blocks."""
    held: list[np.ndarray] = []
    docs: list = []
    lengths: list[int] = []
    shard = first = following = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "shard", "start", "n_tokens")]
        for doc_id, own, start, n, ids in zip(*columns, batch.column("ids"), strict=True):
            if held and (own != shard or start != following or following - first >= limit):
                yield shard, first, docs, lengths, np.concatenate(held)
                held, docs, lengths = [], [], []
            if not held:
                shard, first = own, start
            data = ids.as_buffer()
            held.append(np.frombuffer(data, f"<u{data.size // n}").astype(np.uint32))
            docs.append(doc_id)
            lengths.append(n)
            following = start + n
    if held:
        yield shard, first, docs, lengths, np.concatenate(held)


def _encode(table, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = rans.Table(table.value)

        def coded(blocks):
            rows = []
            for (shard, start, docs, lengths, ids), (words, states, places) in zip(blocks, rans.encode([b[4] for b in blocks], shared), strict=True):
                data = zlib.crc32(places, zlib.crc32(states, zlib.crc32(words)))
                rows.append((shard, start, len(ids), docs, lengths, words, states, places, zlib.crc32(ids.astype("<u4").tobytes()), data))
            schema = _arrow(_BLOCKS)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        held, size = [], 0
        for block in _blocks_of(batches, limit):
            held.append(block)
            size += len(block[4])
            if size >= limit * BLOCKS_AT_ONCE:
                yield coded(held)
                held, size = [], 0
        if held:
            yield coded(held)

    return run


def _checked(batches: Iterator[pa.RecordBatch], shared: rans.Table) -> Iterator[tuple[dict, np.ndarray]]:
    """Blocks with their ids, both checksums held."""
    for batch in batches:
        rows = batch.to_pylist()
        for i in range(0, len(rows), BLOCKS_AT_ONCE):
            part = rows[i : i + BLOCKS_AT_ONCE]
            for r in part:
                if zlib.crc32(r["places"], zlib.crc32(r["states"], zlib.crc32(r["words"]))) != r["data_crc32"]:
                    raise ValueError(f"shard {r['shard']}, block at {r['start']}: damaged data")
            found = rans.decode([(r["words"], r["states"], r["places"], r["n_tokens"]) for r in part], shared)
            for r, ids in zip(part, found, strict=True):
                if zlib.crc32(ids.astype("<u4").tobytes()) != r["ids_crc32"]:
                    raise ValueError(f"shard {r['shard']}, block at {r['start']}: wrong ids")
                yield r, ids


def _digest(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, ids in _checked(batches, rans.Table(table.value)):
            ends = np.cumsum(r["doc_lengths"])
            data, rows = ids.astype("<u4"), []
            for doc_id, n, end in zip(r["doc_ids"], r["doc_lengths"], ends, strict=True):
                rows.append((r["shard"], r["start"] + int(end) - n, doc_id, n, zlib.crc32(data[end - n : end].tobytes())))
            schema = _arrow(_DOCS)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _ids(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])
        for r, ids in _checked(batches, rans.Table(table.value)):
            ends = np.cumsum(r["doc_lengths"])
            parts = [ids[e - n : e].astype(np.int64) for n, e in zip(r["doc_lengths"], ends, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(r["doc_ids"], pa.int64()), pa.array(parts, schema.field("ids").type)], schema=schema)

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = BYTE_BPE, end_id: int = 2, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encodes the texts of ``docs`` (doc_id, text) into ``folder``, in ascending doc_id.

    Texts are dealt by ranges of doc_id (and of a hash of the text, which tells rows of one doc_id apart), a
    range to a shard. Their ids are kept as a table, so that an executor lost later costs its own part only; it
    holds the counts behind the shared frequencies too, and the blocks are made from it."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    found = written(dealt.mapInArrow(_tokenize(tokenizer, end_id), _IDS), f"{folder}/ids", compression="zstd")

    counts = found.where("counts is not null").select("counts").mapInArrow(_count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    counts = written(counts, f"{folder}/table")
    ids = found.where("counts is null").drop("counts")
    # A row per shard: the partitions of the job above, however large the corpus.
    per_shard = {r.shard: r.n for r in ids.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()}
    places, start = [], 0
    for shard in sorted(per_shard):
        places.append((shard, start, per_shard[shard]))
        start += per_shard[shard]
    spark.createDataFrame(places, "shard int, start bigint, n_tokens bigint").coalesce(1).write.parquet(f"{folder}/shards")

    table = spark.sparkContext.broadcast(_frequencies(counts))
    ids.mapInArrow(_encode(table, block_tokens), _BLOCKS).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def _frequencies(counts: DataFrame) -> np.ndarray:
    """The shared table; as many entries as the vocabulary has, which MAX_VOCABULARY bounds."""
    found = counts.toPandas()
    dense = np.zeros(int(found["id"].max()) + 1 if len(found) else 1, np.int64)
    dense[found["id"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return rans.Table.from_counts(dense).freq.astype(np.int64)


def _read(spark: SparkSession, folder: str):
    table = spark.sparkContext.broadcast(_frequencies(spark.read.parquet(f"{folder}/table")))
    return table, spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")


def read_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, ids: what the files hold."""
    table, blocks = _read(spark, folder)
    return blocks.mapInArrow(_ids(table), "doc_id bigint, ids array<bigint>")


def read_token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the decoded files: doc_id, start, n_tokens, ids_crc32."""
    table, blocks = _read(spark, folder)
    shards = spark.read.parquet(f"{folder}/shards").select("shard", F.col("start").alias("shard_start"))
    found = blocks.mapInArrow(_digest(table), _DOCS)
    # One row per shard, so no more than partitions of the writing job.
    return found.join(F.broadcast(shards), "shard").select("doc_id", (F.col("shard_start") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32")


def token_digests(docs: DataFrame, **settings) -> DataFrame:
    """Writes the files to the shared folder and reads them back."""
    folder = work_folder(docs.sparkSession, "tokens")
    write_token_files(docs, folder, **settings)
    return read_token_digests(docs.sparkSession, folder)
