"""Importance resampling towards a target distribution, with each distinct line's features counted once.

Features are the runs of 1 to ``n`` consecutive words, hashed into buckets (crc32 of their UTF-8 bytes). Newlines
cut a text into segments, and a segment is known by its words in lower case (A-Z only) with one space between
them. Features of a distinct segment are counted once and kept in a table; bucket totals are those counts times the
segment's occurrences, and a document's weight is the sum of its segments' weights times theirs. Runs that
cross a newline belong to no segment: they are counted per document and added (there are none for ``n`` = 1).

With s, S the corpus's counts in a bucket and over all, and t, T those of the target, a bucket's gain is
floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))). A document's score is its weight plus Gumbel noise
made from its id, so the highest scores are a draw without replacement in proportion to exp(weight / 1000).

Null texts, empty ones and those without a word have no features and the weight 0. A null doc_id makes noise as
an empty one. Rows that repeat are scored and ranked one by one; ties go to the smaller doc_id, null first.
Other columns are ignored, whatever their names. An empty table gives no rows; an empty target counts nothing.
Long texts are lines like any other; one without a newline is one segment, held by the task that counts it.

Segments are joined to documents by 128 bits of SHA-256. Occurrences of the same segment are combined before the
shuffle. At most HEAVY segments can make up 1/HEAVY of all occurrences each; those are broadcast (16 bytes and
three numbers each), so no key of the shuffled join holds more than that share."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from regtables.llm.common import ranked, slices, work_folder, written

BUCKETS = 10_000
MAX_BUCKETS = 1 << 20  # bounds the gains, which go to every task
KEPT_WORDS = 500_000  # buckets of words that a worker remembers
HEAVY = 50_000
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"

# A-Z become lower case; bytes that are in no word become spaces, but for the newline.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 or c == 10 else 32 for c in range(256))

_SEGMENTS = "segment binary, n bigint, n_rows bigint"
_FEATURES = "segment_key binary, n bigint, n_rows bigint, n_words bigint, n_features bigint, places array<int>, counts array<int>"
_PARTS = "doc_id bigint, text_key binary, segment_key binary, n bigint, crossing array<int>"
_SUMS = "bucket int, n bigint"


def key_of(data: bytes) -> bytes:
    return sha256(data).digest()[:16]


def segments_of(data: bytes) -> list[bytes]:
    """The lines of a text that have words, each as its words with one space between them."""
    found = (b" ".join(line.split()) for line in data.translate(_FOLD).split(b"\n"))
    return [s for s in found if s]


def runs_of(segment: bytes, n: int) -> list[bytes]:
    """All runs of 1 to ``n`` words."""
    words = segment.split(b" ")
    if n == 1:
        return words
    return [b" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def crossing_runs(segments: list[bytes], n: int) -> Iterator[bytes]:
    """The runs that begin in one segment and end in a later one."""
    before: list[bytes] = []
    for segment in segments if n > 1 else ():
        words = segment.split(b" ")
        near = before + words[: n - 1]
        for i in range(len(before)):
            for end in range(len(before) + 1, min(i + n, len(near)) + 1):
                yield b" ".join(near[i:end])
        before = (before + words)[-(n - 1) :]


class _Buckets(dict):
    """Buckets of runs, made on first use; forgotten when there are too many."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, run: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[run] = found = crc32(run) % self.buckets
        return found


def _bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in batch.column(column)]


def _arrays(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        n, n_rows = Counter(), Counter()
        for data in _bytes(batch):
            own = Counter(segments_of(data))
            n.update(own)
            n_rows.update(own.keys())
        yield _arrays([(s, k, n_rows[s]) for s, k in n.items()], _SEGMENTS)


def _features(n: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = _Buckets(buckets)
        for batch in slices(batches, "segment"):
            rows = []
            for segment, times, n_rows in zip(_bytes(batch, "segment"), batch.column("n").to_pylist(), batch.column("n_rows").to_pylist(), strict=True):
                runs = runs_of(segment, n)
                counts = Counter(map(bucket.__getitem__, runs))
                rows.append((key_of(segment), times, n_rows, segment.count(b" ") + 1, len(runs), list(counts), list(counts.values())))
            yield _arrays(rows, _FEATURES)

    return run


def _parts(n: int, buckets: int):
    """For each document a row for itself, with the runs that cross its newlines, and one for each distinct segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = _Buckets(buckets)
        for batch in slices(batches):
            rows = []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), _bytes(batch), strict=True):
                found, text_key = segments_of(data), key_of(data)
                rows.append((doc_id, text_key, None, 1, [bucket[r] for r in crossing_runs(found, n)]))
                rows += [(doc_id, text_key, key_of(s), k, None) for s, k in Counter(found).items()]
            yield _arrays(rows, _PARTS)

    return run


def _sums(buckets: int, places: str, counts: str | None):
    """Bucket totals of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            lists = batch.column(places)
            own = np.ones(len(lists.flatten()), np.int64)
            if counts:
                lengths = np.diff(lists.offsets.to_numpy())
                own = batch.column(counts).flatten().to_numpy().astype(np.int64) * np.repeat(batch.column("n").to_numpy(), lengths)
            np.add.at(total, lists.flatten().to_numpy(), own)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    return run


def _list_sums(lists: pa.ListArray, values: np.ndarray) -> np.ndarray:
    ends = np.concatenate([[0], np.cumsum(values)])
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return ends[offsets[1:]] - ends[offsets[:-1]]


def _segment_weights(gains):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, counts = batch.column("places"), batch.column("counts").flatten().to_numpy()
            weight = _list_sums(places, gains.value[places.flatten().to_numpy()] * counts)
            kept = [batch.column(c) for c in ("segment_key", "n_rows", "n_words", "n_features")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(weight)], names=["segment_key", "n_rows", "n_words", "n_features", "weight"])

    return run


def _own_weights(gains):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crossing = batch.column("crossing")
            weight = _list_sums(crossing, gains.value[crossing.flatten().to_numpy()])
            n = np.diff(crossing.offsets.to_numpy()).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(n), pa.array(weight)], names=["doc_id", "text_key", "n_features", "weight"])

    return run


def _counted(docs: DataFrame, folder: str, n: int, buckets: int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """The features of distinct segments, the parts of documents, and the corpus's count per bucket."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    distinct = rows.select("text").mapInArrow(_segments, _SEGMENTS).groupBy("segment").agg(F.sum("n").alias("n"), F.sum("n_rows").alias("n_rows"))
    features = written(distinct.mapInArrow(_features(n, buckets), _FEATURES), f"{folder}/features", compression="zstd")
    parts = written(rows.mapInArrow(_parts(n, buckets), _PARTS), f"{folder}/parts", compression="zstd")
    sums = features.select("n", "places", "counts").mapInArrow(_sums(buckets, "places", "counts"), _SUMS)
    if n > 1:
        crossing = parts.where("crossing is not null").select("crossing")
        sums = sums.unionAll(crossing.mapInArrow(_sums(buckets, "crossing", None), _SUMS))
    total = np.zeros(buckets, np.int64)
    for r in sums.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():  # a row per bucket
        total[r.bucket] = r.n
    return features, parts, total


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature in each bucket adds to a weight."""
    b, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    gain = lambda s, t: math.floor(1000 * math.log((t + 1) * float(s_all + b) / ((s + 1) * float(t_all + b))))
    return np.array([gain(float(s), float(t)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weights(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, copy (0, 1, ... among equal rows), n_words, n_features, weight.
    ``target`` has a text column."""
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be 1 to {MAX_BUCKETS}")
    spark = docs.sparkSession
    folder = work_folder(spark, "resampling")
    features, parts, corpus = _counted(docs, f"{folder}/corpus", n, buckets)
    like = target.select(F.lit(None).cast("bigint").alias("doc_id"), "text")
    gains = spark.sparkContext.broadcast(gains_of(corpus, _counted(like, f"{folder}/target", n, buckets)[2]))

    kinds = "segment_key binary, n_rows bigint, n_words bigint, n_features bigint, weight bigint"
    known = features.mapInArrow(_segment_weights(gains), kinds)
    n_rows = features.agg(F.sum("n_rows").alias("n")).first().n or 0
    is_heavy = F.col("n_rows") * HEAVY >= F.lit(n_rows)
    told = ["segment_key", "n_words", "n_features", "weight"]
    # Sum of n_rows is n_rows, so at most HEAVY segments are heavy.
    heavy = F.broadcast(known.where(is_heavy).select(*told))
    found = parts.where("segment_key is not null").drop("crossing").join(heavy, "segment_key", "left")
    light = found.where("weight is null").select("doc_id", "text_key", "n", "segment_key").join(known.where(~is_heavy).select(*told), "segment_key")

    times = lambda d: d.select("doc_id", "text_key", F.lit(0).cast("bigint").alias("copies"), *((F.col("n") * F.col(c)).alias(c) for c in told[1:]))
    own = parts.where("segment_key is null").select("doc_id", "text_key", "crossing").mapInArrow(_own_weights(gains), "doc_id bigint, text_key binary, n_features bigint, weight bigint")
    own = own.select("doc_id", "text_key", F.lit(1).cast("bigint").alias("copies"), F.lit(0).cast("bigint").alias("n_words"), "n_features", "weight")
    sums = own.unionAll(times(found.where("weight is not null"))).unionAll(times(light))
    sums = sums.groupBy("doc_id", "text_key").agg(*(F.sum(c).alias(c) for c in ("copies", "n_words", "n_features", "weight")))
    # Equal rows were summed up together, each with the same share.
    one = lambda c: F.expr(f"{c} div copies").alias(c)
    return sums.select("doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy"), one("n_words"), one("n_features"), one("weight"))


def resampled(
    docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight, score, rank.

    Of the rows with at least ``least_words`` words, ``percent`` in a hundred (rounded down) are drawn, those with
    the highest scores; ``rank`` numbers them from 1 and is null for the others."""
    spark = docs.sparkSession
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    folder = work_folder(spark, "drawn")
    scored = weights(docs, target, n, buckets).withColumn("score", (F.col("weight") + gumbel).cast("bigint"))
    scored = scored.withColumn("short", F.col("n_words") < least_words)
    placed, n_rows = ranked(scored, [F.col("short"), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("copy")], folder)
    n_long = placed.where("not short").count() if n_rows else 0
    rank = F.when(F.col("place") < percent * n_long // 100, F.col("place") + 1)
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))
