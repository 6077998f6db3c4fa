"""Packing token sequences by length patterns.

What is packed are pieces: a document's ids, or where they are longer than a sequence, stretches of a full
sequence, the first of which may be shorter. All decisions are made on the histogram of piece lengths, which
has as many entries as a sequence has places, however many documents there are:

1. patterns of up to four lengths that fill a sequence are enumerated, for each longest length at most some PARTNERS
   of three and four lengths,
2. repeat counts x >= 0 are fitted to the histogram by least squares, and rounded; what rounding leaves is fitted once
   more by other patterns,
3. the lengths left over are packed best fit, longest first, also by counts.

Pieces get a rank among those of their length from counts per (task, length), and the rank gives sequence and
offset, so no length, however common, is gathered in one place.

A null text counts as empty: its document is the end id alone. Null and repeated doc_ids are packed like
others, row by row; other columns are ignored, whatever their names; an empty table gives no rows. A long text is
encoded by one task and gives many pieces."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from regtables.llm.common import slices, texts_of, work_folder, written
from regtables.llm.tokens import BYTE_BPE, encoder

CAPACITY = 2048
PARTNERS = 24  # how many patterns of three and of four each longest length gets
ROUNDS = 150
LEAST = (0.5, 0.1)  # from which fitted count on a pattern is taken, in the first and the second fit
_RANKS = 48  # bits of a rank beside a length

_PIECE = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("place", pa.int64()), ("ids", pa.binary())]
)
_PIECE_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, place bigint, ids binary"
_PLACED = pa.schema([(n, t) for n, t in zip(_PIECE.names[:5], _PIECE.types[:5], strict=True)] + [("sequence_id", pa.int64()), ("offset", pa.int64())])
_PLACED_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


def _pieces(tokenizer: str, end_id: int, capacity: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(tokenizer).encode(texts_of(batch)), strict=True):
                ids += end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or min(n, capacity), n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    own = ids[4 * a : 4 * b]
                    rows.append((doc_id, k, a, b - a, zlib.crc32(own), task, int(seen[b - a]), own if with_ids else None))
                    seen[b - a] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECE, strict=True)], schema=_PIECE)

    return run


def patterns(left: np.ndarray, capacity: int, turn: int = 0) -> np.ndarray:
    """Rows of up to four lengths, 0 for none, that fill a sequence exactly, of lengths that ``left``, a histogram, has.
    Each longest length gets all its pairs, and partners at even distances for three and four; ``turn`` shifts these."""
    lengths = np.flatnonzero(left)
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True

    def some(low: int, high: int, n: int) -> list[int]:
        """Of the lengths from ``low`` to ``high`` up to ``n`` at even distances."""
        found = lengths[np.searchsorted(lengths, low) : np.searchsorted(lengths, high, "right")]
        at = (np.arange(n) * len(found) // n + turn * (len(found) // (4 * n) + 1)) % max(1, len(found))
        return found[np.unique(at)].tolist() if len(found) else []

    found = set()
    for a in lengths[::-1].tolist():
        rest = capacity - a
        if 0 < rest <= a and there[rest]:
            found.add((a, rest, 0, 0))
        for b in some(-(-rest // 3), min(a, rest), PARTNERS):
            last = rest - b
            if 0 < last <= b and there[last]:
                found.add((a, b, last, 0))
            for c in some(-(-last // 2), min(b, last), 3):
                if 0 < last - c <= c and there[last - c]:
                    found.add((a, b, c, last - c))
    return np.array(sorted(found, reverse=True), np.int64).reshape(-1, 4)


def fit(rows: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative least squares for repeat counts, by accelerated projected gradients: x >= 0 with small
    |A x - h|, where A has how often each pattern uses each length."""
    used = rows > 0
    weight = used.astype(float)
    h = histogram.astype(float)

    def forward(x):
        return np.bincount(rows.ravel(), (weight * x[:, None]).ravel(), len(h))

    def back(r):
        return (r[rows] * weight).sum(axis=1)

    v = np.ones(len(rows))
    for _ in range(30):
        v = back(forward(v))
        bound = np.linalg.norm(v)
        v /= bound
    step = 1 / (1.05 * bound)
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        following = np.maximum(0, y - step * back(forward(y) - h))
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = following + (t - 1) / s * (following - x)
        x, t = following, s
    return x


def rounded(rows: np.ndarray, x: np.ndarray, left: np.ndarray, least: float) -> tuple[list[tuple[tuple, int]], np.ndarray]:
    """Whole repeat counts, the largest first: x rounded down, but one for an x of ``least``; none beyond what is
    there. And the histogram of the rest."""
    left, plan = left.copy(), []
    for k in np.argsort(-x, kind="stable").tolist():
        if x[k] < least:
            break
        lengths, times = np.unique(rows[k][rows[k] > 0], return_counts=True)
        n = int(min(max(1, int(x[k])), (left[lengths] // times).min()))
        if n:
            left[lengths] -= n * times
            plan.append((tuple(zip(lengths.tolist(), times.tolist(), strict=True))[::-1], n))
    return plan, left


def best_fit(histogram: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Best fit by falling length, on counts: sequences of the same content are one entry with a number."""
    open_: dict[int, list] = {}
    for length in range(capacity, 0, -1):
        n = int(histogram[length])
        while n:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                each = capacity // length
                full, more = divmod(n, each)
                for times, k in ((each, full), (more, 1)):
                    if times and k:
                        open_.setdefault(capacity - times * length, []).append((((length, times),), k))
                break
            content, k = open_[room].pop()
            each = room // length
            taken = min(k, n // each)
            times = each
            if not taken:
                taken, times = 1, n
            if k > taken:
                open_[room].append((content, k - taken))
            if not open_[room]:
                del open_[room]
            open_.setdefault(room - times * length, []).append(((*content, (length, times)), taken))
            n -= taken * times
    return [entry for entries in open_.values() for entry in entries]


def fitted_plan(histogram: np.ndarray, capacity: int) -> tuple[list[tuple[tuple, int]], np.ndarray]:
    """Sequences by patterns, and the histogram of the rest. A second fit, over other patterns, is to what the first
    one's rounding left; as its counts are small, they are rounded up from LEAST on."""
    plan, left = [], histogram.copy()
    for turn, least in enumerate(LEAST):
        rows = patterns(left, capacity, turn)
        if len(rows):
            more, left = rounded(rows, fit(rows, left), left, least)
            plan += more
    return plan, left


def plan_for(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """(content, number of sequences) entries that use up the histogram; content has (length, times)."""
    whole = int(histogram[capacity])
    rest = histogram.copy()
    rest[capacity] = 0
    plan = [(((capacity, 1),), whole)] if whole else []
    fitted, left = fitted_plan(rest, capacity)
    return plan + fitted + best_fit(left, capacity)


def _slots(plan: list[tuple[tuple, int]]) -> dict[str, np.ndarray]:
    """By (length, rank): which sequences take those pieces, from which offset on, how many each."""
    rows, taken, sequence = [], {}, 0
    for content, n in plan:
        offset = 0
        for length, times in content:
            rank = taken.get(length, 0)
            rows.append((length << _RANKS | rank, sequence, offset, times))
            taken[length] = rank + n * times
            offset += length * times
        sequence += n
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    return dict(zip(("first", "sequence", "offset", "times"), columns, strict=True))


def _placed(slots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = slots.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(s["first"], length << _RANKS | rank, "right") - 1
            step = rank - (s["first"][at] & ((1 << _RANKS) - 1))
            sequence = s["sequence"][at] + step // s["times"][at]
            offset = s["offset"][at] + step % s["times"][at] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _PLACED.names[:5]), pa.array(sequence), pa.array(offset)], schema=_PLACED)

    return run


def _pieces_of(docs: DataFrame, folder: str, tokenizer: str, end_id: int, capacity: int, with_ids: bool) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    return written(rows.mapInArrow(_pieces(tokenizer, end_id, capacity, with_ids), _PIECE_DDL), f"{folder}/pieces", compression="zstd")


def _place(pieces: DataFrame, capacity: int) -> DataFrame:
    spark = pieces.sparkSession
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    # One row per task and length; a length has no more rows here than there were tasks.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
        histogram[r.length] = r.n
    slots = spark.sparkContext.broadcast(_slots(plan_for(histogram, capacity)))
    ranked = pieces.drop("ids").join(offsets, ["task", "length"]).withColumn("rank", F.col("first") + F.col("place"))
    return ranked.select(*_PLACED.names[:5], "rank").mapInArrow(_placed(slots), _PLACED_DDL)


def packed(docs: DataFrame, tokenizer: str = BYTE_BPE, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    folder = work_folder(docs.sparkSession, "packing")
    return _place(_pieces_of(docs, folder, tokenizer, end_id, capacity, with_ids=False), capacity)


def sequences(docs: DataFrame, tokenizer: str = BYTE_BPE, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """The sequences themselves: sequence_id, length, ids (little-endian unsigned 32-bit), doc_ids. A row gathers
    ``capacity`` ids at most."""
    folder = work_folder(docs.sparkSession, "packing")
    pieces = _pieces_of(docs, folder, tokenizer, end_id, capacity, with_ids=True)
    # Rows that are the same piece of the same text may stand in for each other.
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    nth = Window.partitionBy(*key).orderBy(F.lit(0))
    left = _place(pieces, capacity).withColumn("nth", F.row_number().over(nth))
    right = pieces.select(*key, "ids").withColumn("nth", F.row_number().over(nth))
    right = right.select("ids", *(F.col(c).alias(f"own_{c}") for c in [*key, "nth"]))
    same = [F.col(c).eqNullSafe(F.col(f"own_{c}")) for c in [*key, "nth"]]
    rows = left.join(right, same).select("sequence_id", "offset", "length", "doc_id", "ids")
    gathered = rows.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))
    ids = F.aggregate("parts", F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    return gathered.select("sequence_id", "length", ids.alias("ids"), F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"))
