"""Benchmark passages in training text, by suffix arrays over shards of the training words.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. A window is ``window`` consecutive words
of an item; a shorter item is one window. Tasks cut their documents into shards, sort all suffixes of a
shard's words, and look up every suffix of the benchmark by binary search, word by word, for its longest
verbatim match and the places of it. What comes out are runs, the longest stretches of a document in which windows of
one item overlap: item, where the first of these windows stands in the item first, first word in the document, number
of words.

The benchmark goes to the tasks in blocks of at most ``block_bytes``, one pass over the documents for
each block; with one block nothing is shuffled. A null text has no words, neither has a null item text; a
null item_id counts as ''. Rows that repeat are found one by one, other columns are ignored, whatever their names,
and either table may be empty. A text longer than a shard is a shard of its own; a word it repeats all over makes one
run per item, not one for each place."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from regtables.llm import words
from regtables.llm.common import slices

WINDOW_WORDS = 10
SHARD_BYTES = 4 << 20
PLACES_AT_ONCE = 2 << 20
BLOCK_BYTES = 16 << 20
WORD_CUTS = words.separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

_RUN = pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("n_words", pa.int64())])
_SCAN = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN))])
_SCAN_DDL = "doc_id bigint, text_key bigint, n_words bigint, runs array<struct<item_id string, item_word bigint, doc_word bigint, n_words bigint>>"


class SuffixArray:
    """All suffixes of a sequence of word ids in order. Ids are at least 1; 0 ends a document."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        n = len(ids)
        self.bits = max(1, int(ids.max(initial=1)).bit_length())
        self.packed_words = max(1, 63 // self.bits)
        self._padded = np.concatenate([ids, np.zeros(self.packed_words + 1, ids.dtype)]).astype(np.int64)
        packed = np.zeros(n, np.int64)
        for k in range(self.packed_words):
            packed = packed << self.bits | self._padded[k : k + n]
        self.order = np.argsort(packed, kind="stable")
        self.sorted_packed = packed[self.order]
        self._untie()

    def _untie(self) -> None:
        """Suffixes that tie on their first ``depth`` words are put in order by the rank of what follows."""
        n, depth = len(self.ids), self.packed_words
        if not n:
            return
        new = np.concatenate([[True], self.sorted_packed[1:] != self.sorted_packed[:-1]])
        while True:
            group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            size = np.diff(np.concatenate([np.flatnonzero(new), [n]]))
            tied = np.flatnonzero(np.repeat(size, size) > 1)
            if not len(tied) or depth >= n:
                return
            rank = np.empty(n + 1, np.int64)
            rank[self.order] = group
            rank[n] = -1
            after = rank[np.minimum(self.order[tied] + depth, n)]
            moved = np.lexsort((after, group[tied]))
            self.order[tied] = self.order[tied][moved]
            after, own = after[moved], group[tied]
            new[tied] = np.concatenate([[True], (after[1:] != after[:-1]) | (own[1:] != own[:-1])])
            depth *= 2

    def start(self, queries: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places [low, high) of the suffixes that begin with the first words of each query (rows of
        packed_words ids), and how many words that are."""
        k = np.minimum(lengths, self.packed_words)
        key = np.zeros(len(queries), np.int64)
        for j in range(self.packed_words):
            key = key << self.bits | np.where(j < k, queries[:, j], 0)
        span = np.int64(1) << (self.bits * (self.packed_words - k)).astype(np.int64)
        low = np.searchsorted(self.sorted_packed, key, "left")
        return low, np.searchsorted(self.sorted_packed, key + span - 1, "right"), k

    def extend(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The part of each [low, high) whose suffixes have ``word`` after ``depth`` words."""
        return self._bound(low, high, depth, word), self._bound(low, high, depth, word + 1)

    def _bound(self, low, high, depth, word):
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            at = np.minimum(self.order[np.minimum(mid, len(self.ids) - 1)] + depth, len(self.ids))
            less = self._padded[at] < word
            low = np.where(open_ & less, mid + 1, low)
            high = np.where(open_ & ~less, mid, high)
        return low


class Benchmark:
    """The words of a block of items, and where their windows start."""

    def __init__(self, rows: list[tuple[str, str]], window: int):
        self.window = window
        self.item_ids = [i or "" for i, _ in rows]
        self.hashes, counts = words.hashes([(t or "").encode() for _, t in rows], WORD_CUTS)
        ends = np.cumsum(counts)
        self.item = np.repeat(np.arange(len(rows)), counts)
        self.left = np.repeat(ends, counts) - np.arange(len(self.hashes))  # words up to the item's end
        self.word = np.arange(len(self.hashes)) - np.repeat(ends - counts, counts)
        # The words an occurrence must have: a window, or the whole of a shorter item.
        self.item_window = np.minimum(window, counts)
        self.needed = np.repeat(self.item_window, counts)
        self.starts = np.flatnonzero(self.left >= self.needed)

    def occurrences(self, array: SuffixArray, known: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Where windows of an item occur: item, first word of the window in the item, place in the shard. Of windows
        with the same words an item has the first. Items come whole, about PLACES_AT_ONCE places at a time. known: the
        words that the ids of the shard stand for, in order, id 1 first."""
        ids = np.searchsorted(known, self.hashes) + 1
        ids[(ids > len(known)) | (known[np.minimum(ids - 1, len(known) - 1)] != self.hashes)] = -1
        need = self.needed[self.starts]
        rows = np.full((len(self.starts), self.window), -2, np.int64)
        for j in range(self.window):
            rows[:, j] = np.where(j < need, ids[np.minimum(self.starts + j, len(ids) - 1)], -2)
        there = (rows != -1).all(axis=1)
        starts, rows = self.starts[there], rows[there]
        if not len(starts):
            return
        # Of windows with the same words one is looked up.
        rows, same = np.unique(rows, axis=0, return_inverse=True)
        same = same.ravel()
        lengths = (rows != -2).sum(axis=1)
        padded = np.zeros((len(rows), max(self.window, array.packed_words)), np.int64)
        padded[:, : self.window] = np.maximum(rows, 0)
        low, high, depth = array.start(padded, lengths)
        while len(going := np.flatnonzero((low < high) & (depth < lengths))):
            low[going], high[going] = array.extend(low[going], high[going], depth[going], padded[going, depth[going]])
            depth[going] += 1
        found = np.flatnonzero((high > low)[same])
        starts, same = starts[found], same[found]
        _, first = np.unique(self.item[starts] * len(rows) + same, return_index=True)
        first.sort()  # the order of the benchmark, so that an item's windows follow each other
        starts, same = starts[first], same[first]
        item, count = self.item[starts], (high - low)[same]
        ends = np.flatnonzero(np.concatenate([item[1:] != item[:-1], [True]])) + 1
        so_far, begin = np.cumsum(count), 0
        while begin < len(starts):
            spent = so_far[begin - 1] if begin else 0
            end = int(max(ends[ends > begin].min(), ends[so_far[ends - 1] <= spent + PLACES_AT_ONCE].max(initial=0)))
            own = slice(begin, end)
            n = count[own]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(item[own], n), np.repeat(self.word[starts[own]], n), array.order[np.repeat(low[same[own]], n) + step]
            begin = end


def _shard_runs(benchmark: Benchmark, hashes: np.ndarray, counts: np.ndarray) -> list[list[dict]]:
    """For each document of a shard its stretches that consist of windows of an item."""
    n_docs, found = len(counts), [[] for _ in counts]
    if not len(hashes) or not len(benchmark.starts):
        return found
    known, ids = np.unique(hashes, return_inverse=True)
    # A 0 after each document keeps matches inside it.
    gaps = np.cumsum(counts)
    sequence = np.insert(ids.ravel() + 1, gaps, 0).astype(np.int32)
    firsts = np.concatenate([[0], gaps[:-1]]) + np.arange(n_docs)
    for item, word, at in benchmark.occurrences(SuffixArray(sequence), known):
        by = np.lexsort((at, item))
        item, word, at = item[by], word[by], at[by]
        need = benchmark.item_window[item]
        # Windows of an item that overlap are one stretch.
        new = np.concatenate([[True], (item[1:] != item[:-1]) | (at[1:] - at[:-1] >= need[1:])])
        head = np.flatnonzero(new)
        tail = np.concatenate([head[1:], [len(at)]]) - 1
        lengths = at[tail] - at[head] + need[head]
        docs = np.searchsorted(firsts, at[head], "right") - 1
        for d, i, w, q, n in zip(docs.tolist(), item[head].tolist(), word[head].tolist(), (at[head] - firsts[docs]).tolist(), lengths.tolist(), strict=True):
            found[d].append({"item_id": benchmark.item_ids[i], "item_word": w, "doc_word": q, "n_words": n})
    return found


def _scan(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmark = block.value
        for shard in slices(batches, limit=SHARD_BYTES):
            hashes, counts = words.hashes(words.encoded(shard.column("text")), WORD_CUTS)
            runs = _shard_runs(benchmark, hashes, counts)
            yield pa.RecordBatch.from_arrays([shard.column("doc_id"), shard.column("text_key"), pa.array(counts), pa.array(runs, _SCAN.field("runs").type)], schema=_SCAN)

    return run


def _benchmark_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of bounded size; at most one block is in the driver at a time."""
    rows, size = [], 0
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    for r in items.toLocalIterator():
        own = len((r.text or "").encode()) + 16
        if rows and size + own > block_bytes:
            yield rows
            rows, size = [], 0
        rows.append((r.item_id, r.text))
        size += own
    yield rows


def benchmark_runs(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_words, runs (item_id, item_word, doc_word, n_words)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    scans = []
    for block in _benchmark_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(Benchmark(block, window))
        scans.append(rows.mapInArrow(_scan(shared), _SCAN_DDL))
    if len(scans) == 1:
        return scans[0]
    # The passes met every row once each; rows that are equal in doc_id and text have equal runs.
    found = reduce(DataFrame.unionAll, scans).groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("runs")).alias("runs"), (F.count(F.lit(1)) / len(scans)).cast("int").alias("times")
    )
    return found.select("doc_id", "text_key", "n_words", "runs", F.explode(F.sequence(F.lit(1), "times")).alias("time")).drop("time")


def n_hit(runs: Column) -> Column:
    """Words of a document in any of its runs."""
    spans = F.array_sort(F.transform(runs, lambda r: F.struct(r["doc_word"].alias("a"), (r["doc_word"] + r["n_words"]).alias("b"))))
    zero = F.lit(0).cast("bigint")
    total = F.aggregate(
        spans,
        F.struct(zero.alias("reach"), zero.alias("n")),
        lambda acc, s: F.struct(F.greatest(acc["reach"], s["b"]).alias("reach"), (acc["n"] + F.greatest(zero, s["b"] - F.greatest(acc["reach"], s["a"]))).alias("n")),
    )
    return total["n"]


def contamination(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    items = F.array_sort(F.array_distinct(F.transform("runs", lambda r: r["item_id"])))
    found = benchmark_runs(docs, benchmark, **settings).select("doc_id", "n_words", n_hit(F.col("runs")).alias("n_hit"), items.alias("items"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """``docs`` without the rows in which a window of the benchmark occurs, all columns kept."""
    found = benchmark_runs(docs, benchmark, **settings).where(F.size("runs") > 0)
    bad = found.select(F.col("doc_id").alias("__doc_id"), F.col("text_key").alias("__text_key")).distinct()
    same = docs["doc_id"].cast("bigint").eqNullSafe(bad["__doc_id"]) & (F.xxhash64(docs["text"]) == bad["__text_key"])
    return docs.join(bad, same, "left_anti")
