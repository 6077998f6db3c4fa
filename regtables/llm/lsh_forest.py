"""Near copies by an LSH forest of MinHash signatures, confirmed on whole shingle sets.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a document's set has its distinct shingles of ``size``
words, or its whole sequence as one if it is shorter. Equal sets are one class, of which the smallest doc_id
stands for all. Each tree sorts the classes by its own part of the signature. Candidates of a tree are

- neighbours in that order whose common prefix has ``least_depth`` values at least, and
- all pairs of a region: the documents that share a prefix, which is made longer, value by value, where more
  than ``region`` documents share it. A region that is still larger at full depth is tied to its first document.

Documents of regions with more than ``region`` at ``least_depth`` are crowded. They are also joined exactly, so
that a prefix of any depth proposes all its pairs: two sets that are similar enough share one of the first
shingles of both, in an order that has rare shingles first. Of each such shingle's documents the one that has it
earliest is a hub that the others are compared with; then all pairs across what are still two components are.

Sorted orders are dealt out by range, so a prefix that a third of all documents share lies in several tasks;
the rows at both ends of a task's range are compared with those of the next task.

Links are confirmed in rounds. The first takes for each document the partner it met in most trees; the second
takes the hubs and all other candidates whose ends are not connected by then, the third the exact join's pairs.
Links inside a component change nothing, so the rounds together give the components of all candidates.

Null and empty texts have an empty set and are linked with nothing. A null doc_id is linked with nothing, has
no component and stays. Rows that repeat a doc_id are one document with several texts: they have one
component. Other columns are ignored; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from regtables.llm import words
from regtables.llm.common import partitions, slices, work_folder, written
from regtables.llm.components import components

TREES = 20
DEPTH = 8
LEAST_DEPTH = 4
REGION = 8
RANK_BUCKETS = 1 << 18  # shingles are ordered by how often one of their bucket occurs
LIST_ROWS = 1000  # a shingle with more documents is compared in several parts
WORD_CUTS = words.separators((0x20, 0x20), (0x09, 0x0D))

_SEEDS = np.random.RandomState(20_011)
_FACTORS = (_SEEDS.randint(0, 1 << 31, 512).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_SHIFTS = _SEEDS.randint(0, 1 << 32, 512, dtype=np.int64).astype(np.uint32)

_SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key_a", pa.int64()), ("key_b", pa.int64()), ("signature", pa.binary())])
_SKETCH_DDL = "doc_id bigint, n_shingles bigint, key_a bigint, key_b bigint, signature binary"
_TREE = pa.schema([("tree", pa.int32()), ("prefix", pa.binary()), ("id", pa.int64())])
_TREE_DDL = "tree int, prefix binary, id bigint"
_CANDIDATE = pa.schema([("border", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("tree", pa.int32()), ("prefix", pa.binary())])
_COUNT = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])
_FIRST = pa.schema([("shingle", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("place", pa.int64())])
_FIRST_DDL = "shingle bigint, id bigint, n bigint, place bigint"
_CANDIDATE_DDL = "border int, a bigint, b bigint, tree int, prefix binary"


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles."""
    found = []
    hashes, counts = words.hashes(texts, WORD_CUTS)
    ends = np.cumsum(counts)
    for start, end in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        own = hashes[start:end]
        n = min(size, len(own))
        if not n:
            found.append(own)
            continue
        h = np.full(len(own) - n + 1, n, np.uint64)
        for k in range(n):
            h = words.mixed(h * np.uint64(0x9E3779B97F4A7C15) + own[k : k + len(h)])
        found.append(np.unique(h))
    return found


def signature(shingles: np.ndarray, n: int) -> np.ndarray:
    """MinHash values of ``n`` functions, 16 bits each."""
    low = shingles.astype(np.uint32)
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 4096):
        part = low[i : i + 4096]
        np.minimum(least, (part * _FACTORS[:n, None] + _SHIFTS[:n, None]).min(axis=1), out=least)
    return (least * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(">u2")


def _sketch(size: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(words.encoded(batch.column("text")), size)
            # Two sums over the set name it: equal for equal sets, and only then (128 bits).
            key_a = np.array([words.mixed(s).sum(dtype=np.uint64) for s in sets], np.uint64)
            key_b = np.array([words.mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(key_a.view(np.int64)),
                    pa.array(key_b.view(np.int64)),
                    pa.array([signature(s, n).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                schema=_SKETCH,
            )

    return run


def _trees(n_trees: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                n, width = part.num_rows, 2 * depth
                values = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint8).reshape(n, n_trees, width)
                prefixes = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n * n_trees, [None, pa.py_buffer(np.ascontiguousarray(values))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(n_trees, dtype=np.int32), n)), prefixes.cast(pa.binary()), pa.array(np.repeat(part.column("id").to_numpy(), n_trees))],
                    schema=_TREE,
                )

    return run


def region_pairs(order: np.ndarray, prefixes: np.ndarray, least_depth: int, region: int) -> np.ndarray:
    """Pairs of places in a sorted order. order: the tree of each row; prefixes: rows of values."""
    n, depth = prefixes.shape
    if n < 2:
        return np.zeros((0, 2), np.int64)
    differs = np.concatenate([order[1:] != order[:-1], [True]])[:-1]
    common = np.where(differs, 0, np.cumprod(prefixes[1:] == prefixes[:-1], axis=1).sum(axis=1))
    found = [np.flatnonzero(common >= least_depth)[:, None] + np.array([0, 1])]
    rows = np.arange(n)
    for d in range(least_depth, depth + 1):
        # Runs of rows that share d values; the rows still here come in whole runs of the depth before.
        new = np.concatenate([[True], (np.diff(rows) > 1) | (common[rows[1:] - 1] < d)])
        heads = np.flatnonzero(new)
        sizes = np.diff(np.concatenate([heads, [len(rows)]]))
        size, head = np.repeat(sizes, sizes), np.repeat(heads, sizes)
        place = np.arange(len(rows)) - head
        whole = size <= region
        for step in range(2, region):
            at = np.flatnonzero(whole & (place + step < size))
            found.append(np.stack([rows[at], rows[at + step]], axis=1))
        if d == depth:
            at = np.flatnonzero(~whole & (place > 1))
            found.append(np.stack([rows[head[at]], rows[at]], axis=1))
        rows = rows[~whole]
        if not len(rows):
            break
    return np.concatenate(found)


def _gathered(batches: Iterator[pa.RecordBatch], depth: int, first: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    held = [b for b in batches if b.num_rows]
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, depth), np.uint16), np.zeros(0, np.int64)
    column = lambda c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held])
    values = np.frombuffer(b"".join(v.as_buffer() for b in held for v in b.column("prefix")), ">u2").reshape(-1, depth)
    return column(first).astype(np.int64), column("tree").astype(np.int64), values, column("id").astype(np.int64)


def crowded_rows(order: np.ndarray, prefixes: np.ndarray, least_depth: int, region: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of a sorted order in runs of more than ``region`` rows that share ``least_depth`` values, and those in the
    first and last run, which may go on in other tasks."""
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = (order[1:] != order[:-1]) | (prefixes[1:, :least_depth] != prefixes[:-1, :least_depth]).any(axis=1)
    heads = np.flatnonzero(np.concatenate([[True], new]))
    sizes = np.diff(np.concatenate([heads, [len(order)]]))
    at_end = np.zeros(len(sizes), bool)
    at_end[[0, -1]] = True
    return np.flatnonzero(np.repeat((sizes > region) & ~at_end, sizes)), np.flatnonzero(np.repeat(at_end, sizes))


def _candidates(depth: int, least_depth: int, region: int):
    """A task's range of the sorted orders: its pairs, the rows at both ends for the next tasks, crowded rows (with a
    prefix, but no tree) and, with tree and prefix and this task as b, those of its first and last run, which may be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        me = TaskContext.get().partitionId()
        _, tree, values, ids = _gathered(batches, depth, "tree")
        for part in _pair_rows(tree, values, ids, least_depth, region):
            yield part
        crowd, ends = crowded_rows(tree, values, least_depth, region)
        for rows, is_end in ((crowd, False), (ends, True)):
            for i in range(0, len(rows), 100_000):
                at = rows[i : i + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(len(at), pa.int32()),
                        pa.array(ids[at]),
                        pa.array(np.full(len(at), me, np.int64)),
                        pa.array(tree[at], pa.int32()) if is_end else pa.nulls(len(at), pa.int32()),
                        pa.array([values[i, :least_depth].tobytes() if is_end else b"" for i in at], pa.binary()),
                    ],
                    schema=_CANDIDATE,
                )
        n = len(ids)
        at = np.concatenate([np.arange(min(region, n)), np.arange(max(0, n - region), n)])
        border = np.concatenate([np.full(min(region, n), me - 1), np.full(min(region, n), me)])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(border, pa.int32()),
                pa.array(ids[at]),
                pa.nulls(len(at), pa.int64()),
                pa.array(tree[at], pa.int32()),
                pa.array([values[i].tobytes() for i in at], pa.binary()),
            ],
            schema=_CANDIDATE,
        )

    return run


def _border_candidates(depth: int, least_depth: int, region: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        border, tree, values, ids = _gathered(batches, depth, "border")
        yield from _pair_rows(border << 16 | tree, values, ids, least_depth, region)

    return run


def _pair_rows(order, values, ids, least_depth: int, region: int) -> Iterator[pa.RecordBatch]:
    pairs = ids[region_pairs(order, values, least_depth, region)].reshape(-1, 2)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    for i in range(0, len(pairs), 100_000):
        part = pairs[i : i + 100_000]
        n = len(part)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int32()), pa.array(part.max(axis=1)), pa.array(part.min(axis=1)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
            schema=_CANDIDATE,
        )


def _chosen_sets(batches: Iterator[pa.RecordBatch], size: int, bits: np.ndarray) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Ids and shingle sets of the documents that ``bits``, a Bloom filter, lets pass."""
    for batch in slices(batches):
        place = batch.column("place").to_numpy() & (len(bits) * 64 - 1)
        passed = (bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)
        batch = batch.filter(pa.array(passed.astype(bool)))
        if batch.num_rows:
            yield batch.column("doc_id"), shingle_sets(words.encoded(batch.column("text")), size)


def _sets(size: int, chosen):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("shingles", pa.list_(pa.int64()))])
        for ids, sets in _chosen_sets(batches, size, chosen.value):
            yield pa.RecordBatch.from_arrays([ids, pa.array([s.view(np.int64) for s in sets], schema.field("shingles").type)], schema=schema)

    return run


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(RANK_BUCKETS - 1)).astype(np.int64)


def _bucket_counts(size: int, chosen):
    """How often shingles of each bucket occur in a task's chosen documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(RANK_BUCKETS, np.int64)
        for _, sets in _chosen_sets(batches, size, chosen.value):
            counts += np.bincount(_bucket(np.concatenate(sets)), minlength=RANK_BUCKETS)
        there = np.flatnonzero(counts)
        for i in range(0, len(there), 100_000):
            part = there[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], schema=_COUNT)

    return run


def least_shared(n_a, n_b, percent: int):
    """What two sets must share at least: 100 * shared >= percent * (n_a + n_b - shared), rounded up."""
    return (percent * (n_a + n_b) + 99 + percent) // (100 + percent)


def first_shingles(shingles: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """Those of a set, in the common order, of which it shares one with every set that is similar enough."""
    n = len(shingles)
    return shingles[np.lexsort((shingles, counts[_bucket(shingles)]))][: n - (percent * n + 99) // 100 + 1] if n else shingles


def _first(size: int, percent: int, chosen, counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _chosen_sets(batches, size, chosen.value):
            found = [first_shingles(s, counts.value, percent) for s in sets]
            sizes = [len(f) for f in found]
            if sum(sizes):
                columns = np.concatenate(found).view(np.int64), np.repeat(ids.to_numpy(), sizes), np.repeat([len(s) for s in sets], sizes), np.concatenate([np.arange(k) for k in sizes])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_FIRST)

    return run


MAX_FILTER_WORDS = 1 << 21  # 16 MB go to every task; a fuller filter only lets more documents pass


def _filter_of(ids: DataFrame) -> np.ndarray:
    """A Bloom filter over ids, its size bound by MAX_FILTER_WORDS."""
    n = min(MAX_FILTER_WORDS, 1 << max(4, (ids.count() // 4).bit_length()))
    place = F.xxhash64("id").bitwiseAND(n * 64 - 1)
    found = ids.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(xxhash64(id) & 63 as int))").alias("bit"))
    found = found.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(n, np.uint64)
    bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return bits


class Forest:
    """The steps of one run, with their tables in ``folder``."""

    def __init__(self, docs: DataFrame, folder: str, size: int, percent: int, trees: int, depth: int, least_depth: int, region: int):
        self.spark, self.folder = docs.sparkSession, folder
        self.size, self.percent, self.region = size, percent, region
        self.trees, self.depth, self.least_depth = trees, depth, least_depth
        self.docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        self.sketches = written(self.docs.mapInArrow(_sketch(size, trees * depth), _SKETCH_DDL), f"{folder}/sketches")
        linked = self.sketches.where("n_shingles > 0 and doc_id is not null")
        classes = linked.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n"))
        self.classes = written(classes, f"{folder}/classes")

    def candidates(self) -> DataFrame:
        """a, b, times: distinct pairs of classes, and in how many places of the forest they met."""
        orders = self.classes.select("id", "signature").mapInArrow(_trees(self.trees, self.depth), _TREE_DDL)
        ranged = orders.repartitionByRange(partitions(self.spark), "tree", "prefix", "id").sortWithinPartitions("tree", "prefix", "id")
        settings = self.depth, self.least_depth, self.region
        found = written(ranged.mapInArrow(_candidates(*settings), _CANDIDATE_DDL), f"{self.folder}/met")
        ends = found.where("border is not null").select("border", "tree", "prefix", F.col("a").alias("id"))
        ends = ends.repartition("border").sortWithinPartitions("border", "tree", "prefix", "id")
        crowd = found.where("border is null and prefix is not null")
        at_ends = crowd.where("tree is not null")
        regions = at_ends.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("first"), F.max("b").alias("last"))
        # A region in more than two tasks is not whole at any border.
        regions = regions.where((F.col("n") > self.region) | (F.col("last") - F.col("first") > 1)).select("tree", "prefix")
        # A task has two runs at its ends, so there are no more of these regions than twice the partitions.
        crowded = crowd.where("tree is null").select("a").unionAll(at_ends.join(F.broadcast(regions), ["tree", "prefix"], "left_semi").select("a"))
        self.crowded = written(crowded.select(F.col("a").alias("id")).distinct(), f"{self.folder}/crowded")
        pairs = found.where("border is null and prefix is null").unionAll(ends.mapInArrow(_border_candidates(*settings), _CANDIDATE_DDL))
        return written(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times")), f"{self.folder}/candidates")

    def _placed(self) -> DataFrame:
        return self.docs.where("doc_id is not null").withColumn("place", F.xxhash64("doc_id"))

    def first_of_crowded(self) -> DataFrame | None:
        """shingle, id, n, place: the first shingles of each crowded document. None if there are no such documents."""
        if self.crowded.isEmpty():
            return None
        context = self.spark.sparkContext
        chosen = context.broadcast(_filter_of(self.crowded))
        found = self._placed().mapInArrow(_bucket_counts(self.size, chosen), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros(RANK_BUCKETS, np.int64)
        counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
        rows = self._placed().mapInArrow(_first(self.size, self.percent, chosen, context.broadcast(counts)), _FIRST_DDL)
        return written(rows.join(self.crowded, "id", "left_semi").select("shingle", "id", "n", "place").distinct(), f"{self.folder}/first")

    @staticmethod
    def _lists(first: DataFrame, labels: DataFrame) -> DataFrame:
        """Rows of ``first`` with ``of``, their component, for shingles that lie in several; with ``rows`` of the
        shingle, its ``hub``, and ``most``, the component that has most of them."""
        rows = first.join(labels.select("id", F.col("component").alias("of")), "id", "left").withColumn("of", F.coalesce("of", "id"))
        parts = rows.groupBy("shingle", "of").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct("place", "id")).alias("h"))
        lists = parts.groupBy("shingle").agg(F.sum("k").alias("rows"), F.min("h")["id"].alias("hub"), F.max_by("of", F.struct("k", "of")).alias("most"), F.count(F.lit(1)).alias("parts"))
        return rows.join(lists.where("parts > 1").drop("parts"), "shingle")

    def hub_pairs(self, first: DataFrame, labels: DataFrame) -> DataFrame:
        """a, b: each crowded document with the hub of most of its first shingles."""
        met = self._lists(first, labels).where("id <> hub").groupBy("id", "hub").agg(F.count(F.lit(1)).alias("times"))
        best = met.groupBy("id").agg(F.max_by("hub", F.struct("times", -F.col("hub"))).alias("hub"))
        return best.select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b"))

    def joined_pairs(self, first: DataFrame, labels: DataFrame) -> DataFrame:
        """a, b: all pairs of crowded documents in different components that may be similar enough."""
        rows = written(self._lists(first, labels), f"{self.folder}/lists")
        parts = F.ceil(F.col("rows") / LIST_ROWS).cast("int")
        left = rows.where("of <> most").select("shingle", "most", *(F.col(c).alias(f"{c}_a") for c in ("id", "n", "place", "of")), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
        right = rows.select("shingle", *(F.col(c).alias(f"{c}_b") for c in ("id", "n", "place", "of")), F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"))
        shared = F.expr(f"({self.percent} * (n_a + n_b) + 99 + {self.percent}) div {100 + self.percent}")  # least_shared
        fits = (F.col("place_a") <= F.col("n_a") - shared) & (F.col("place_b") <= F.col("n_b") - shared)
        once = (F.col("of_a") < F.col("of_b")) | ((F.col("of_b") == F.col("most")) & (F.col("of_a") != F.col("of_b")))
        both = left.join(right, ["shingle", "part"]).where(fits & once)
        return both.select(F.greatest("id_a", "id_b").alias("a"), F.least("id_a", "id_b").alias("b")).distinct()

    def confirmed(self, pairs: DataFrame, name: str) -> DataFrame:
        """Those of ``pairs`` (a, b) whose whole sets are similar enough."""
        pairs = written(pairs, f"{self.folder}/pairs-{name}")
        ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
        chosen = self.spark.sparkContext.broadcast(_filter_of(ids))
        sets = self._placed().mapInArrow(_sets(self.size, chosen), "id bigint, shingles array<bigint>").join(ids, "id", "left_semi")
        sets = written(sets, f"{self.folder}/sets-{name}")
        side = lambda c: sets.select(F.col("id").alias(c), F.col("shingles").alias(f"set_{c}"))
        shared = F.size(F.array_intersect("set_a", "set_b"))
        n_a, n_b = F.size("set_a"), F.size("set_b")
        # A pair whose sizes alone rule it out is not compared.
        near = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * self.percent
        linked = F.when(near, shared * 100 >= (n_a + n_b - shared) * self.percent).otherwise(False)
        both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", linked.alias("linked"))
        return written(both.where("linked").select("a", "b").distinct(), f"{self.folder}/links-{name}")

    def _merged(self, labels: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
        """``labels`` after those of ``pairs`` that are confirmed have joined their components."""
        label = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}"))
        ends = self.confirmed(pairs, name).join(label("a"), "a", "left").join(label("b"), "b", "left")
        joined = components(ends.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")), f"{self.folder}/components-{name}")
        joined = written(joined, f"{self.folder}/labels-{name}")
        upper = joined.select(F.col("id").alias("component"), F.col("component").alias("top"))
        moved = labels.join(upper, "component", "left").select("id", F.coalesce("top", "component").alias("component"))
        return moved.unionAll(joined.join(labels, "id", "left_anti"))

    def run(self) -> DataFrame:
        """id, component of the classes that have a link."""
        candidates = self.candidates()
        best = candidates.groupBy("a").agg(F.max_by("b", F.struct("times", -F.col("b"))).alias("b"))
        labels = written(components(self.confirmed(best, "1"), f"{self.folder}/components-1"), f"{self.folder}/labels-1")
        label = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}"))
        first = self.first_of_crowded()
        rest = candidates.select("a", "b") if first is None else candidates.select("a", "b").unionAll(self.hub_pairs(first, labels)).distinct()
        rest = rest.join(label("a"), "a", "left").join(label("b"), "b", "left")
        rest = rest.withColumns({"of_a": F.coalesce("of_a", "a"), "of_b": F.coalesce("of_b", "b")}).where("of_a <> of_b")
        rest = rest.join(best, ["a", "b"], "left_anti")
        labels = self._merged(labels, rest.select("a", "b"), "2")
        if first is None:
            return labels
        labels = written(labels, f"{self.folder}/merged-2")
        return self._merged(labels, self.joined_pairs(first, labels), "3")


def near_copies(docs: DataFrame, size: int = 5, percent: int = 80, trees: int = TREES, depth: int = DEPTH, least_depth: int = LEAST_DEPTH, region: int = REGION) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept. ``percent``: documents are linked
    if 100 * intersection >= percent * union of their sets."""
    forest = Forest(docs, work_folder(docs.sparkSession, "forest"), size, percent, trees, depth, least_depth, region)
    labels = forest.run()
    of_class = forest.classes.join(labels, "id", "left").select("key_a", "key_b", F.coalesce("component", "id").alias("component_id"))
    rows = forest.sketches.select("doc_id", "n_shingles", "key_a", "key_b")
    found = rows.where("n_shingles > 0 and doc_id is not null").join(of_class, ["key_a", "key_b"])
    alone = rows.where("n_shingles = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    found = found.select("doc_id", "n_shingles", "component_id").unionAll(alone.select("doc_id", "n_shingles", "component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_copies(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id; all columns kept."""
    kept = near_copies(docs, **settings).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept"]), "left_semi")
