"""Merkle manifest of a dataset, and inclusion proofs by octopus multiproofs.

Each row is a leaf; the rows of a source, in ascending doc_id, are the leaves of a tree, whose root is the source's
subroot; the subroots, in order of source, are the leaves of the top tree. ``FAN`` consecutive nodes (the last run may
be shorter) hash to their parent until one is left. A folder holds the manifest:

- ``leaves``: what each row hashes to, and what the row presented for checking hashes to, if that differs
- ``placed``: the leaves in order, with partition, run of a source in it and place in the run
- ``found``: roots of blocks of FAN**BLOCK_LEVELS leaves, and the coordinates that each leaf partition misses
- ``nodes-K``: the nodes above the blocks, a table for each BLOCK_LEVELS levels

A leaf partition has whole blocks, in order, of the sources it meets. From them it works out the least set of nodes
that all its proofs need and that it cannot derive itself: per tree, the siblings beside its range, level by level.
Those are fetched once, by a join of coordinates. Then it derives the nodes that proofs share and expands each proof.

Hot sources are cut into blocks like any other; a task holds the digests of one leaf partition (about 150 bytes a
row), whose number is that of shuffle partitions. What goes to all tasks is a row per partition.

Nulls are written as ``-``, and a null source is a source of its own, the first; a null doc_id comes first in its
source. Equal doc_ids stand in order of their digests; rows that repeat have a leaf and a proof each. Empty and long
texts are hashed like others. Columns other than those hashed are ignored, whatever their names. An empty table has
no root and gives no rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regtables.llm.common import partitions, work_folder, written

FAN = 3
BLOCK_LEVELS = 8
TOP = -1  # the tree over the subroots
HASHED = ("doc_id", "source", "lang", "n_chars", "text")
ROWS_AT_ONCE = 2000

_PLACED = "part int, run bigint, at bigint, first boolean, source_key string, doc_id bigint, leaf string, shown string"
_NODE = "home int, tree bigint, level int, pos bigint, size bigint, digest string"
_PROOF = "doc_id bigint, leaf string, subroot string, root string, place bigint, proof string, folded_root string, verified boolean"


def digest_of(values: Sequence[Column]) -> Column:
    """Hash of a row: each value as its length in bytes, a colon and the value, or ``-`` for null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def parent(children: Sequence[bytes]) -> bytes:
    return sha256(b"".join(children)).hexdigest().encode()


def sizes(n: int) -> list[int]:
    """Nodes on each level of a tree of ``n`` leaves, down to its root."""
    found = [n]
    while found[-1] > 1:
        found.append(-(-found[-1] // FAN))
    return found


def spans(start: int, end: int, n: int) -> Iterator[tuple[int, int, int, int]]:
    """For each level below the root, of ``n`` nodes at first: level, its size, and the range of nodes that the
    parents of a known range [start, end) are made of. What lies outside the known range is missing."""
    for level, size in enumerate(sizes(n)[:-1]):
        low, high = start // FAN, (end - 1) // FAN + 1
        yield level, size, low * FAN, min(high * FAN, size)
        start, end = low, high


def missing(start: int, end: int, n: int) -> Iterator[tuple[int, int]]:
    """Level and position of the fewest nodes that, with the known range, give all proofs of its leaves."""
    for level, _, low, high in spans(start, end, n):
        for pos in (*range(low, start), *range(end, high)):
            yield level, pos
        start, end = low // FAN, -(-high // FAN)


def climb(start: int, known: list[bytes], n: int, fetch) -> list[tuple[int, list[bytes]]]:
    """Nodes of each level, the root's last: the first position and the digests, siblings fetched."""
    found = []
    for level, size, low, high in spans(start, start + len(known), n):
        row = [fetch(level, p) for p in range(low, start)] + known + [fetch(level, p) for p in range(start + len(known), high)]
        found.append((low, row))
        start, known = low // FAN, [parent(row[i : i + FAN]) for i in range(0, len(row), FAN)]
    return [*found, (start, known)]


class Path:
    """The siblings on the way from a node to the top; shared by all leaves below the node."""

    __slots__ = ("left", "right", "above", "text")

    def __init__(self, left: bytes, right: bytes, above: Path | None):
        self.left, self.right, self.above = left, right, above
        self.text = left + right + (above.text if above else b"")

    def fold(self, digest: bytes) -> bytes:
        step = self
        while step:
            digest = sha256(step.left + digest + step.right).hexdigest().encode()
            step = step.above
        return digest


def paths(levels: list[tuple[int, list[bytes]]], start: int, end: int, above: Path | None) -> list[Path | None]:
    """For the nodes [start, end) of the lowest level, their ways up through ``levels`` and then ``above``."""
    if len(levels) == 1:
        return [above] * (end - start)
    low, row = levels[0]
    first = start // FAN
    upper = paths(levels[1:], first, (end - 1) // FAN + 1, above)
    found = []
    for p in range(start, end):
        q = p - p % FAN - low
        found.append(Path(b"".join(row[q : p - low]), b"".join(row[p - low + 1 : q + FAN]), upper[p // FAN - first]))
    return found


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = _arrow(ddl)
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _ascii(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a source in a sorted partition, and places in them."""
    part, run, at, before = TaskContext.get().partitionId(), -1, 0, object()
    for batch in batches:
        rows = []
        for key, *kept in zip(*(batch.column(c).to_pylist() for c in ("source_key", "doc_id", "leaf", "shown")), strict=True):
            first = key != before
            if first:
                run, at, before = run + 1, 0, key
            rows.append((part, run, at, first, key, *kept))
            at += 1
        yield _batch(rows, _PLACED)


def _outline(placed: DataFrame, block: int) -> tuple[list[tuple], int, int]:
    """For each partition its part of the trees, the number of trees, and the size of the largest. A row per
    partition comes to the driver."""
    first, length = F.col("run") == 0, F.col("at") + 1
    ends = placed.groupBy("part", "run").agg(F.max(length).alias("n"), F.max("source_key").alias("key"))
    ends = ends.groupBy("part").agg(
        F.max("run").alias("last_run"), F.max(F.when(first, F.col("n"))).alias("first_n"), F.max_by("n", "run").alias("last_n"),
        F.max(F.when(first, F.col("key"))).alias("first_key"), F.max_by("key", "run").alias("last_key"), F.max("n").alias("largest"),
    )
    parts = sorted(ends.collect())
    total: dict[int, int] = {}  # leaves of the trees that meet an end of a partition
    rows, trees, open_key = [], 0, None
    starts: list[tuple[int, int]] = []  # where partitions begin in the open source
    for k, p in enumerate(parts):
        if not k or p.first_key != open_key:
            trees, starts = trees + 1, []
        tree = trees - 1
        offset = total.get(tree, 0)
        starts.append((offset, p.part))
        # The block that is open where the partition begins belongs to the partition it began in.
        home = max(s for s in starts if s[0] <= offset // block * block)[1]
        total[tree] = offset + p.first_n
        if p.last_run:
            trees += p.last_run
            total[trees - 1] = p.last_n
            starts = [(0, p.part)]
        rows.append((p.part, tree, offset, home, p.last_run, trees - 1))
        open_key = p.last_key
        # Later blocks begin here at the earliest.
        done = total[trees - 1] // block * block
        starts = [s for s, after in zip(starts, [*starts[1:], (done + 1, 0)], strict=True) if after[0] > done]
    return [(*r[:5], total[r[1]], total[r[5]]) for r in rows], trees, max([*total.values(), *(p.largest for p in parts)], default=0)


def _dealt(spark: SparkSession, folder: str, outline: list[tuple], block: int) -> DataFrame:
    """Leaves with their home (the leaf partition), tree, position and, where it isn't plain from the home, size of the tree."""
    parts = spark.createDataFrame(outline, "part int, tree0 bigint, offset bigint, home0 int, last_run bigint, size0 bigint, size_last bigint")
    placed = spark.read.schema(_PLACED).parquet(f"{folder}/placed").join(F.broadcast(parts), "part")  # a row per partition
    first = F.col("run") == 0
    pos = F.col("at") + F.when(first, F.col("offset")).otherwise(0)
    began_before = first & (pos - pos % block < F.col("offset"))
    return placed.select(
        F.when(began_before, F.col("home0")).otherwise(F.col("part")).alias("home"), (F.col("tree0") + F.col("run")).alias("tree"), pos.alias("pos"),
        F.when(first, F.col("size0")).when(F.col("run") == F.col("last_run"), F.col("size_last")).alias("size"),
        "doc_id", "leaf", "shown",
    )


def _homes(batches: Iterator[pa.RecordBatch], columns: Sequence[str]) -> Iterator[tuple[int, dict]]:
    """Home by home, the rows of its trees: {tree: [start, size, {column: values}]}, and the nodes fetched for it."""
    home, trees, fetched = None, {}, {}
    for batch in batches:
        named = {c: batch.column(c).to_pylist() for c in ("home", "tree", "pos", "size", "doc_id")} | {c: _ascii(batch.column(c)) for c in ("leaf", "shown")}
        levels = batch.column("level").to_pylist() if "level" in batch.schema.names else None
        for i, own in enumerate(named["home"]):
            if own != home:
                if trees:
                    yield home, trees, fetched
                home, trees, fetched = own, {}, {}
            tree, pos = named["tree"][i], named["pos"][i]
            if levels and levels[i] is not None:
                fetched[tree, levels[i], pos] = named["leaf"][i]
                continue
            if tree not in trees:
                trees[tree] = [pos, named["size"][i], {c: [] for c in columns}]
            held = trees[tree][2]
            for c in columns:
                held[c].append(named[c][i])
    if trees:
        yield home, trees, fetched


def _blocks(leaves: list[bytes], block_levels: int) -> list[bytes]:
    """Roots of the blocks that ``leaves``, which begin with a block, are made of."""
    size, found = FAN**block_levels, []
    for i in range(0, len(leaves), size):
        row = leaves[i : i + size]
        for _ in range(block_levels):
            row = [parent(row[j : j + FAN]) for j in range(0, len(row), FAN)]
        found += row
    return found


def _find(n_trees: int, block_levels: int):
    """Per home: the roots of its blocks (or subroots of small trees), and the nodes it misses (no digest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = FAN**block_levels
        for home, trees, _ in _homes(batches, ("leaf",)):
            rows = []
            for tree, (start, size, held) in trees.items():
                leaves, size = held["leaf"], size or len(held["leaf"])
                if size <= block:
                    rows.append((home, TOP, 0, tree, n_trees, climb(0, leaves, size, None)[-1][1][0].decode()))
                    continue
                upper = sizes(size)[block_levels]
                roots = _blocks(leaves, block_levels)
                first = start // block
                rows += [(home, tree, block_levels, first + i, upper, r.decode()) for i, r in enumerate(roots)]
                rows += [(home, tree, block_levels + level, pos, None, None) for level, pos in missing(first, first + len(roots), upper)]
            rows += [(home, TOP, level, pos, None, None) for level, pos in missing(min(trees), max(trees) + 1, n_trees)]
            yield _batch(rows, _NODE)

    return run


def _raise(block_levels: int):
    """All nodes above those of a block, sorted, up to block_levels levels or the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes(group: tuple | None, held: list[str]) -> list[tuple]:
            if not held:
                return []
            tree, level, first, size = group
            found, row, count = [], [d.encode() for d in held], size
            for up in range(block_levels + 1):
                found += [(None, tree, level + up, first // FAN**up + i, count, d.decode()) for i, d in enumerate(row)]
                if count == 1:
                    break
                row, count = [parent(row[i : i + FAN]) for i in range(0, len(row), FAN)], -(-count // FAN)
            return found

        block, group, held = None, None, []
        for batch in batches:
            rows: list[tuple] = []
            for tree, level, pos, size, digest in zip(*(batch.column(c).to_pylist() for c in ("tree", "level", "pos", "size", "digest")), strict=True):
                own = (tree, level, pos // FAN**block_levels)
                if own != block:
                    rows += nodes(group, held)
                    block, group, held = own, (tree, level, pos, size), []
                held.append(digest)
            if rows:
                yield _batch(rows, _NODE)
        yield _batch(nodes(group, held), _NODE)

    return run


def _expand(n_trees: int, block_levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = FAN**block_levels
        for _, trees, fetched in _homes(batches, ("doc_id", "leaf", "shown")):
            upper, first_tree = {}, min(trees)
            for tree, (start, size, held) in trees.items():
                size = size or len(held["leaf"])
                if size <= block:
                    upper[tree] = climb(0, held["leaf"], size, None)
                else:
                    upper[tree] = climb(start // block, _blocks(held["leaf"], block_levels), sizes(size)[block_levels], lambda level, p, t=tree: fetched[t, block_levels + level, p])
            subroots = [upper[t][-1][1][0] for t in sorted(trees)]
            top = climb(first_tree, subroots, n_trees, lambda level, p: fetched[TOP, level, p])
            root = top[-1][1][0].decode()
            ways = paths(top, first_tree, first_tree + len(subroots), None)
            for tree, (start, size, held) in trees.items():
                size, leaves, above = size or len(held["leaf"]), held["leaf"], ways[tree - first_tree]
                subroot = upper[tree][-1][1][0].decode()
                for i in range(0, len(leaves), block):
                    row = leaves[i : i + block]
                    if size <= block:
                        levels, way = upper[tree], above
                    else:  # the levels within the block, then those above it
                        at = (start + i) // block
                        levels = _within(row, block_levels)
                        way = paths(upper[tree], at, at + 1, above)[0]
                    found = paths(levels, 0, len(row), way)
                    rows = []
                    for j, (leaf, path) in enumerate(zip(row, found, strict=True)):
                        folded = held["shown"][i + j] or leaf
                        folded = (path.fold(folded) if path else folded).decode()
                        rows.append((held["doc_id"][i + j], leaf.decode(), subroot, root, start + i + j, path.text.decode() if path else "", folded, folded == root))
                        if len(rows) == ROWS_AT_ONCE:
                            yield _batch(rows, _PROOF)
                            rows = []
                    if rows:
                        yield _batch(rows, _PROOF)

    return run


def _within(row: list[bytes], block_levels: int) -> list[tuple[int, list[bytes]]]:
    """All levels of one block of a larger tree; in a short last block the upper ones have a node each."""
    found = [(0, row)]
    for _ in range(block_levels):
        row = [parent(row[i : i + FAN]) for i in range(0, len(row), FAN)]
        found.append((0, row))
    return found


def write_manifest(docs: DataFrame, folder: str, shown: Mapping[str, Column] | None = None, block_levels: int = BLOCK_LEVELS) -> tuple[list[tuple], int, list[str]]:
    """Leaves and nodes of ``docs`` in ``folder``. ``shown`` gives, by column name, what is presented for checking
    in its place; proofs are then folded from that."""
    spark = docs.sparkSession
    columns = [F.col(c) for c in HASHED]
    leaf = digest_of(columns)
    other = F.nullif(digest_of([(shown or {}).get(c, F.col(c)) for c in HASHED]), leaf)
    key = F.sha2(F.col("source").cast("string"), 256)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", key.alias("source_key"), leaf.alias("leaf"), other.alias("shown"), F.monotonically_increasing_id().alias("seat"))
    leaves = written(rows, f"{folder}/leaves", compression="zstd")
    # ``seat`` tells equal rows apart, so that many of them need not lie in one task.
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("seat")]
    dealt = leaves.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    placed = written(dealt.drop("source", "seat").mapInArrow(_number, _PLACED), f"{folder}/placed", compression="zstd")

    outline, n_trees, largest = _outline(placed, FAN**block_levels)
    at_home = _dealt(spark, folder, outline, FAN**block_levels).repartition(partitions(spark), "home").sortWithinPartitions("home", "tree", "pos")
    found = written(at_home.mapInArrow(_find(n_trees, block_levels), _NODE), f"{folder}/found", compression="zstd")
    roots = found.where("digest is not null")
    tables: list[str] = []

    def raise_nodes(nodes: DataFrame, first: int, last: int) -> None:
        """Writes the nodes from level ``first``, which ``nodes`` are on, to ``last``, tier by tier."""
        for level in range(first, max(last, first + 1), block_levels):
            dealt = nodes.repartition(partitions(spark), "tree", F.expr(f"pos div {FAN**block_levels}")).sortWithinPartitions("tree", "pos")
            tables.append(f"nodes-{len(tables)}")
            nodes = written(dealt.mapInArrow(_raise(block_levels), _NODE), f"{folder}/{tables[-1]}", compression="zstd")
            nodes = nodes.where((F.col("level") == level + block_levels) & (F.col("size") > 1))

    tops = roots.where(F.col("tree") == TOP)
    if largest > FAN**block_levels:
        raise_nodes(roots.where(F.col("tree") != TOP), block_levels, len(sizes(largest)) - 1)
        own = spark.read.schema(_NODE).parquet(*(f"{folder}/{t}" for t in tables)).where("size = 1").dropDuplicates(["tree"])
        tops = tops.unionByName(own.select("home", F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("pos"), F.lit(n_trees).cast("bigint").alias("size"), "digest"))
    raise_nodes(tops, 0, len(sizes(n_trees)) - 1)
    return outline, n_trees, tables


def proofs(docs: DataFrame, shown: Mapping[str, Column] | None = None, folder: str | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text): doc_id, leaf, subroot, root, place (in its source),
    proof (the digests of its siblings, 64 characters each, level by level, left to right), folded_root (from the
    row as ``shown``, with the original siblings), verified."""
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "manifest")
    outline, n_trees, tables = write_manifest(docs, folder, shown, block_levels)
    if not n_trees:
        return spark.createDataFrame([], _PROOF)
    wanted = spark.read.schema(_NODE).parquet(f"{folder}/found").where("digest is null").select("home", "tree", "level", "pos")
    nodes = spark.read.schema(_NODE).parquet(*(f"{folder}/{t}" for t in tables)).select("tree", "level", "pos", "digest").dropDuplicates(["tree", "level", "pos"])
    fetched = wanted.join(nodes, ["tree", "level", "pos"])
    rows = _dealt(spark, folder, outline, FAN**block_levels).withColumn("level", F.lit(None).cast("int"))
    null = lambda kind: F.lit(None).cast(kind)
    more = fetched.select("home", "tree", "pos", null("bigint").alias("size"), null("bigint").alias("doc_id"), F.col("digest").alias("leaf"), null("string").alias("shown"), "level")
    dealt = rows.unionByName(more).repartition(partitions(spark), "home").sortWithinPartitions("home", F.col("level").isNull(), "tree", "pos")
    return dealt.mapInArrow(_expand(n_trees, block_levels), _PROOF)
