"""Connected components of links between ids, as tables: large-star and small-star until nothing moves.

Each round is a few joins and aggregations over the links; minima are combined before the shuffle, and
no node's links are gathered in one place. Tasks first replace the links they hold by a spanning forest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from regtables.llm.common import written

_LINK = "a bigint, b bigint"


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one batch with the same components but fewer rows: each id with the smallest it reaches."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.setdefault(top, top)) != top:
                top = up
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        pairs = np.array([(x, root(x)) for x in parent], np.int64).reshape(-1, 2)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _mark(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.h


def components(links: DataFrame, folder: str) -> DataFrame:
    """links: a, b. Gives id, component for each id that has a link; component is the smallest id reachable."""
    found = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    found = written(found.mapInArrow(_forest, _LINK).distinct(), f"{folder}/0")
    mark, turn = _mark(found), 0
    while mark[0]:
        turn += 1
        both = found.unionAll(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        small = moved.unionAll(lower.select("a", F.col("m").alias("b"))).distinct()
        found = written(small, f"{folder}/{turn}")
        last, mark = mark, _mark(found)
        if mark == last:
            break
    return found.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(found.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
