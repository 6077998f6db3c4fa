"""Rows of one key collapsed into one row, with the source order kept.

However large a group is, first values, counts and the content hash are combined before the shuffle. Of the
joined texts only distinct values are brought together: a hot key is split over its values, which are combined
before the shuffle too. Where groups are small that combines next to nothing, and each row is moved several times;
a caller may have the groups measured first, see ``sized`` of :func:`collapse_by_key`. Source rows stay rows, see
:func:`source_rows`; only :func:`rows_as_json` gathers them, for callers that want them in a cell.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from regtables.functions.records import combined_hash, content_hash, hash_numbers, hash_sums, json_array, raw_json


# Groups are measured by the hash of their key, into so many buckets. All groups of a bucket with more rows than that
# count as large.
_BUCKETS, _BUCKET_ROWS = 1 << 16, 100_000


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _seen_values(rows: DataFrame, names: Sequence[str], joined: Sequence[str]) -> DataFrame:
    """Per key the distinct values ``_v`` of the ``joined`` columns, each with the place it is first seen at."""
    named = F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).alias("value")) for i, c in enumerate(joined)])
    values = rows.select(*names, "_order", F.explode(named).alias("_v"))
    seen = values.where("_v.value IS NOT NULL").groupBy(*names, "_v.at", "_v.value").agg(F.min("_order").alias("_order"))
    return seen.select(*names, F.struct("_order", "at", "value").alias("_v"))


def _by_size(rows: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows of small groups, and those of the others, if there are any. Only the keys are read for it."""
    bucket = F.pmod(F.xxhash64(*names), F.lit(_BUCKETS)).alias("_bucket")
    counts = rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    found = [(r["_bucket"],) for r in counts.where(F.col("n") > _BUCKET_ROWS).collect()]  # as many as there are buckets at most
    if not found:
        return rows, None
    large = F.broadcast(rows.sparkSession.createDataFrame(found, "_bucket bigint"))
    marked = rows.withColumn("_bucket", bucket)
    return tuple(marked.join(large, "_bucket", how).drop("_bucket") for how in ("left_anti", "left_semi"))


def _small_groups(rows: DataFrame, names: Sequence[str], aggregates: Sequence[Column], joined: Sequence[str]) -> DataFrame:
    """Groups and their values ``_seen`` by one shuffle of the rows as they are."""
    item = F.struct("_order", *joined)
    groups = rows.repartition(*names).groupBy(*names).agg(*aggregates, F.collect_list(item).alias("_rows"))
    placed = lambda c: F.transform(F.filter("_rows", lambda r: r[c].isNotNull()), lambda r: F.struct(r["_order"].alias("_order"), r[c].alias("value")))
    values = lambda c: F.array_distinct(F.transform(F.sort_array(placed(c)), lambda v: v["value"]))
    return groups.select(*[c for c in groups.columns if c != "_rows"], *[values(c).alias(c) for c in joined])


def _large_groups(rows: DataFrame, names: Sequence[str], aggregates: Sequence[Column], joined: Sequence[str]) -> DataFrame:
    """Groups and their values, both combined before they are moved. A key's group and its values are brought together
    by one shuffle; each key has one group."""
    groups = rows.groupBy(*names).agg(*aggregates)
    group = F.struct(*[c for c in groups.columns if c not in names]).alias("_group")
    both = groups.select(*names, group).unionByName(_seen_values(rows, names, joined), allowMissingColumns=True).repartition(*names)
    found = both.groupBy(*names).agg(F.first("_group", ignorenulls=True).alias("_group"), F.sort_array(F.collect_list("_v")).alias("_seen"))
    values = lambda i: F.transform(F.filter("_seen", lambda v: v["at"] == i), lambda v: v["value"])
    return found.select(*names, "_group.*", *[values(i).alias(c) for i, c in enumerate(joined)])


def collapse_by_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    first: Sequence[str] | Mapping[str, str | Column] = (),
    joined: Sequence[str] = (),
    record: Sequence[str] = (),
    separator: str = "\n",
    sized: bool = False,
) -> DataFrame:
    """One row per key, with ``n_rows``; a null key is a group of its own.

    ``first`` columns take their first non-null value in ``order``; as a mapping, names to columns or
    expressions. ``joined`` columns become the distinct values joined by ``separator``, ``''`` if there is
    none. With ``record`` columns, ``_meta_source_content_hash`` tells whether any of them changed in any row:
    it adds up hashes of each row's JSON with its place, nulls included. Columns ``df`` does not have are left
    out. ``order`` must be a total order within a key.

    ``sized``: the groups are measured now, by a job that reads the keys. The rows of small ones are then moved once,
    as they are; the others are combined first, as all are otherwise.
    """
    keys = _keys(key)
    have = set(df.columns)
    wanted = dict(first) if isinstance(first, Mapping) else {c: c for c in first}
    wanted = {name: v for name, v in wanted.items() if not isinstance(v, str) or v in have}
    joined = [c for c in joined if c in have]
    record = [c for c in record if c in have]
    firsts = {name: F.col(v) if isinstance(v, str) else v for name, v in wanted.items()}
    # What is costly is worked out once per row, before the aggregates, which look at it several times.
    rank, names = F.struct(*order), [f"_key_{k}" for k in keys]
    texts = [f"_text_{i}" for i in range(len(joined))]
    rows = df.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], rank.alias("_order"), *[v.alias(f"_first_{c}") for c, v in firsts.items()],
        *[F.col(c).cast("string").alias(t) for c, t in zip(joined, texts)],
        *([F.sha2(raw_json([rank.alias("place"), F.struct(*record).alias("row")]), 256).alias("_hash")] if record else []),
    )
    aggregates = [F.min_by(f"_first_{c}", F.when(F.col(f"_first_{c}").isNotNull(), F.col("_order"))).alias(f"_first_{c}") for c in firsts]
    if record:
        a, b = hash_numbers(F.col("_hash"))
        rows = rows.withColumns({"_a": a, "_b": b}).drop("_hash")
        aggregates += hash_sums(F.col("_a"), F.col("_b"))
    aggregates.append(F.count(F.lit(1)).alias("n_rows"))
    if not joined:
        groups = rows.groupBy(*names).agg(*aggregates)
    else:
        small, large = _by_size(rows, names) if sized else (None, rows)
        parts = [f(part, names, aggregates, texts) for f, part in ((_small_groups, small), (_large_groups, large)) if part is not None]
        groups = reduce(DataFrame.unionByName, parts)
    out = [*[F.col(n).alias(k) for k, n in zip(keys, names)], *[F.col(f"_first_{c}").alias(c) for c in firsts]]
    out += [F.array_join(t, separator).alias(c) for c, t in zip(joined, texts)]
    out.append("n_rows")
    if record:
        out.append(combined_hash(F.col("n_rows")).alias("_meta_source_content_hash"))
    return groups.select(*out)


def source_rows(df: DataFrame, key: str | Sequence[str], order: Sequence[str], record: Sequence[str]) -> DataFrame:
    """The rows behind the groups: ``(key…, source_order, raw_data_full)``, both as JSON. Nothing is shuffled."""
    return df.select(*_keys(key), raw_json(order).alias("source_order"), raw_json(record).alias("raw_data_full"))


def rows_as_json(
    df: DataFrame, key: str | Sequence[str], order: Sequence[str], record: Sequence[str], record_column: str = "raw_data_full"
) -> DataFrame:
    """Per key its rows as one JSON array, with their number and the hash of the array. This gathers the rows
    of a key in one cell (2 GB at most), so it is for keys that own a few rows each."""
    item = F.struct(F.struct(*order).alias("_order"), *record)
    rows = df.groupBy(*_keys(key)).agg(F.sort_array(F.collect_list(item)).alias("_rows"))
    records = F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in record]))
    found = rows.select(*_keys(key), F.size("_rows").cast("bigint").alias("n_rows"), json_array(records).alias(record_column))
    return found.withColumn("_meta_source_content_hash", content_hash(F.col(record_column)))
