"""Keyed merge as a plan: it reads target and source and writes nothing."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from regtables.functions.records import hash_numbers
from regtables.operators.quality import as_text
from regtables.operators.sizing import pin, small_side

_BITS = 1 << 15  # of what bitmap_construct_agg makes


def check_merge_keys(columns: Sequence[str], keys: Sequence[str]) -> None:
    if not keys:
        raise ValueError("a merge needs key columns")
    if not set(keys) <= set(columns):
        raise ValueError(f"key columns missing from the source: {sorted(set(keys) - set(columns))}")
    if set(keys) == set(columns):
        raise ValueError("no columns to update: all columns are keys")


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys…, n_rows)`` of keys that occur more than once. Rows with a null in the key match nothing."""
    return source.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def latest_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``; rows with a null in the key are all kept."""
    complete = source.na.drop(subset=list(keys))
    latest = complete.groupBy(*keys).agg(F.max_by(F.struct(*source.columns), F.struct(*order)).alias("r"))
    any_null = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 1
    return latest.select("r.*").unionByName(source.where(any_null))


def one_row_per_key(source: DataFrame, keys: Sequence[str], on_duplicate: str, order: Sequence[str]) -> DataFrame:
    """The source with its repeated keys resolved: an error, or the last row in ``order``.
    Only the keys are counted and moved; rows of keys that occur once stay where they are."""
    if on_duplicate not in ("error", "last"):
        raise ValueError(f"unknown on_duplicate: {on_duplicate}")
    repeated = pin(duplicate_keys(source, keys).select(*keys))
    if repeated.isEmpty():
        return source
    if on_duplicate == "error":
        raise ValueError(f"the source has several rows for one key {list(keys)}")
    repeated = small_side(repeated, pinned=True)
    several = source.join(repeated, list(keys), "left_semi")
    last = latest_per_key(several, keys, order or [c for c in source.columns if c not in keys])
    return source.join(repeated, list(keys), "left_anti").unionByName(last)


def _bit(bitmap: str) -> Column:
    """Whether the bit of the row's place is set; null without a bitmap."""
    place = F.col("_at.row_index") % _BITS
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def last_of_files(source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """As :func:`one_row_per_key` with ``last``, for rows that are read from files of one folder.

    A row is moved as two hashes and its place only. Of equal rows one stays, which is seen to before they are moved. Keys that have other rows still are resolved by
    their rows; all others stay where they are, and a bit per row, sent to all tasks, tells which. Rows are equal
    if 120 bits of a SHA-256 are."""
    complete = reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in keys])
    # Each value with its length in front, so that no two rows give the same text.
    value = lambda c: F.coalesce(F.concat(F.octet_length(as_text(source, c)).cast("string"), F.lit(":"), as_text(source, c)), F.lit("-"))
    same = F.sha2(F.concat(*map(value, source.columns)), 256).alias("_hash")
    at = F.struct(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_index")).alias("_at")
    places = source.where(complete).select(F.xxhash64(*keys).alias("_key"), same, at)
    a, b = hash_numbers(F.col("_hash"))
    places = places.select("_key", a.alias("_a"), b.alias("_b"), "_at")
    distinct = places.groupBy("_key", "_a", "_b").agg(F.min("_at").alias("_at"), F.count(F.lit(1)).alias("n")).select("_key", "_at", "n")
    several = F.count(F.lit(1)).over(Window.partitionBy("_key")) > 1
    bits = lambda where: F.bitmap_construct_agg(F.when(where, F.col("_at.row_index") % _BITS))
    block = lambda: [F.col("_at.file_name").alias("_file"), F.expr(f"_at.row_index div {_BITS}").alias("_block")]
    marks = distinct.withColumn("several", several).groupBy(*block()).agg(
        bits(~F.col("several")).alias("_stays"), bits(F.col("several")).alias("_open"),
        F.count_if("several").alias("n_open"), (F.sum("n") - F.count(F.lit(1))).alias("n_equal"),
    )
    marks = pin(marks)
    told = marks.agg(F.sum("n_open").alias("open"), F.sum("n_equal").alias("equal")).first()
    if not (told.open or told.equal):
        return source
    placed = source.select("*", at, complete.alias("_complete"))
    marked = placed.select("*", *block()).join(small_side(marks.select("_file", "_block", "_stays", "_open"), pinned=True), ["_file", "_block"], "left")
    found = marked.where(~F.col("_complete") | F.coalesce(_bit("_stays"), F.lit(False))).select(*source.columns)
    if not told.open:
        return found
    rest = marked.where(F.col("_complete") & _bit("_open")).select(*source.columns)
    return found.unionByName(latest_per_key(rest, keys, order or [c for c in source.columns if c not in keys]))


def _source_keys(source: DataFrame, keys: Sequence[str], few: bool | None) -> DataFrame:
    found = source.select(*keys).na.drop()
    if few is None:
        return small_side(found)
    return F.broadcast(found) if few else found


def without_keys(target: DataFrame, source: DataFrame, keys: Sequence[str], few: bool | None = None) -> DataFrame:
    """Target rows whose key is not in the source. ``few``: whether the source keys are few enough
    to be broadcast; None takes their size."""
    return target.join(_source_keys(source, keys, few), list(keys), "left_anti")


def with_keys(target: DataFrame, source: DataFrame, keys: Sequence[str], few: bool | None = None) -> DataFrame:
    """Target rows whose key is in the source."""
    return target.join(_source_keys(source, keys, few), list(keys), "left_semi")


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], on_duplicate: str = "error", order: Sequence[str] = ()
) -> DataFrame:
    """Target rows without a counterpart in the source, and all source rows.

    A source key that occurs twice is an error, or its last row in ``order`` wins
    (``on_duplicate="last"``). A null in a key matches nothing, so such a row is inserted.
    Columns are matched by name; a target column the source does not have stays as it is on a match.
    """
    check_merge_keys(source.columns, keys)
    source = one_row_per_key(source, keys, on_duplicate, order)
    source_keys = _source_keys(source, keys, None)
    kept = target.join(source_keys, list(keys), "left_anti")
    untouched = [c for c in target.columns if c not in source.columns]
    if untouched:
        # Only the rows to be updated take part in the second join.
        old = target.select(*keys, *untouched).join(source_keys, list(keys), "left_semi")
        source = source.join(old, list(keys), "left")
    return kept.unionByName(source.select(*target.columns))
