"""Record text, hashes and lenient numbers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

_KEEP_NULLS = {"ignoreNullFields": "false"}


def raw_json(columns: Iterable[str | Column]) -> Column:
    """The record as one JSON object; nulls and non-ASCII text are kept."""
    return F.to_json(F.struct(*columns), _KEEP_NULLS)


def raw_json_of_file(columns: Iterable[str | Column], file_name: Column) -> Column:
    """The record as JSON together with the name of the file it came from."""
    return raw_json([F.coalesce(file_name, F.lit("")).alias("source_file_name"), F.struct(*columns).alias("original_values")])


def json_array(structs: Column) -> Column:
    """An array of structs as a JSON array; nulls are kept."""
    return F.to_json(structs, _KEEP_NULLS)


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def hash_numbers(hash: Column) -> list[Column]:
    """Two parts of a hash as numbers of 60 bits."""
    return [F.conv(F.substring(hash, at, 15), 16, 10).cast("bigint") for at in (1, 16)]


def hash_sums(a: Column, b: Column) -> list[Column]:
    """Aggregates behind :func:`combined_hash`, of the rows' :func:`hash_numbers`. The halves of a number are summed up
    apart, as bigint, which costs a fraction of a sum of decimals and holds for 2^33 rows. Sums are combined before
    a shuffle, and any order of the rows gives the same."""
    half = F.lit(1 << 30)
    high = lambda n: F.sum(F.shiftright(n, 30)).cast("decimal(19,0)") * half.cast("decimal(10,0)")
    low = lambda n: F.sum(n.bitwiseAND(half - 1)).cast("decimal(19,0)")
    return [(high(a) + low(a)).alias("_hash_a"), (high(b) + low(b)).alias("_hash_b")]


def hash_parts(json: Column) -> list[Column]:
    """:func:`hash_sums` over the hashes of the rows' JSON."""
    return hash_sums(*hash_numbers(F.sha2(json, 256)))


def combined_hash(n_rows: Column) -> Column:
    """Hash of a set of rows, from their number and the sums of :func:`hash_parts`."""
    return F.sha2(F.concat_ws(":", n_rows.cast("string"), F.col("_hash_a").cast("string"), F.col("_hash_b").cast("string")), 256)


def document_id(url: Column) -> Column:
    """Id of a document: the hash of where it came from."""
    return F.sha2(url, 256)


def row_hash_id(columns: Iterable[str]) -> Column:
    """Id of a row: the hash of its values as JSON, columns in name order.
    The order of the columns in the table does not matter; equal rows share an id."""
    return F.sha2(raw_json([F.col(f"`{c}`").cast("string").alias(c) for c in sorted(columns)]), 256)


def lenient_number(text: Column) -> Column:
    """Double of a number as text; null for anything else (NaN included)."""
    text = text.cast("string")
    value = F.when(~text.rlike(r"[dDfF]\s*$"), text.try_cast("double"))
    return F.when(~F.isnan(value), value)


def lenient_int(text: Column) -> Column:
    """Whole number as bigint, ``12.0`` included; null for anything else."""
    number = lenient_number(text)
    return F.coalesce(
        text.cast("string").try_cast("bigint"),
        F.when(number == F.floor(number), number.try_cast("bigint")),
    )


def document_payload(full_text: Column, tables: Column, file_type: str = "pdf") -> Column:
    """Document text and tables as one JSON object."""
    return raw_json(
        [F.lit(file_type).alias("source_file_type"), full_text.alias("full_text"), tables.alias("extracted_tables")]
    )
