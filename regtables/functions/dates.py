"""Dates written in Western or Japanese-era form."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The year before year 1 of each era.
ERA_BASE_YEAR = {
    "令和": 2018,
    "平成": 1988,
    "昭和": 1925,
    "大正": 1911,
    "明治": 1867,
}

_GAP = r"[\s　]*"
_WESTERN = (
    rf"^{_GAP}(\d{{4}}){_GAP}[-/.年]{_GAP}(\d{{1,2}}){_GAP}[-/.月]{_GAP}(\d{{1,2}}){_GAP}日?"
    rf"(?:[T ]\d{{1,2}}:\d{{2}}\S*)?{_GAP}$"
)
_COMPACT = rf"^{_GAP}(\d{{4}})(\d{{2}})(\d{{2}}){_GAP}$"
_ERA = (
    rf"^{_GAP}({'|'.join(ERA_BASE_YEAR)}){_GAP}(元|\d{{1,2}}){_GAP}年"
    rf"{_GAP}(\d{{1,2}}){_GAP}月{_GAP}(\d{{1,2}}){_GAP}日{_GAP}$"
)


def to_iso_date(text: Column) -> Column:
    """Date of a text such as ``2025-09-08``, ``2025/9/8``, ``2023.01.15``, ``20250908``,
    ``2025年9月8日`` or ``令和7年9月8日`` (``元年`` is year 1); null for anything else.

    Pass a column, not a long expression: the text is looked at several times.
    """
    # The cast takes yyyy-[m]m-[d]d and gives null, without an exception, for a day that does not exist.
    western = F.regexp_replace(text, _WESTERN, "$1-$2-$3")
    compact = F.regexp_replace(text, _COMPACT, "$1-$2-$3")
    eras = F.create_map(*[F.lit(v) for item in ERA_BASE_YEAR.items() for v in item])
    year = eras[F.regexp_extract(text, _ERA, 1)] + F.replace(F.regexp_extract(text, _ERA, 2), F.lit("元"), F.lit("1")).cast("int")
    era = F.concat_ws("-", year.cast("string"), F.regexp_extract(text, _ERA, 3), F.regexp_extract(text, _ERA, 4))
    return (
        F.when(text.rlike(_WESTERN), western.try_cast("date"))
        .when(text.rlike(_COMPACT), compact.try_cast("date"))
        .when(text.rlike(_ERA), era.try_cast("date"))
    )


def display_timestamp(value: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a timestamp or of ISO text, in the offset it is written in.
    Text that is no timestamp is passed through; null and empty give ``''``."""
    text = value.cast("string")
    wall_time = F.regexp_replace(text, r"^(.*\d:\d{2}.*?)(?:Z|[+-]\d{2}(?::?\d{2})?)$", "$1")
    shown = F.substr(wall_time.try_cast("timestamp_ntz").cast("string"), F.lit(1), F.lit(19))
    return F.coalesce(shown, text, F.lit(""))
