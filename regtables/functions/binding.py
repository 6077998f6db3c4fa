"""Naming a value inside a Column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, with the value computed once however often the body uses it.
    For expressions too costly to repeat, such as a regular expression over a page."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
