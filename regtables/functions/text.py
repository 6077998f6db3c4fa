"""Fields and sections out of document text."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The characters that count as blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Text without blanks at both ends, U+3000 included."""
    return F.btrim(text, F.lit(BLANKS))


def remove_whitespace(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def _literal(text: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", text)


def label_value(text: Column, label: str) -> Column:
    """What follows ``label: `` on the first line that starts with it; null if no line does."""
    # (?d): only \n ends a line.
    pattern = rf"(?md)^{_literal(label)}: (.*)$"
    # Most texts without the label are told by a plain search.
    found = text.contains(f"{label}: ") & text.rlike(pattern)
    return F.when(found, strip(F.regexp_extract(text, pattern, 1)))


def _heading_line(heading: str) -> str:
    return rf"(?sdU){_literal(heading)}\s*\n"


_NUMBERED_LINE = r"(?dU)\n\s*\d+\."


def has_heading(text: Column, heading: str) -> Column:
    return text.contains(heading) & text.rlike(_heading_line(heading))


def after_heading(text: Column, heading: str) -> Column:
    """What follows the first heading line; null if there is none."""
    return F.when(has_heading(text, heading), F.split(text, _heading_line(heading), 2)[1])


def has_numbered_line(text: Column) -> Column:
    return text.rlike(_NUMBERED_LINE)


def up_to_numbered_line(text: Column) -> Column:
    return F.split(text, _NUMBERED_LINE, 2)[0]


def section_text(text: Column, heading: str) -> Column:
    """Text after the heading line, up to the next line that starts with a number and a dot,
    or to the end; null if the heading is not there."""
    return strip(up_to_numbered_line(after_heading(text, heading)))
