"""Links and table rows out of known page shapes.

Pages are read with regular expressions inside the JVM, one page per row, so nothing is shuffled.
Comments, scripts and styles are cut first: they may hold markup in strings.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, functions as F

from regtables.functions.binding import let
from regtables.functions.text import strip
from regtables.functions.urls import base_parts, join_parts

_NOISE = r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>)"
# A tag ends at the first > outside quotes; a tag whose quotes don't pair ends at the first >.
_IN_TAG = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TAG = rf"<{_IN_TAG}>|<[^>]*>"
_REFERENCE = r"&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);|[^&]+|&"


def without_noise(html: Column) -> Column:
    return F.regexp_replace(html, _NOISE, "")


def _entities() -> Column:
    """Named character references of HTML, as a map."""
    named = {name.removesuffix(";"): text for name, text in html5.items() if name.endswith(";")}
    return F.from_json(F.lit(json.dumps(named)), "map<string,string>")


def unescape(text: Column) -> Column:
    """Character references replaced by their characters, each once: what a replacement gives is not read
    again. A reference to no character stays as it is written."""

    def numbered(ref: Column) -> Column:
        is_hex = F.lower(F.substr(ref, F.lit(3), F.lit(1))) == "x"
        digits = F.ltrim(F.rtrim(F.substr(ref, F.when(is_hex, 4).otherwise(3)), F.lit(";")), F.lit("0"))
        # No character has more than seven digits.
        short = F.when(F.length(digits).between(1, 7), digits)
        code = F.when(is_hex, F.conv(short, 16, 10)).otherwise(short).cast("bigint")
        is_char = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(is_char, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def decoded(piece: Column) -> Column:
        is_reference = piece.startswith("&") & piece.endswith(";")
        name = F.substr(piece, F.lit(2), F.length(piece) - 2)
        meant = F.when(piece.startswith("&#"), numbered(piece)).otherwise(F.try_element_at(_entities(), name))
        return F.when(is_reference, F.coalesce(meant, piece)).otherwise(piece)

    pieces = F.regexp_extract_all(text, F.lit(_REFERENCE), 0)
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, decoded), "")).otherwise(text)


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an opening tag; null if the tag does not have it."""
    written = F.regexp_extract(tag, rf"""(?is)^<\w+(?:\s+(?!{name}\s*=)[^\s=>"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+))?)*+\s+{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", 1)

    def value(w: Column) -> Column:
        quoted = w.startswith('"') | w.startswith("'")
        return F.when(quoted, unescape(F.substr(w, F.lit(2), F.length(w) - 2))).when(w != "", unescape(w))

    return let(written, value)


def inner_text(markup: Column) -> Column:
    """Text of the markup, every text node stripped, nodes joined without a separator."""
    return let(F.array_join(F.transform(F.split(markup, _TAG), strip), ""), unescape)


def _anchors(clean: Column, parts: Column) -> Column:
    # The text of an anchor ends where it is closed, or where the next one begins.
    opening_tag = rf"(?is)<a(?=[\s/>]){_IN_TAG}>"
    found = F.regexp_extract_all(clean, F.lit(rf"{opening_tag}(?:(?!</a\s*>|<a[\s/>]).)*+"), 0)

    def read(tag: Column, pos: Column) -> Column:
        opening = F.regexp_extract(tag, opening_tag, 0)
        named = F.struct(
            pos.alias("pos"),
            attribute(opening, "href").alias("href"),
            inner_text(F.substr(tag, F.length(opening) + 1)).alias("text"),
            attribute(opening, "class").alias("css_class"),
        )
        return let(
            named,
            lambda a: F.struct(a["pos"], a["href"], join_parts(parts, a["href"]).alias("url"), a["text"], a["css_class"]),
        )

    return F.filter(F.transform(found, read), lambda a: a["href"].isNotNull())


def anchors(html: Column, base: Column) -> Column:
    """All ``<a href>`` of a page as ``array<struct<pos, href, url, text, css_class>>``, in page order."""
    return let(base_parts(base), lambda parts: _anchors(without_noise(html), parts))


def _div_content(html: Column, div_id: str) -> Column:
    """Markup from the opening tag of ``<div id=…>`` to the ``</div>`` that closes it, or to the end;
    ``''`` without such a tag. The ends of inner divs are written as starts, which are not read."""
    opening = rf"""(?is)<div\b(?=[^>]*\sid\s*=\s*["']?{div_id}["'\s>])[^>]*>"""
    rest = F.get(F.split(html, opening, 2), F.lit(1))

    def inside(content: Column) -> Column:
        marks = F.regexp_extract_all(content, F.lit(r"(?i)</?div\b"), 0)
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("pieces"))

        def step(acc: Column, mark: Column) -> Column:
            change = F.when(mark.startswith("</"), -1).otherwise(1)
            is_open = acc["depth"] > 0
            return F.struct(
                F.when(is_open, acc["depth"] + change).otherwise(acc["depth"]).alias("depth"),
                F.when(is_open, acc["pieces"] + 1).otherwise(acc["pieces"]).alias("pieces"),
            )

        def cut(end: Column) -> Column:
            pieces = F.split(content, r"(?i)</?div\b")
            return F.array_join(F.slice(pieces, 1, end["pieces"] + F.when(end["depth"] > 0, 1).otherwise(0)), "<div")

        return let(F.aggregate(marks, start, step), cut)

    return F.coalesce(let(rest, inside), F.lit(""))


_IN_TABLE = r"(?i)<(/?)(?=(?:table|thead|tbody|tfoot|tr|td|th)\b)"


def _table_content(html: Column, opening: str) -> Column:
    """Markup from the first tag that matches ``opening`` to the ``</table>`` that closes it, or to the end; ``''``
    without such a tag. A fold over the tags of tables keeps their depth; in inner tables the tags that make rows and
    cells are renamed, so what they hold stays part of the cell around them."""
    rest = F.get(F.split(html, opening, 2), F.lit(1))

    def inside(content: Column) -> Column:
        # Each piece but the first begins with the tag of a table.
        pieces = F.split(content, r"(?i)(?=</?table\b)")
        start = F.struct(F.lit(1).alias("depth"), F.array().cast("array<string>").alias("kept"))

        def step(acc: Column, piece: Column) -> Column:
            change = F.when(piece.rlike(r"(?i)^</table\b"), -1).when(piece.rlike(r"(?i)^<table\b"), 1).otherwise(0)
            depth = F.when(acc["depth"] > 0, acc["depth"] + change).otherwise(0)
            own = F.when(depth > 1, F.regexp_replace(piece, _IN_TABLE, "<$1inner-")).otherwise(piece)
            return F.struct(depth.alias("depth"), F.when(depth > 0, F.concat(acc["kept"], F.array(own))).otherwise(acc["kept"]).alias("kept"))

        return F.aggregate(pieces, start, step, lambda acc: F.array_join(acc["kept"], ""))

    return F.coalesce(let(rest, inside), F.lit(""))


def result_rows(
    html: Column,
    base: Column,
    container_id: str = "ContentMainArea",
    table_class: str = "result_list_table",
    min_cells: int = 5,
) -> Column:
    """Rows of the first result table inside the container as
    ``array<struct<row_no, cells array<string>, links array<struct<…>>>>``.

    ``links`` are the anchors of the fifth cell. Rows with fewer than ``min_cells`` ``<td>`` are
    skipped; a page without the container or the table gives an empty array. Rows and cells are the table's own:
    a table inside a cell adds to that cell's text and links.
    """
    css = rf"""\sclass\s*=\s*(?:["'](?:[^"'>]*\s)?{table_class}(?:\s[^"'>]*)?["']|{table_class}[\s>])"""
    opening = rf"(?is)<table\b(?=[^>]*{css})[^>]*>"
    body_pattern = r"(?is)<tbody\b[^>]*>(.*?)</tbody\s*>"

    def rows(table: Column, parts: Column) -> Column:
        body = F.when(table.rlike(body_pattern), F.regexp_extract(table, body_pattern, 1)).otherwise(table)

        def read(row: Column, row_no: Column) -> Column:
            cells = F.regexp_extract_all(row, F.lit(rf"(?is)<td\b{_IN_TAG}>((?:(?!</td\s*>|<td\b|</tr\s*>).)*+)"), 1)
            return let(
                cells,
                lambda cs: F.struct(
                    row_no.alias("row_no"),
                    F.transform(cs, inner_text).alias("cells"),
                    _anchors(F.coalesce(F.get(cs, F.lit(4)), F.lit("")), parts).alias("links"),
                ),
            )

        found = F.regexp_extract_all(body, F.lit(rf"(?is)<tr\b{_IN_TAG}>((?:(?!</tr\s*>|<tr\b|</tbody\s*>).)*+)"), 1)
        return F.filter(F.transform(found, read), lambda r: F.size(r["cells"]) >= min_cells)

    table = let(_div_content(without_noise(html), container_id), lambda content: _table_content(content, opening))
    bound = F.struct(table.alias("table"), base_parts(base).alias("parts"))
    return F.coalesce(let(bound, lambda v: rows(v["table"], v["parts"])), F.array().cast(_ROWS_TYPE))


_ROWS_TYPE = (
    "array<struct<row_no:int,cells:array<string>,"
    "links:array<struct<pos:int,href:string,url:string,text:string,css_class:string>>>>"
)


# --- choosing links -----------------------------------------------------------------------------


def _first(links: Column, keep) -> Column:
    return F.get(F.filter(links, keep), F.lit(0))["url"]


def link_by_text(links: Column, text: str, exact: bool = False) -> Column:
    """Url of the first link whose text contains (or equals) ``text``; null if none does."""
    return _first(links, lambda a: (a["text"] == text) if exact else a["text"].contains(text))


def link_preferred(links: Column, href_part: str, css_class: str) -> Column:
    """Url of the first link of that class with ``href_part`` in its href, else of the first link with it."""
    has_class = lambda a: F.coalesce(F.array_contains(F.split(a["css_class"], r"\s+"), css_class), F.lit(False))
    return F.coalesce(
        _first(links, lambda a: a["href"].contains(href_part) & has_class(a)),
        _first(links, lambda a: a["href"].contains(href_part)),
    )


def _href_matches(part: str, suffix: str):
    return lambda a: F.lower(a["href"]).contains(part.lower()) & a["href"].endswith(suffix)


def link_by_href(links: Column, part: str, suffix: str) -> Column:
    """Url of the first link whose href contains ``part`` in any case and ends with ``suffix``."""
    return _first(links, _href_matches(part, suffix))


def all_links_by_href(links: Column, part: str = "", suffix: str = "") -> Column:
    """Urls of all such links, in page order."""
    return F.transform(F.filter(links, _href_matches(part, suffix)), lambda a: a["url"])
