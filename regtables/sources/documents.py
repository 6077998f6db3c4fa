"""Documents from their pages, and web pages into rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from regtables.functions.html import anchors, result_rows
from regtables.functions.records import combined_hash, hash_parts, raw_json
from regtables.functions.text import after_heading, has_heading, has_numbered_line, strip, up_to_numbered_line


def _has_value(cell: Column) -> Column:
    return cell.isNotNull() & (cell != "")


def table_records(table: Column) -> Column:
    """A table (array of rows) as an array of maps: the first row names the cells.
    Of several columns with one name the last counts."""
    names = F.transform(F.get(table, F.lit(0)), lambda h: F.coalesce(h, F.lit("null")))

    def record(row: Column) -> Column:
        entries = F.transform(names, lambda n, i: F.struct(n.alias("key"), F.get(row, i).alias("value"), i.alias("at")))
        last = F.filter(entries, lambda e: ~F.array_contains(F.slice(names, e["at"] + 2, F.size(names)), e["key"]))
        return F.map_from_arrays(F.transform(last, lambda e: e["key"]), F.transform(last, lambda e: e["value"]))

    return F.transform(F.slice(table, 2, F.greatest(F.size(table) - 1, F.lit(0))), record)


def assemble_documents(
    pages: DataFrame, doc: str = "doc", page_no: str = "page_no", text: str = "text", tables: str = "tables"
) -> DataFrame:
    """``(doc, full_text, tables)``: page texts joined by newline in page order, empty pages skipped; tables
    whose first row has a value, as records. ``tables`` is an array of tables per page.

    This gathers the pages of a document in one row, 2 GB at most. The datasets don't need it: they keep pages
    as rows, see :func:`document_marks` and :func:`page_section`.
    """
    item = F.struct(F.col(page_no).alias("page_no"), F.col(text).alias("text"), F.col(tables).alias("tables"))
    gathered = pages.groupBy(doc).agg(F.sort_array(F.collect_list(item)).alias("_pages"))
    texts = F.transform(F.filter("_pages", lambda p: _has_value(p["text"])), lambda p: p["text"])
    all_tables = F.flatten(F.transform("_pages", lambda p: F.coalesce(p["tables"], F.array().cast("array<array<array<string>>>"))))
    kept = F.filter(all_tables, _has_header)
    return gathered.select(doc, F.array_join(texts, "\n").alias("full_text"), F.transform(kept, table_records).alias("tables"))


def _has_header(table: Column) -> Column:
    return F.exists(F.coalesce(F.get(table, F.lit(0)), F.array().cast("array<string>")), _has_value)


def document_marks(
    pages: DataFrame, fields: Mapping[str, Column], doc: str = "doc", page_no: str = "page_no", text: str = "text", tables: str = "tables"
) -> DataFrame:
    """One row per document: ``n_pages``, ``has_text``, ``has_tables``, each of ``fields`` (an expression over a
    page) from the first page on which it is not null, and the content hash over all pages. Everything is
    combined before the shuffle; no page is moved."""
    place = F.col(page_no)
    page = raw_json([place.alias("page_no"), F.col(text).alias("text"), F.col(tables).alias("tables")])
    found = pages.groupBy(doc).agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.bool_or(F.coalesce(_has_value(F.col(text)), F.lit(False))).alias("has_text"),
        F.bool_or(F.coalesce(F.exists(F.col(tables), _has_header), F.lit(False))).alias("has_tables"),
        *[F.min_by(value, F.when(value.isNotNull(), place)).alias(name) for name, value in fields.items()],
        *hash_parts(page),
    )
    return found.withColumn("_meta_source_content_hash", combined_hash(F.col("n_pages"))).drop("_hash_a", "_hash_b")


def page_section(pages: DataFrame, heading: str, name: str, doc: str = "doc", page_no: str = "page_no", text: str = "text") -> DataFrame:
    """``(doc, name)``: the text after the heading line, over page breaks, up to the next line that starts with a
    number and a dot, or to the end of the document. Documents without the heading, or with nothing after it,
    are left out. Only the section's own pages are brought together."""
    framed = F.concat(F.lit("\n"), F.col(text), F.lit("\n"))  # what stands around a page in the whole text
    some = pages.where(_has_value(F.col(text))).select(doc, F.col(page_no).alias("_page"), framed.alias("_text"))
    opening = some.groupBy(doc).agg(F.min(F.when(has_heading(F.col("_text"), heading), F.col("_page"))).alias("_first")).where("_first IS NOT NULL")
    rest = some.join(opening, doc).where("_page >= _first")
    rest = rest.withColumn("_rest", F.when(F.col("_page") == F.col("_first"), after_heading(F.col("_text"), heading)).otherwise(F.col("_text")))
    closing = rest.groupBy(doc).agg(F.min(F.when(has_numbered_line(F.col("_rest")), F.col("_page"))).alias("_last"))
    own = rest.join(closing, doc).where("_last IS NULL OR _page <= _last")
    piece = F.regexp_replace(up_to_numbered_line(F.col("_rest")), r"\A\n|\n\z", "")
    gathered = own.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct("_page", piece.alias("piece")))).alias("_pieces"))
    whole = strip(F.array_join(F.transform("_pieces", lambda p: p["piece"]), "\n"))
    return gathered.select(doc, whole.alias(name)).where(F.col(name) != "")


def page_links(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """One row per ``<a href>``: the other columns of the page and ``(pos, href, link_url, link_text)``."""
    others = [c for c in pages.columns if c != html]
    found = pages.select(*others, F.explode(anchors(F.col(html), F.col(url))).alias("a"))
    return found.select(
        *others, "a.pos", "a.href", F.col("a.url").alias("link_url"), F.col("a.text").alias("link_text")
    )


def page_table_rows(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """One row per result-table row: the other columns of the page and ``(row_no, cells, links)``."""
    others = [c for c in pages.columns if c != html]
    found = pages.select(*others, F.explode(result_rows(F.col(html), F.col(url))).alias("r"))
    return found.select(*others, "r.row_no", "r.cells", "r.links")
