"""URL pieces as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from regtables.functions.binding import let


def url_file_name(url: Column) -> Column:
    """What follows the last slash."""
    return F.element_at(F.split(url, "/"), -1)


def url_suffix(url: Column) -> Column:
    """File suffix with its dot, ``''`` if there is none; query and fragment do not count."""
    return F.regexp_extract(F.regexp_replace(url_file_name(url), r"[?#].*$", ""), r"(\.[^.]+)$", 1)


def _without_dot_segments(path: Column) -> Column:
    """``/a/b/../c/./d`` becomes ``/a/c/d``."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == ".", done)
        .when(s == "..", F.when(F.size(done) > 1, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(done))
        .otherwise(F.concat(done, F.array(s))),
    )
    closing = F.when(F.element_at(segments, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.array_join(kept, "/"), closing)
    return F.when(path.contains("/."), joined).otherwise(path)


def base_parts(base: Column) -> Column:
    """What :func:`join_parts` needs of a page url, read once per page."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.regexp_replace(F.substr(page, F.length(site) + 1), r"[^/]*$", "")
    return F.struct(
        base.alias("base"), scheme.alias("scheme"), site.alias("site"), page.alias("page"),
        F.when(folder == "", "/").otherwise(folder).alias("folder"),
    )


def join_parts(parts: Column, href: Column) -> Column:
    """Absolute url of ``href`` on the page that ``parts`` were read from."""
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    tail = F.substr(href, F.length(path) + 1)
    full_path = F.when(href.startswith("/"), path).otherwise(F.concat(parts["folder"], path))
    return (
        F.when(href == "", parts["base"])
        .when(href.startswith("//"), F.concat(parts["scheme"], href))
        .when(href.startswith("?"), F.concat(parts["page"], href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(parts["base"], r"#.*$", ""), href))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .otherwise(F.concat(parts["site"], _without_dot_segments(full_path), tail))
    )


def url_join(base: Column, href: Column) -> Column:
    """Absolute url of ``href`` found on page ``base``."""
    return let(F.struct(base_parts(base).alias("parts"), href.alias("href")), lambda v: join_parts(v["parts"], v["href"]))
