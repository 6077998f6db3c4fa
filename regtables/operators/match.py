"""Names against result rows, and children against parents."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from regtables.functions.text import strip
from regtables.operators.sizing import is_small, pin, size_of, small_side


def match_exact_first(
    rows: DataFrame, names: DataFrame, href_part: str = ".pdf", order: Sequence[str] | None = None
) -> DataFrame:
    """``(name, url)``: for each name the first such link of the first row with exactly that brand.

    ``rows`` has ``brand``, ``href``, ``url`` and the order columns, by default ``row_no`` and, if there is one,
    ``link_no``; links in the same place go by their url. ``names`` has ``name``.
    Rows are reduced to one per brand before the join, so a frequent brand does not weigh on it.
    """
    order = order or [c for c in ("row_no", "link_no") if c in rows.columns]
    best = (
        rows.where(F.col("href").contains(href_part))
        .groupBy(strip(F.col("brand")).alias("name"))
        .agg(F.min_by("url", F.struct(*order, "url")).alias("url"))
    )
    return best.join(small_side(names.select("name").distinct()), "name")


GRAM = 3


def first_name_per_text(texts: DataFrame, names: DataFrame, text: str) -> DataFrame:
    """``(text, name_no, name)``: the first of the names that the text contains; texts with none are left out.

    ``names`` is ``(name_no, name)``; empty names match nothing, of equal ones the first counts. Their size is taken
    first. Few names go to all tasks, where an Aho-Corasick automaton finds all of them in one pass over each
    distinct text. Many names are looked up by their rarest gram, see :func:`by_rarest_gram`.
    """
    known = pin(names.where("name <> ''").groupBy("name").agg(F.min("name_no").alias("name_no")).select("name_no", "name"))
    distinct_texts = texts.select(text).where(F.col(text).isNotNull()).distinct()
    if is_small(*size_of(known)):
        return by_automaton(distinct_texts, known, text)
    return by_rarest_gram(distinct_texts, known, text)


def by_automaton(texts: DataFrame, names: DataFrame, text: str) -> DataFrame:
    """For names that may be sent to every task."""
    ranked = names.orderBy("name_no", "name").collect()
    ordered = texts.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(ranked)], T.StructType([T.StructField("_rank", T.IntegerType()), *names.schema]))
    sent = texts.sparkSession.sparkContext.broadcast([r["name"] for r in ranked])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for rank, name in enumerate(sent.value):
            automaton.add_word(name, rank)
        if sent.value:
            automaton.make_automaton()
        for batch in batches:
            values = batch.column(0).to_pylist()
            first = [min((rank for _, rank in automaton.iter(v)), default=None) if sent.value else None for v in values]
            kept = [i for i, rank in enumerate(first) if rank is not None]
            yield pa.RecordBatch.from_arrays([pa.array([values[i] for i in kept], pa.string()), pa.array([first[i] for i in kept], pa.int32())], names=["text", "_rank"])

    found = texts.select(text).mapInArrow(find, "text string, _rank int")
    return found.join(F.broadcast(ordered), "_rank").select(F.col("text").alias(text), "name_no", "name")


def _grams(text: Column, n: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
    return F.filter(F.transform(starts, lambda i: F.substr(text, i, F.lit(n))), lambda p: F.length(p) == n)


def by_rarest_gram(texts: DataFrame, names: DataFrame, text: str) -> DataFrame:
    """For any number of names. Each is looked up by that of its grams of GRAM characters (or by all of it, if it is
    shorter) that the fewest texts have; texts that have it are compared. A name with a gram that no text has is
    not looked up at all. Nothing but grams and true candidates is moved; AQE splits grams that many texts have."""
    lengths = range(1, GRAM + 1)
    cut = texts.select(text, F.explode(F.array_distinct(F.flatten(F.array(*(_grams(F.col(text), n) for n in lengths))))).alias("gram"))
    frequency = cut.groupBy("gram").agg(F.count(F.lit(1)).alias("n_texts"))
    own = F.coalesce(*(F.when(F.length("name") <= n, _grams(F.col("name"), n)) for n in lengths[:-1]), _grams(F.col("name"), GRAM))
    of_names = names.select("name_no", "name", F.explode(F.array_distinct(own)).alias("gram")).join(frequency, "gram", "left")
    rarest = of_names.groupBy("name_no", "name").agg(F.min(F.struct(F.coalesce("n_texts", F.lit(0)).alias("n_texts"), "gram")).alias("g")).where("g.n_texts > 0")
    candidates = cut.join(rarest.select("name_no", "name", "g.gram"), "gram").where(F.col(text).contains(F.col("name")))
    return candidates.groupBy(text).agg(F.min(F.struct("name_no", "name")).alias("m")).select(text, "m.name_no", "m.name")


def match_contains_all(
    links: DataFrame, names: DataFrame, text_part: str = "審査報告書", order: Sequence[str] = ("row_no", "link_no")
) -> DataFrame:
    """``(url, name_no, name, order…)``: all links with that text in rows whose brand contains a name,
    each url once, under the first name that reaches it.

    ``links`` has ``brand``, ``text``, ``url`` and the order columns; ``names`` is ``(name_no, name)``.
    """
    wanted = links.where(F.col("text").contains(text_part)).withColumn("brand", strip(F.col("brand")))
    # The first place of each link per brand is enough, and it is combined before the shuffle.
    per_brand = wanted.groupBy("brand", "url").agg(F.min(F.struct(*order)).alias("place"))
    matched = per_brand.join(first_name_per_text(per_brand, names, "brand"), "brand")
    return (
        matched.groupBy("url")
        .agg(F.min(F.struct("name_no", "place", "name")).alias("m"))
        .select("url", "m.name_no", "m.name", *[F.col(f"m.place.{c}").alias(c) for c in order])
    )


def orphan_keys(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """``(child_key, n_rows)`` of the keys whose parent is missing. A null key has no parent."""
    counted = children.groupBy(child_key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(parents, counted[child_key] == parents[parent_key], "left_anti")


def orphan_rows(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """The child rows whose parent is missing."""
    return children.join(parents, children[child_key] == parents[parent_key], "left_anti")
