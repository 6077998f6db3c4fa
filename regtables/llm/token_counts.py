"""Token counts that follow edits.

A document is cut into leaves of about ``LEAF_CHARS`` characters, each cut at a space after another character,
where every byte-level pre-tokenizer ends a piece; so leaves have their own token counts, and a tree over them
has the sums of characters and tokens. An edit finds its leaves by descending, takes in a neighbour for as long
as a border it touched is no longer such a place, encodes these characters only, and updates the sums above.

The store has a row per document: doc_id, text, leaf_chars, leaf_tokens. Edits are (start, length,
replacement), applied in order, each on the text as the one before left it; starts and lengths beyond the text
are drawn in. Null texts and replacements count as empty; a null start is 0, a null length 0. Rows that repeat
are documents of their own, edits of a doc_id go to each of its rows, edits without a document are ignored, and
an empty table gives no rows. A document's edits are worked off in one row; documents are independent."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from regtables.llm.common import slices, texts_of, work_folder, written
from regtables.llm.tokens import BYTE_BPE, encoder

LEAF_CHARS = 512

_STORE = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("leaf_chars", pa.list_(pa.int32())), ("leaf_tokens", pa.list_(pa.int32()))])
_STORE_DDL = "doc_id bigint, text string, leaf_chars array<int>, leaf_tokens array<int>"
EDITS_TYPE = "array<struct<start:bigint,length:bigint,replacement:string>>"
_COUNTS = pa.schema([("tokens_before", pa.int64()), ("n_tokens", pa.int64()), ("n_edits", pa.int64()), ("encoded_chars", pa.int64())])
_EDITED = pa.schema([*_STORE, *_COUNTS])
_EDITED_DDL = f"{_STORE_DDL}, tokens_before bigint, n_tokens bigint, n_edits bigint, encoded_chars bigint"


def _is_border(text: str, at: int) -> bool:
    """A piece ends before ``at`` whatever else the text holds."""
    return at in (0, len(text)) or (text[at] == " " and not text[at - 1].isspace())


def leaves_of(text: str, size: int = LEAF_CHARS) -> list[str]:
    found, start = [], 0
    while start < len(text):
        end = start + size
        while end < len(text) and not _is_border(text, end):
            end = text.find(" ", end + 1)
            if end < 0:
                end = len(text)
        found.append(text[start:end])
        start = end
    return found


class Tree:
    """Sums of characters and tokens over leaves, as a complete binary tree in two arrays."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.set_leaves(chars, tokens)

    def set_leaves(self, chars: list[int], tokens: list[int]) -> None:
        self.n = len(chars)
        self.width = 1 << max(0, (max(1, self.n) - 1).bit_length())
        self.sums = np.zeros((2, 2 * self.width), np.int64)
        self.sums[:, self.width : self.width + self.n] = [chars, tokens]
        low = self.width
        while low > 1:
            self.sums[:, low // 2 : low] = self.sums[:, low : 2 * low : 2] + self.sums[:, low + 1 : 2 * low : 2]
            low //= 2

    def update(self, leaf: int, chars: int, tokens: int) -> None:
        at = self.width + leaf
        change = np.array([chars, tokens]) - self.sums[:, at]
        while at:
            self.sums[:, at] += change
            at //= 2

    def find(self, char: int) -> tuple[int, int]:
        """The leaf that has character ``char`` (the last leaf, if none has), and where that leaf begins."""
        at, before = 1, 0
        while at < self.width:
            left = int(self.sums[0, 2 * at])
            at *= 2
            if char >= before + left and before + left < self.sums[0, 1]:
                before += left
                at += 1
        leaf = at - self.width
        return min(leaf, max(0, self.n - 1)), before

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        own = self.sums[:, self.width : self.width + self.n]
        return own[0], own[1]

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])


def apply_edit(tree: Tree, text: str, start: int, length: int, replacement: str, count, size: int = LEAF_CHARS) -> tuple[str, int]:
    """The new text, and how many characters were encoded. count: token counts of a list of texts."""
    start = min(max(0, start), len(text))
    stop = min(max(start, start + length), len(text))
    edited = text[:start] + replacement + text[stop:]
    shift = len(edited) - len(text)
    chars = tree.leaves()[0]
    first, low = tree.find(start)
    last, last_low = tree.find(stop)
    high = last_low + (int(chars[last]) if len(chars) else 0)
    while first > 0 and (low >= start or chars[first] == 0) and not (low < start and _is_border(edited, low)):
        first -= 1
        low -= int(chars[first])
    while last + 1 < len(chars) and (high <= stop or not _is_border(edited, high + shift)):
        last += 1
        high += int(chars[last])
    region = edited[low : high + shift]
    parts = leaves_of(region, size)
    counts = count(parts)
    touched = last - first + 1 if len(chars) else 0
    if len(parts) <= touched:
        for k in range(touched):
            if k < len(parts):
                tree.update(first + k, len(parts[k]), counts[k])
            else:
                tree.update(first + k, 0, 0)
    else:
        old_chars, old_tokens = (x.tolist() for x in tree.leaves())
        tree.set_leaves([*old_chars[:first], *map(len, parts), *old_chars[first + touched :]], [*old_tokens[:first], *counts, *old_tokens[first + touched :]])
    return edited, len(region)


def _counter(tokenizer: str):
    return lambda parts: encoder(tokenizer).encode_all(parts)[1].tolist()


def _build(tokenizer: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer)
        for batch in slices(batches):
            texts = texts_of(batch)
            leaves = [leaves_of(t, size) for t in texts]
            flat = iter(count([x for own in leaves for x in own]))
            tokens = [[next(flat) for _ in own] for own in leaves]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts), pa.array([list(map(len, own)) for own in leaves], pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32()))], schema=_STORE)

    return run


def _edit(tokenizer: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer)
        for batch in slices(batches):
            rows = []
            for r in batch.to_pylist():
                tree, text, encoded = Tree(r["leaf_chars"], r["leaf_tokens"]), r["text"], 0
                before, edits = tree.n_tokens, r["edits"] or []
                for e in edits:
                    text, n = apply_edit(tree, text, e["start"] or 0, e["length"] or 0, e["replacement"] or "", count, size)
                    encoded += n
                chars, tokens = tree.leaves()
                there = chars > 0
                rows.append((r["doc_id"], text, chars[there].tolist(), tokens[there].tolist(), before, tree.n_tokens, len(edits), encoded))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _EDITED, strict=True)], schema=_EDITED)

    return run


def build_store(docs: DataFrame, folder: str, tokenizer: str = BYTE_BPE, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """Writes the store for ``docs`` (doc_id, text) to ``folder`` and gives it as a table. Nothing is shuffled."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    return written(rows.mapInArrow(_build(tokenizer, leaf_chars), _STORE_DDL), folder, compression="zstd")


def with_edits(store: DataFrame, edits: DataFrame) -> DataFrame:
    """The store with the edits (doc_id, edit_no, start, length, replacement) of each document, in order."""
    edit = F.struct("edit_no", F.col("start").cast("bigint").alias("start"), F.col("length").cast("bigint").alias("length"), "replacement")
    by_doc = edits.where("doc_id is not null").groupBy("doc_id").agg(F.sort_array(F.collect_list(edit)).alias("edits"))
    by_doc = by_doc.withColumn("edits", F.transform("edits", lambda e: F.struct(e["start"].alias("start"), e["length"].alias("length"), e["replacement"].alias("replacement"))))
    return store.join(by_doc, "doc_id", "left")


def edited(store: DataFrame, tokenizer: str = BYTE_BPE, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """store: a store with a column ``edits``. The new store with tokens_before, n_tokens, n_edits, and
    encoded_chars, the characters that had to be encoded."""
    rows = store.select(*_STORE.names, F.col("edits").cast(EDITS_TYPE).alias("edits"))
    return rows.mapInArrow(_edit(tokenizer, leaf_chars), _EDITED_DDL)


def revision(text, doc_id, n: int = 3):
    """Edits that a document's own text and id give: ``n`` stretches replaced by others of the same text."""
    size = F.length(text)

    def edit(k: int):
        place = lambda what, of: F.pmod(F.xxhash64(doc_id, F.lit(f"{what} {k}")), F.greatest(of, F.lit(1)).cast("bigint"))
        taken = F.substring(text, (place("from", size) + 1).cast("int"), place("size", F.lit(40)).cast("int"))
        return F.struct(place("start", size).alias("start"), place("length", F.lit(30)).alias("length"), taken.alias("replacement"))

    return F.array(*(edit(k) for k in range(n)))


def revised_counts(docs: DataFrame) -> DataFrame:
    """Every document edited by its ``revision``: doc_id, n_edits, tokens_before, n_tokens, encoded_chars,
    n_chars, text_sha256."""
    store = build_store(docs, work_folder(docs.sparkSession, "counts"))
    found = edited(store.withColumn("edits", revision(F.col("text"), F.col("doc_id"))))
    return found.select("doc_id", "n_edits", "tokens_before", "n_tokens", "encoded_chars", F.length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))
