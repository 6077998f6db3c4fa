"""XML files read by several tasks each.

A file is cut into byte ranges. A first pass looks at the tags that begin in each range and tells what the range does to
the stack of open elements: which it closes that were open before, and which it leaves open. These effects are
composed in order, a row per range, which gives the stack at the start of each range and finds elements closed
by another name or not at all. A second pass reads, in each range, the nodes that begin there and whose ancestors are
the path asked for; the last one may reach into the ranges behind. So no task holds a file, only a node. Files of one
range need the second pass only.

A range may begin inside a comment, a CDATA section or another markup that may hold tags. Its predecessor tells where
that ends, and the range is looked at once more from there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from regtables.sources.ranges import RANGE_BYTES, byte_ranges, file_system

_MORE = 1 << 16  # bytes read at a time behind a range's end
_OTHER_MARKUP = [
    (b"<!--", re.compile(rb"<!--.*?-->", re.S)),
    (b"<![CDATA[", re.compile(rb"<!\[CDATA\[.*?\]\]>", re.S)),
    (b"<?", re.compile(rb"<\?.*?\?>", re.S)),
    (b"<!", re.compile(rb"<![^\[>]*(?:\[.*?\]\s*)?>", re.S)),
]
_TAG = re.compile(rb"""<(/?)([^\s/>!?<"'=]+)((?:[^<>"']|"[^<"]*"|'[^<']*')*)>""")
_EFFECT = "path string, start bigint, closes array<string>, opens array<string>, resume bigint, problem string"
_RANGE = "path string, start bigint, end bigint, length bigint, stack array<string>, is_checked boolean"


class MalformedXml(ValueError):
    pass


class _Tags:
    """Markup of a file from byte ``start`` on. What lies behind ``end`` is read when it is come to."""

    def __init__(self, path: str, start: int, end: int):
        system, name = file_system(path)
        self.path, self.start = path, start
        self.file = system.open_input_file(name)
        self.file.seek(start)
        self.data = bytearray(self.file.read(max(0, end - start)))

    def _more(self) -> bool:
        found = self.file.read(max(_MORE, len(self.data) // 4))
        self.data += found
        return bool(found)

    def _match(self, pattern: re.Pattern, at: int) -> re.Match:
        found = pattern.match(self.data, at)
        while found is None:
            if not self._more():
                raise MalformedXml(f"malformed XML in {self.path}: markup at byte {self.start + at} is not one tag")
            found = pattern.match(self.data, at)
        return found

    def __iter__(self) -> Iterator[tuple[int, int, bytes, str]]:
        """Where each begins and ends in the file, its kind (``open``, ``close``, ``both``, ``other``) and name."""
        at = 0
        while True:
            found = self.data.find(b"<", at)
            if found < 0:
                at = len(self.data)
                if not self._more():
                    return
                continue
            at = found
            while len(self.data) < at + 9 and self._more():
                pass
            other = next((p for b, p in _OTHER_MARKUP if self.data.startswith(b, at)), None)
            tag = self._match(other or _TAG, at)
            if other:
                yield self.start + at, self.start + tag.end(), "other", ""
            else:
                kind = "close" if tag[1] else "both" if tag[3].endswith(b"/") else "open"
                yield self.start + at, self.start + tag.end(), kind, tag[2].decode()
            at = tag.end()


def _closed(stack: list[str], name: str, path: str) -> None:
    if stack.pop() != name:
        raise MalformedXml(f"malformed XML in {path}: </{name}> closes another element")


def effect(path: str, start: int, end: int) -> tuple[list[str], list[str], int]:
    """Of the tags that begin in a range: elements closed that were open before, in order; elements left open; and
    where the markup that begins in the range ends, if that is behind it."""
    closes, opens, resume = [], [], end
    for begin, stop, kind, name in _Tags(path, start, end):
        if begin >= end:
            break
        if kind == "other":
            resume = max(resume, stop)
        elif kind == "open":
            opens.append(name)
        elif kind == "close":
            if opens:
                _closed(opens, name, path)
            else:
                closes.append(name)
    return closes, opens, resume


def nodes(path: str, start: int, end: int, stack: list[str], steps: Sequence[str]) -> Iterator[tuple[int, str]]:
    """Place and markup of the nodes at ``steps`` below the root that begin in a range. ``stack`` is left as it is
    behind the last tag that was read."""
    tags, node = _Tags(path, start, end), None
    for begin, stop, kind, name in tags:
        if node is None and begin >= end:
            return
        at_place = len(stack) == len(steps) and stack[1:] == list(steps[:-1])
        if kind in ("open", "both") and node is None and at_place and name == steps[-1]:
            node = begin
        if kind == "open":
            stack.append(name)
        elif kind == "close":
            if not stack:
                raise MalformedXml(f"malformed XML in {path}: </{name}> closes nothing")
            _closed(stack, name, path)
        if node is not None and len(stack) == len(steps) and kind in ("close", "both"):
            yield node, tags.data[node - tags.start : stop - tags.start].decode()
            node = None


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("closes", pa.list_(pa.string())), ("opens", pa.list_(pa.string())), ("resume", pa.int64()), ("problem", pa.string())])
    for batch in batches:
        for r in batch.to_pylist():
            row = {"path": r["path"], "start": r["start"]}
            try:
                row["closes"], row["opens"], row["resume"] = effect(r["path"], r["begin"], r["end"])
            except MalformedXml as problem:  # which it may not be, if the range begins in a comment
                row["problem"] = str(problem)
            yield pa.RecordBatch.from_pylist([row], schema=schema)


def _with_stacks(ranges: DataFrame) -> DataFrame:
    """Ranges of files that have several, with the stack of open elements at their start. They begin where markup
    that holds tags has ended; ranges inside of it are left out."""
    spark = ranges.sparkSession
    known: dict[str, list] = {}  # a row per range
    for r in ranges.orderBy("path", "start").collect():
        known.setdefault(r.path, []).append([r.start, r.start, r.end, r.length])
    found: dict[tuple[str, int], tuple] = {}
    todo = [(path, begin, end, start) for path, own in known.items() for start, begin, end, _ in own]
    while todo:
        again = spark.createDataFrame(todo, "path string, begin bigint, end bigint, start bigint").repartition(len(todo))
        for r in again.mapInArrow(_effects, _EFFECT).collect():
            found[r.path, r.start] = r
        todo = []
        for path, own in known.items():
            resume = 0
            for k, (start, begin, end, _) in enumerate(own):
                right = max(start, resume)
                if right != begin:
                    own[k][1] = right
                    if right < end:
                        todo.append((path, right, end, start))
                        break  # what comes after is not known before
                if right < end:
                    result = found[path, start]
                    if result.problem:
                        raise MalformedXml(result.problem)
                    resume = result.resume
    rows = []
    for path, own in known.items():
        stack: list[str] = []
        for start, begin, end, length in own:
            if begin >= end:
                continue
            rows.append((path, begin, end, length, list(stack), True))
            result = found[path, start]
            for name in result.closes:
                if not stack:
                    raise MalformedXml(f"malformed XML in {path}: </{name}> closes nothing")
                _closed(stack, name, path)
            stack += result.opens
        if stack:
            raise MalformedXml(f"malformed XML in {path}: <{stack[-1]}> is not closed")
    return spark.createDataFrame(rows, _RANGE)


def _nodes(steps: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("place", pa.int64()), ("node", pa.string())])
        for batch in batches:
            for r in batch.to_pylist():
                stack, held, size = list(r["stack"]), [], 0
                for place, node in nodes(r["path"], r["start"], r["end"], stack, steps):
                    held.append({"path": r["path"], "place": place, "node": node})
                    size += len(node)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if stack and not r["is_checked"]:
                    raise MalformedXml(f"malformed XML in {r['path']}: <{stack[-1]}> is not closed")
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    return run


def xml_node_texts(spark: SparkSession, path: str, steps: Sequence[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(path, place, node)``: the markup of each node at ``steps`` below the root, and the byte it begins at."""
    ranges = byte_ranges(spark, path, size=range_bytes)
    single = ranges.where(F.col("length") <= range_bytes).select("path", "start", "end", "length", F.array().cast("array<string>").alias("stack"), F.lit(False).alias("is_checked"))
    several = ranges.where(F.col("length") > range_bytes)
    rows = single
    if not several.isEmpty():
        stacked = _with_stacks(several)
        rows = single.unionByName(stacked.repartition(max(1, stacked.count()), "path", "start"))
    return rows.mapInArrow(_nodes(list(steps)), "path string, place bigint, node string")
