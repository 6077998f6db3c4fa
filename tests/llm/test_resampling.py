"""Importance resampling against a plain computation over all words."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest

from regtables.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def runs(text, n):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def wanted(docs, target, n, buckets, percent=10, least=20):
    s = Counter(crc32(f.encode()) % buckets for _, x in docs for f in runs(x, n))
    t = Counter(crc32(f.encode()) % buckets for x in target for f in runs(x, n))
    s_all, t_all = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for i, x in docs:
        own = runs(x, n)
        weight = sum(gain[crc32(f.encode()) % buckets] for f in own)
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words(x)), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    long = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0]))
    rest = [r for r in rows if r[1] < least]
    drawn = percent * len(long) // 100
    return [(*r, k + 1 if k < drawn else None) for k, r in enumerate(long)] + [(*r, None) for r in rest]


def documents():
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "été", "日本", "x1", "and", "the"]
    line = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 9, 30])))
    docs = [(i, "\n".join(["the common line, of all", *(line() for _ in range(rng.choice([0, 1, 5])))])) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, "\n\n ?!\n"), (1003, "One\nword\na\nline\n" * 40), (1004, "AND the " * 30_000)]
    docs += [(None, "no id " * 12)] + [(7000, "repeated row " * 15)] * 3 + [(7001, "repeated row " * 15), (7000, "other text")]
    return docs


def result(spark, docs, target, **settings):
    d = spark.createDataFrame([(i, x, "w", 1, b"k") for i, x in docs], "doc_id long, text string, weight string, n int, segment_key binary").repartition(5)
    return resampling.resampled(d, spark.createDataFrame([(x,) for x in target], "text string"), **settings)


@pytest.mark.parametrize("n, buckets, percent", [(1, 10_000, 10), (3, 997, 50), (2, 1, 100)])
def test_as_counted_plainly(spark, n, buckets, percent):
    docs, target = documents(), ["The alpha été", None, "beta\nx1 the\nand", ""]
    got = [tuple(r) for r in result(spark, docs, target, n=n, buckets=buckets, percent=percent).collect()]
    want = wanted(docs, target, n, buckets, percent)
    # Equal rows tie: they share their ranks in any order, as do all rows of an id and score.
    assert sorted(got, key=str) == sorted(want, key=str)


def test_few_heavy_segments(spark, monkeypatch):
    monkeypatch.setattr(resampling, "HEAVY", 3)
    docs = documents()
    got = [tuple(r) for r in result(spark, docs, ["alpha beta"]).collect()]
    assert sorted(got, key=str) == sorted(wanted(docs, ["alpha beta"], 1, 10_000), key=str)


def test_nothing(spark):
    got = result(spark, [], ["a b"])
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"] and got.count() == 0
    docs = [(1, "a b " * 20), (2, None)]
    assert sorted(map(tuple, result(spark, docs, [], percent=100).collect())) == sorted(wanted(docs, [], 1, 10_000, 100))


def test_runs_across_lines():
    rng = random.Random(1)
    for _ in range(300):
        text = "\n".join(" ".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 2, 5]))) for _ in range(6))
        for n in (1, 2, 3, 5):
            segments = resampling.segments_of(text.encode())
            own = [r for s in segments for r in resampling.runs_of(s, n)]
            assert Counter(own + list(resampling.crossing_runs(segments, n))) == Counter(r.encode() for r in runs(text, n))
