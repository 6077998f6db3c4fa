"""Benchmark passages against a search that tries every place."""

import hashlib
import random
import re

import numpy as np
import pytest

from regtables.llm import decontaminate, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return (text or "").encode().lower().decode()


def brute(docs, items, window=10):
    found = []
    for doc_id, text in docs:
        w = WORD.findall(lowered(text))
        hit, got = set(), set()
        for item_id, item in items:
            v = WORD.findall(lowered(item))
            n = min(window, len(v))
            if not n:
                continue
            for i in range(len(v) - n + 1):
                for q in range(len(w) - n + 1):
                    if w[q : q + n] == v[i : i + n]:
                        hit.update(range(q, q + n))
                        got.add("" if item_id is None else str(item_id))
        ids = sorted(got)
        found.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(found, key=repr)


def some_text(rng, n, vocabulary):
    return rng.choice([" ", "  "]).join(rng.choice(vocabulary) + rng.choice(["", ",", ".\n"]) for _ in range(n))


def cases():
    rng = random.Random(5)
    vocabulary = ["a", "B", "été", "ß", "word", "Word", "x1", "long" * 9]
    items = [(i, some_text(rng, rng.randint(8, 24), vocabulary)) for i in range(12)]
    items += [(100, "a word"), (101, ""), (102, None), (None, "B B B"), (12, items[0][1]), (7, items[7][1])]
    docs = []
    for i in range(60):
        parts = [some_text(rng, rng.randint(0, 40), vocabulary)]
        if i % 3 == 0:
            parts.append(rng.choice(items)[1] or "")
            parts.append(some_text(rng, 5, vocabulary))
        docs.append((i, " ".join(parts)))
    docs += [(60, None), (61, ""), (None, items[1][1]), (5, docs[5][1]), (62, " ".join(docs[k][1] for k in range(40)))]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_against_brute_force(spark, block_bytes):
    docs, items = cases()
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, runs int, text_key string").repartition(5)
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = decontaminate.contamination(d, b, block_bytes=block_bytes).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, items)
    kept = decontaminate.without_contaminated(d, b, block_bytes=block_bytes)
    assert kept.columns == d.columns
    clean = [r[0] for r in brute(docs, items) if not r[5]]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.contamination(none, items).collect() == []
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert [r.n_hit for r in decontaminate.contamination(docs, items.limit(0)).collect()] == [0]


def test_longest_match_and_place(spark):
    item = " ".join(f"w{i}" for i in range(30))
    text = "lead in " + " ".join(f"w{i}" for i in range(4, 21)) + " out"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    runs = decontaminate.benchmark_runs(docs, spark.createDataFrame([(9, item)], "item_id long, text string")).first().runs
    assert [tuple(r) for r in runs] == [("9", 4, 2, 17)]


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 50, 400):
        ids = np.append(rng.integers(1, 4, n), 0).astype(np.int32)
        if n == 400:
            ids = np.append(np.concatenate([ids[:100]] * 4), 0).astype(np.int32)
        order = decontaminate.SuffixArray(ids).order.tolist()
        assert order == sorted(range(len(ids)), key=lambda i: ids[i:].tolist())


def test_words_of_windows(monkeypatch):
    monkeypatch.setattr(words, "WINDOW", 64)
    texts = ["", "ab cd", "é" * 200 + " x", " ".join(["Wort"] * 50), "  ", "a"]
    found, counts = words.hashes([t.encode() for t in texts], decontaminate.WORD_CUTS)
    plain = [WORD.findall(lowered(t)) for t in texts]
    assert counts.tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    assert len(set(zip(flat, found.tolist()))) == len(set(flat)) == len(set(found.tolist()))


def test_a_word_repeated_all_over(spark):
    """Places of a window are not multiplied by the windows of an item; memory stays with the text."""
    import resource

    text = "again " * 400_000
    benchmark = decontaminate.Benchmark([("a", "again " * 200), ("b", "again " * 3), ("c", "other words")], 10)
    hashes, counts = words.hashes([text.encode(), b"x again again again y again again again again"], decontaminate.WORD_CUTS)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    runs = decontaminate._shard_runs(benchmark, hashes, counts)
    assert [tuple(r.values()) for r in runs[0]] == [("a", 0, 0, 400_000), ("b", 0, 0, 400_000)]
    assert [tuple(r.values()) for r in runs[1]] == [("b", 0, 1, 3), ("b", 0, 5, 4)]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 600_000


def test_places_in_parts(spark, monkeypatch):
    docs, items = cases()
    items = [(i, t) for i, t in items if t]
    benchmark = decontaminate.Benchmark(items, 10)
    hashes, counts = words.hashes([(t or "").encode() for _, t in docs], decontaminate.WORD_CUTS)
    whole = decontaminate._shard_runs(benchmark, hashes, counts)
    for n in (1, 7, 100):
        monkeypatch.setattr(decontaminate, "PLACES_AT_ONCE", n)
        assert decontaminate._shard_runs(benchmark, hashes, counts) == whole
