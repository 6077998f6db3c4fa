"""Packing: pieces by the plain tokenizer, sequences without gaps, and few of them."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from regtables.llm import packing
from regtables.llm.tokens import Encoder


def cases():
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["the", "été", "word,", "x1", "straße"]) for _ in range(rng.choice([0, 1, 5, 30, 31, 200])))) for i in range(200)]
    return docs + [(200, None), (201, ""), (None, "no id"), (5, docs[5][1]), (202, "again " * 900)]


TOKENIZER = Encoder().tokenizer


def ids_of(text, end_id):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [end_id]


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pieces_and_sequences(spark, capacity):
    docs = cases()
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, task int").repartition(7)
    got = packing.packed(d, capacity=capacity).collect()
    wanted = []
    for i, t in docs:
        ids = ids_of(t, 0)
        first = len(ids) % capacity or capacity
        cuts = [0, *range(min(first, len(ids)), len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            wanted.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(wanted, key=repr)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r.length for r in got) // capacity)
    assert least <= len(by) <= least * 1.1 + 2


def test_sequences_hold_the_ids(spark):
    docs = cases()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = packing.sequences(d, capacity=128).collect()
    assert all(len(r.ids) == 4 * r.length <= 512 for r in rows)
    got = sorted(i for r in rows for i in np.frombuffer(bytes(r.ids), "<u4").tolist())
    assert got == sorted(i for _, t in docs for i in ids_of(t, 0))


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed(none).collect() == []


def test_plan_uses_up_the_histogram_near_the_bound():
    rng = np.random.default_rng(2)
    for n in (0, 1, 50, 40_000):
        lengths = np.minimum(256, np.exp(rng.normal(4, 1, n)).astype(int) + 1)
        h = np.bincount(lengths, minlength=257)
        plan, got = packing.plan_for(h, 256), np.zeros(257, int)
        for content, k in plan:
            assert k > 0 and sum(a * b for a, b in content) <= 256
            for a, b in content:
                got[a] += b * k
        assert (got == h).all()
        assert sum(k for _, k in plan) <= lengths.sum() / 256 * 1.02 + 2


def test_fit_is_the_least_squares_solution():
    rows = np.array([(3, 1, 0, 0), (2, 2, 0, 0), (1, 1, 1, 1)])
    x = packing.fit(rows, np.array([0, 14, 8, 6, 0]), rounds=3000)
    assert np.allclose(x, [6, 4, 2], atol=1e-3)


def test_most_sequences_come_from_patterns():
    """The plan by patterns holds by itself; best fit packs what rounding leaves."""
    rng = np.random.default_rng(4)
    for n, share in ((300, 0.25), (3000, 0.8), (60_000, 0.9)):
        lengths = np.minimum(2047, np.exp(rng.normal(6, 1.1, n)).astype(int) + 1)
        h = np.bincount(lengths, minlength=2049)
        fitted, left = packing.fitted_plan(h, 2048)
        used = np.zeros_like(h)
        for content, k in fitted:
            assert sum(a * b for a, b in content) == 2048 and sum(b for _, b in content) <= 4
            for a, b in content:
                used[a] += b * k
        assert (used + left == h).all() and (left >= 0).all()
        total = sum(k for _, k in packing.plan_for(h))
        assert sum(k for _, k in fitted) >= share * total
        assert total <= min(lengths.sum() / 2048 * 1.01 + 2, sum(k for _, k in packing.best_fit(h, 2048)) * 1.005 + 1)


def test_patterns_by_brute_force():
    lengths = [1, 2, 3, 5, 8, 9]
    h = np.zeros(13, np.int64)
    h[lengths] = 1
    want = {tuple(sorted(p, reverse=True)) for a in lengths for b in [0, *lengths] for c in [0, *lengths] for d in [0, *lengths] if sum(p := (a, b, c, d)) == 12}
    want = {p for p in want if p[1]}
    found = {tuple(r) for r in packing.patterns(h, 12).tolist()}
    assert found <= want and {p for p in want if p[2] == 0} <= found and len(found) > len(want) / 2
