"""Near copies against comparing all pairs."""

import random
import re

import numpy as np
import pytest

from regtables.llm import lsh_forest
from regtables.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    w = WORD.findall((text or "").encode().lower().decode())
    n = min(size, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(docs, size, percent):
    sets = [(i, shingles(t, size)) for i, t in docs]
    smallest = {i: i for i, _ in sets}
    moved = True
    links = [(a, b) for x, (a, s) in enumerate(sets) for b, t in sets[:x] if s and t and None not in (a, b) and 100 * len(s & t) >= percent * len(s | t)]
    while moved:
        moved = False
        for a, b in links:
            low = min(smallest[a], smallest[b])
            if (smallest[a], smallest[b]) != (low, low):
                smallest[a] = smallest[b] = low
                moved = True
    return sorted(((i, len(s), smallest[i], i == smallest[i]) for i, s in sets), key=repr)


def cases(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    common = some(40)
    texts = []
    for _ in range(30):
        base = some(rng.randint(30, 200))
        if rng.random() < 0.5:
            base = common + base
        texts.append(base)
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(copy)
    hot = some(120)
    for _ in range(60):
        copy = list(hot)
        copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(copy)
    texts += [["one"], ["ONE"], ["one", "two"], ["one", "two"], ["A", "b", "c"], ["a", "B", "c"]]
    docs = [" ".join(t) for t in texts] + [None, "", " \n\t "]
    rng.shuffle(docs)
    docs = [(3 * i + 1, t) for i, t in enumerate(docs)]
    return docs + [(None, docs[0][1]), (10_000, "x " * 30_000)]


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_against_brute_force(spark, size, percent):
    docs = cases()
    d = spark.createDataFrame([(t, i, "x", 1) for i, t in docs], "text string, doc_id long, component_id string, key_a int").repartition(5)
    got = lsh_forest.near_copies(d, size=size, percent=percent).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, size, percent)


def test_many_copies_linked_through_one_document_in_mid_order(spark):
    """Copies link to their base and not to each other; the base is not the smallest id."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(400)]
    docs = [(500, " ".join(base))]
    for k in range(150):
        copy = list(base)
        for at in rng.sample(range(8, 392, 8), 8):
            copy[at] = f"own{k}-{at}"
        docs.append((400 + k + (k >= 100), " ".join(copy)))
    # Copies of another text that are as near to theirs, but whose base is not there.
    docs += [(2000 + k, " ".join(f"own{k}-{i}" if i % 32 < 2 else f"v{i}" for i in range(200))) for k in range(40)]
    wanted = brute(docs, 5, 80)
    assert {r[2] for r in brute([d for d in docs if d[0] != 500], 5, 80) if r[0] < 2000} == {*range(400, 551)} - {500}
    assert sum(r[2] == 400 for r in wanted) == 151 and sum(r[3] for r in wanted) == 41
    got = lsh_forest.near_copies(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == wanted


def test_sets_that_are_similar_enough_share_a_first_shingle():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 50, lsh_forest.RANK_BUCKETS)
    for _ in range(300):
        both, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (rng.integers(1, 60), rng.integers(0, 10), rng.integers(0, 10)))
        sets = [np.unique(np.concatenate([both, x])) for x in (a, b)]
        n_a, n_b = map(len, sets)
        shared = len(np.intersect1d(*sets))
        assert (shared >= lsh_forest.least_shared(n_a, n_b, 80)) == (100 * shared >= 80 * (n_a + n_b - shared))
        if shared >= (least := lsh_forest.least_shared(n_a, n_b, 80)):
            first = [lsh_forest.first_shingles(s, counts, 80)[: len(s) - least + 1] for s in sets]
            assert len(np.intersect1d(*first))


def test_repeated_rows_and_stage(spark):
    text = " ".join(f"w{i}" for i in range(50))
    d = spark.createDataFrame([(4, text, "a"), (4, text, "a"), (9, text + " more", "b"), (11, "other words here", "c")], "doc_id long, text string, kept string")
    got = lsh_forest.near_copies(d)
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got.collect()) == [(4, 4, True), (4, 4, True), (9, 4, False), (11, 11, True)]
    kept = lsh_forest.without_near_copies(d)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [4, 4, 11]


def test_empty_table(spark):
    assert lsh_forest.near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_regions_pair_all_of_a_small_region_and_tie_large_ones():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 3, (300, 6)).astype(np.uint16)
    values = values[np.lexsort(values.T[::-1])]
    pairs = {tuple(p) for p in lsh_forest.region_pairs(np.zeros(300), values, 2, 4).tolist()}
    for i in range(300):
        for d in range(2, 7):
            same = np.flatnonzero((values[:, :d] == values[i, :d]).all(axis=1))
            if len(same) <= 4:
                assert all((min(i, j), max(i, j)) in pairs for j in same if j != i)
                break
        else:
            assert same[0] == i or (same[0], i) in pairs


def test_components_of_a_long_chain_and_a_star(spark, tmp_path):
    links = [(i, i + 1) for i in range(100, 200)] + [(7, 1000 + i) for i in range(200)] + [(5, 5)]
    random.Random(1).shuffle(links)
    found = components(spark.createDataFrame(links, "a long, b long").repartition(8), str(tmp_path / "c")).collect()
    assert {r.id: r.component for r in found} == {**{i: 100 for i in range(100, 201)}, 7: 7, **{1000 + i: 7 for i in range(200)}}
