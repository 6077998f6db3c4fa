"""Exact copies against a dictionary."""

import hashlib
import random

import pytest

from regtables.llm import exact_dedup


def brute(docs):
    groups = {}
    for doc_id, text in docs:
        groups.setdefault((text or "").encode().lower(), []).append(doc_id)
    found = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        found += [(i, keep, len(ids), i == keep, hashlib.sha256(text).hexdigest()) for i in ids]
    return sorted(found, key=repr)


def cases():
    rng = random.Random(2)
    docs = [(i, "Hot Text" if i % 3 == 0 else f"text {rng.randint(0, 90)} É") for i in range(300)]
    return docs + [(300, None), (301, ""), (None, "only null id"), (None, "hot text"), (303, "é"), (304, "É"), (305, "x" * 300_000), (306, "X" * 300_000), (7, docs[7][1])]



@pytest.mark.parametrize("settings", [{}, {"bucket_keys": 3}, {"key_of": lambda text: len(text) % 3, "bucket_keys": 1}])
def test_against_brute_force(spark, settings):
    docs = cases()
    d = spark.createDataFrame([(i, t, "s", 0) for i, t in docs], "doc_id long, text string, owner string, key int").repartition(6)
    got = exact_dedup.exact_copies(d, **settings).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs)


def test_without_copies(spark):
    d = spark.createDataFrame([(1, "a", "x"), (2, "A", "y"), (3, "b", "z")], "doc_id long, text string, kept string")
    kept = exact_dedup.without_copies(d)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_rows_that_repeat(spark):
    docs = [(1, "a", "p"), (1, "A", "q"), (1, "a", "p"), (2, "a", "r"), (1, "b", "s"), (2, "a", "r"), (None, "n", "t"), (None, "n", "t"), (3, None, "u"), (3, "", "v"), (None, "b", "w"), (7, "c" * 100_000, "x")]
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, __kept string, `a.b` int").repartition(4)
    kept = exact_dedup.without_copies(d)
    assert kept.columns == d.columns
    found = sorted(((r.doc_id, (r.text or "").lower()[:3], r["__kept"]) for r in kept.collect()), key=repr)
    assert found == sorted([(2, "a", "r"), (1, "b", "s"), (None, "n", "t"), (3, "", "v"), (7, "ccc", "x")], key=repr)
    assert exact_dedup.without_copies(d.limit(0)).count() == 0


def test_a_hot_text_goes_to_its_owner_once_per_task(spark, tmp_path, monkeypatch):
    """Slices of a task after the first bring the hash and the count only."""
    import pyarrow as pa

    class Known:
        value = (exact_dedup.Directory(), __import__("numpy").zeros(1, "i4"))

    monkeypatch.setattr(exact_dedup, "slices", lambda batches: (b.slice(i, 5) for b in batches for i in range(0, b.num_rows, 5)))
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(50)), "text": ["hot" if i % 2 else f"t{i}" for i in range(50)]})
    sent = [r for b in exact_dedup._entries(Known, exact_dedup.hash_key)([rows]) for r in b.to_pylist()]
    hot = [r for r in sent if r["n_rows"] > 1 or r["text"] in (b"hot", None)]
    assert [r["text"] for r in hot] == [b"hot"] + [None] * 9 and sum(r["n_rows"] for r in hot) == 25 and max(r["keep_id"] for r in hot) == 49
    assert sorted(r["text"] for r in sent if r not in hot) == sorted(f"t{i}".encode() for i in range(0, 50, 2))


def test_empty_table(spark):
    assert exact_dedup.exact_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_directory_doubles_and_covers_all_keys():
    import numpy as np

    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    counts = np.bincount((keys >> np.uint64(53)).astype(int), minlength=2048)
    directory = exact_dedup.Directory()
    assert directory.grow(0, counts, 40) == []
    buckets = directory.lookup(keys)
    assert np.bincount(buckets).max() <= 40
    assert len(directory.slots) == 1 << directory.depth
    assert (np.bincount(buckets, minlength=len(directory.keys)) == directory.keys).all()
    owners = directory.owners(7)
    by_key = owners[directory.lookup(np.sort(keys))]
    assert (np.diff(by_key) >= 0).all() and set(by_key.tolist()) == set(range(7))
