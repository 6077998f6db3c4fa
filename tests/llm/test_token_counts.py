"""Counts after edits against encoding the whole edited text."""

import hashlib
import random

import pytest

from regtables.llm import token_counts as tc
from regtables.llm.tokens import Encoder

TOKENIZER = Encoder().tokenizer


def n_tokens(text):
    return len(TOKENIZER.encode(text, add_special_tokens=False).ids)


def some_text(rng, n):
    return "".join(rng.choice(["the ", "word", " été", ", ", "  ", "\n", "12", "ß", "日本", "'s", " ", "x y z "]) for _ in range(n))


@pytest.mark.parametrize("size", [4, 16, 512])
def test_edits_one_by_one(size):
    rng = random.Random(size)
    count = lambda parts: [n_tokens(p) for p in parts]
    for _ in range(25):
        text = some_text(rng, rng.choice([0, 3, 60, 400]))
        leaves = tc.leaves_of(text, size)
        assert "".join(leaves) == text
        tree = tc.Tree([len(x) for x in leaves], count(leaves))
        assert tree.n_tokens == n_tokens(text)
        for _ in range(12):
            start, length = rng.randint(0, len(text) + 3), rng.choice([0, 1, 5, 50, 10_000])
            put = some_text(rng, rng.choice([0, 0, 1, 3, 80]))
            wanted = text[: min(start, len(text))] + put + text[min(start, len(text)) + length :]
            text, encoded = tc.apply_edit(tree, text, start, length, put, count, size)
            assert text == wanted and tree.n_tokens == n_tokens(text) and tree.sums[0, 1] == len(text)


def test_only_touched_leaves_are_encoded():
    count = lambda parts: [n_tokens(p) for p in parts]
    text = "some words here " * 20_000
    leaves = tc.leaves_of(text)
    tree = tc.Tree([len(x) for x in leaves], count(leaves))
    text, encoded = tc.apply_edit(tree, text, 150_000, 4, "other", count)
    assert encoded < 3 * tc.LEAF_CHARS and tree.n_tokens == n_tokens(text)


def test_store_and_edits(spark, tmp_path):
    rng = random.Random(9)
    docs = [(i, some_text(rng, 120)) for i in range(30)] + [(30, None), (31, ""), (None, "no id"), (4, "repeats the id"), (32, "long words " * 30_000)]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, edits int").repartition(4)
    edits = [(i, k, rng.randint(0, 200), rng.randint(0, 30), rng.choice([None, "new ", " x"])) for i in [*range(0, 20), 31, 32, 99] for k in range(3)]
    edits += [(21, 0, None, None, "put in front"), (None, 0, 0, 0, "lost")]
    e = spark.createDataFrame(edits, "doc_id long, edit_no int, start long, length int, replacement string").repartition(3)
    store = tc.build_store(d, str(tmp_path / "store"))
    got = tc.edited(tc.with_edits(store, e)).collect()
    wanted = []
    for i, text in docs:
        text = text or ""
        before, n = n_tokens(text), 0
        for _, _, start, length, put in sorted((x for x in edits if x[0] == i and i is not None), key=lambda x: x[1]):
            start = min(start or 0, len(text))
            text, n = text[:start] + (put or "") + text[start + (length or 0) :], n + 1
        wanted.append((i, text, before, n_tokens(text), n))
    assert sorted(((r.doc_id, r.text, r.tokens_before, r.n_tokens, r.n_edits) for r in got), key=repr) == sorted(wanted, key=repr)
    assert all(sum(r.leaf_chars) == len(r.text) and sum(r.leaf_tokens) == r.n_tokens for r in got)


def test_query_and_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = tc.revised_counts(docs).collect()
    texts = {hashlib.sha256(r.text.encode()).hexdigest(): r.text for r in tc.edited(docs.selectExpr("doc_id", "text", "array(length(text)) leaf_chars", "array(0) leaf_tokens").withColumn("edits", tc.revision(docs.text, docs.doc_id))).collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == 200
    for r in got[::5]:
        assert (r.n_edits, r.tokens_before, r.n_tokens) == (3, n_tokens(before[r.doc_id]), n_tokens(texts[r.text_sha256]))
    assert tc.revised_counts(docs.limit(0)).collect() == []
