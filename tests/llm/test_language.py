"""The recurrent network against a plain forward pass and numeric slopes, and predictions on held-out documents."""

import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from regtables.llm import language

PARTS = {
    "en": ["the", "and", "th", "ing", "er", "wh", "ea", "sh", "ly"],
    "de": ["der", "sch", "ung", "ß", "ei", "ich", "pf", "ö", "zu"],
    "fr": ["le", "eau", "é", "oi", "que", "ç", "ou", "ment", "aux"],
    "日本": ["日", "本", "語", "の", "は", "です"],
}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.choice([1, 2, 3]))) for _ in range(n)).capitalize()


def sigmoid(a):
    return 1 / (1 + np.exp(-a))


def plain(net, data):
    """Class probabilities at each byte of one window, a scalar recurrence at a time."""

    def states(way, given):
        h, found = np.zeros(net.own.shape[-1]), []
        for c in given:
            z, r = (sigmoid(2 * (net.given[k, way, c] + h @ net.own[k, way])) * 1.0 for k in (0, 1))
            n = np.tanh(net.given[2, way, c] + r * (h @ net.own[2, way] + net.shift[way, 0]))
            h = z * h + (1 - z) * n
            found.append(h)
        return np.array(found)

    forward, backward = states(0, data), states(1, data[::-1])[::-1]
    a = forward @ net.out[0].T + backward @ net.out[1].T + net.bias[:, 0]
    e = np.exp(a - a.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def small_network(seed=0):
    net = language.Network.fresh(["a", "b", "c"], 4, np.random.default_rng(seed))
    for name in ("given", "own", "shift", "out", "bias"):
        setattr(net, name, getattr(net, name).astype("f8"))
    net.shift += 0.1
    return net


def test_probabilities_as_computed_plainly():
    net, rng = small_network(), np.random.default_rng(1)
    data = rng.integers(0, 256, 300).astype(np.uint8)
    start, length = np.array([0, 50, 200, 299]), np.array([50, 33, 7, 1])
    got = language.position_probabilities(net, data, start, length)
    for k, (s, n) in enumerate(zip(start, length, strict=True)):
        assert np.allclose(got[:n, :, k], plain(net, data[s : s + n]))


def test_gradient_is_the_slope():
    net, rng = small_network(), np.random.default_rng(2)
    data = rng.integers(0, 256, 200).astype(np.uint8)
    case = data, np.array([0, 40, 100, 7]), np.array([7, 5, 3, 1]), np.array([0, 1, 2, 1])
    loss, slopes = language.gradients(net, *case)
    want = -sum(np.log(plain(net, data[s : s + n])[:, t]).sum() for s, n, t in zip(*case[1:], strict=True)) / case[2].sum()
    assert np.isclose(loss, want)
    for p, g in zip(net.parameters, slopes, strict=True):
        at = np.argwhere(np.abs(g) > 1e-5)
        for i in map(tuple, at[rng.permutation(len(at))[:15]]):
            old = p[i]
            p[i] = old + 1e-5
            up = language.gradients(net, *case)[0]
            p[i] = old - 1e-5
            down = language.gradients(net, *case)[0]
            p[i] = old
            assert np.isclose((up - down) / 2e-5, g[i], rtol=1e-4, atol=1e-8)


def test_windows_cover_everything_once():
    lengths = np.array([0, 1, 95, 96, 97, 1000, 0, 5])
    start, length, doc = language.windows(lengths)
    assert length.max() <= language.WINDOW and length.min() >= 1
    assert np.array_equal(np.concatenate([np.arange(s, s + n) for s, n in zip(start, length, strict=True)]), np.arange(lengths.sum()))
    assert np.array_equal(np.bincount(doc, length, len(lengths)), lengths)


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(7)
    docs = []
    for i in range(600):
        lang = rng.choice(["en", "de", "fr", "fr", "日本"])
        docs.append((i, prose(rng, lang, rng.choice([4, 30, 120])), lang))
    docs += [(9000, None, "en"), (9001, "", "de"), (9002, "1234 !?", "en"), (9003, "…—", None), (9004, prose(rng, "de", 30_000), None)]
    return docs + [(None, prose(rng, "fr", 30), "en")] + [(9005, prose(rng, "en", 20), "en")] * 3


def rows(spark, docs):
    return spark.createDataFrame([(*d, "x", 1.5, True) for d in docs], "doc_id long, text string, lang string, lang_pred string, score double, held_out boolean")


def test_held_out_documents(spark, documents):
    d = rows(spark, documents).repartition(5)
    net = language.train(d, steps=60)
    found = language.languages(d, net)
    assert found.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    got = found.collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in documents)
    by_id = {r.doc_id: r for r in got}
    assert all(r.held_out == (r.doc_id is None or crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    for i in (9000, 9001, 9002, 9003):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0)
    held = [(r, lang) for i, _, lang in documents if i is not None and i < 9000 for r in [by_id[i]] if r.held_out]
    assert sum(r.lang_pred == lang for r, lang in held) >= 0.97 * len(held)
    assert by_id[9004].lang_pred == "de" and by_id[None].lang_pred == "fr"
    assert all(0 <= r.score <= 1 for r in got)

    # The document's probabilities are the mean over its letters of those at each byte.
    probe = [t for _, t, _ in documents[:40]]
    whole = language.document_probabilities(net, [t.encode() for t in probe])
    for t, own in zip(probe, whole, strict=True):
        raw = np.frombuffer(t.encode(), np.uint8)
        p = np.concatenate([plain(net, raw[s : s + n]) for s, n, _ in zip(*language.windows(np.array([len(raw)])), strict=True)])
        letters = np.array([c >= 128 or chr(c).isalpha() for c in raw])
        assert np.allclose(own, p[letters].mean(0), atol=1e-4)

    runs = language.language_runs(d.where("doc_id < 20 or doc_id between 9000 and 9003"), net).orderBy("doc_id", "start").collect()
    for i, text, _ in documents:
        if i is not None and (i < 20 or 9000 <= i <= 9003):
            own = [r for r in runs if r.doc_id == i]
            ends = [0, *(r.start + r.length for r in own)]
            assert [r.start for r in own] == ends[:-1] and ends[-1] == len((text or "").encode())


def test_nothing_learnt(spark):
    docs = [(1, "some text", None), (2, None, None)]
    got = {tuple(r) for r in language.languages(rows(spark, docs)).collect()}
    assert got == {(i, crc32(str(i).encode()) % 5 == 0, "und", 0.0) for i in (1, 2)}
    assert language.languages(rows(spark, [])).count() == 0


def test_neither_lang_nor_held_out_texts_matter(spark, documents):
    """Other langs of held-out documents, and other columns, change nothing."""
    d = [x for x in documents if x[0] is not None and x[0] < 200]
    other = [(i, t, "fr" if crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in d]
    a, b = (sorted(map(tuple, language.languages(rows(spark, x).repartition(n), steps=5).collect())) for x, n in ((d, 2), (other, 7)))
    assert a == b
