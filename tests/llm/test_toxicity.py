"""Toxicity: accuracy on held-out labels, and the defined cases."""

import duckdb
import random

from regtables.llm import toxicity

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    got = {r.doc_id: r for r in toxicity.toxicity(read("documents"), read("labels")).collect()}
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF_DIR}/labels.parquet'").fetchall())
    held = [r for r in got.values() if r.held_out and r.doc_id in labels]
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert right / len(held) > 0.9


def words(rng, n, *more):
    return " ".join(rng.choice(["river", "stone", "morning", "walks", "green", *more]) for _ in range(n))


def test_odd_rows(spark):
    rng = random.Random(1)
    bad = [(i, words(rng, 30, "nastyword"), 1) for i in range(40)]
    good = [(i, words(rng, 30), 0) for i in range(40, 120)]
    rows = [(i, t, "x", 0.5) for i, t, _ in bad + good]
    rows += [(200, None, "x", 1.0), (201, "", "x", 1.0), (None, words(rng, 20, "nastyword", "nastyword"), "x", 1.0), (5, bad[5][1], "x", 0.5), (202, "stone " * 50_000, None, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, predicted double").repartition(4)
    labels = spark.createDataFrame([(i, x) for i, _, x in bad + good] + [(0, None), (None, 1), (0, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.predicted for r in got}
    assert by[200] == by[201] == by[202] == 0 and by[None] == 1
    assert sum(r.predicted for r in got if r.doc_id is not None and r.doc_id < 40) >= 38
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def test_parts_of_words_tell(spark):
    """What toxic documents share is a stem; each of its words is in a few of them only."""
    rng = random.Random(2)
    stem = lambda: "grumpf" + rng.choice("abcdefgh") + rng.choice("xyz")
    bad = [(i, words(rng, 40, stem(), stem()), 1) for i in range(150)]
    good = [(i, words(rng, 40, "grumble", "umpire"), 0) for i in range(150, 450)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in bad + good], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, x) for i, _, x in bad + good], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [(got[i].predicted, x) for i, _, x in bad + good if got[i].held_out]
    assert len(held) > 60 and sum(p == x for p, x in held) >= 0.95 * len(held)


def test_gains_are_differences_of_whole_blocks():
    """Gains by a compressor that is made anew for each window."""
    counts = [("river", 0, 50), ("stone", 5, 40), ("nasty", 30, 0), ("nastier", 20, 0), ("morning", 1, 60)]
    for dictionaries in toxicity.train_dictionaries(counts, 60, 120):
        texts = ["the nasty river and a nastier stone", "", "Morning " * 7]
        found = toxicity.Gains(dictionaries).of(texts)
        for text, own in zip(texts, found, strict=True):
            plain = []
            for w in toxicity.windows(text):
                data = toxicity._LEAD + f" {w} ".encode()
                sizes = [len(toxicity.Gains._compressor(d).compress(data)) for d in dictionaries]
                plain.append(sizes[1] - sizes[0])
            assert own.tolist() == plain
        assert found[0].max() >= 3 and len(found[1]) == 0


def test_segments_by_hand():
    counts = [("nasty", 10, 0), ("nastier", 10, 0), ("river", 0, 10), ("nation", 1, 9)]
    found = toxicity.segments(counts, 20, 20)
    assert found[0] in (" nast", "nasti", " nasti", " nastier", " nastier ") and not any("river" in x or "nati" in x for x in found)
    assert all(a is b or (a not in b and b not in a) for a in found for b in found)


def test_a_repeated_id_is_one_text(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, 20, *(["vile"] * 3 if i < 30 else []))) for i in range(90)] + [(5, "other text of the same id")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(90)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) and sum(r.predicted for r in got if r.doc_id < 30 and r.doc_id != 5) >= 26
