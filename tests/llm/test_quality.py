"""Quality: accuracy on labels that training did not get, co-training itself, and the defined cases."""

import duckdb
import numpy as np

from regtables.llm import quality

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    got = {r.doc_id: r for r in quality.quality(docs, labels.where("doc_id % 3 <> 0")).collect()}
    assert len(got) == 1000 and all(0 <= r.score <= 1 for r in got.values())
    held = duckdb.sql(f"SELECT doc_id, quality FROM '{SF_DIR}/labels.parquet' WHERE doc_id % 3 = 0").fetchall()
    assert sum(got[i].kept == (q == 1) for i, q in held) / len(held) > 0.9
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and 600 < kept.count() < 1000


def test_odd_rows(spark):
    rows = [(i, "plain words of a text " * (1 + i % 4), "en", "s", 5, 1.0) for i in range(30)]
    rows += [(100 + i, "JUNK!!! $$$ " * (1 + i % 4), "en", "s", 5, 1.0) for i in range(30)]
    rows += [(300, None, None, None, None, 1.0), (301, "", "en", "s", 0, 1.0), (None, "plain words", "en", "s", 1, 1.0), (0, rows[0][1], "en", "s", 5, 1.0), (302, "plain words " * 150_000, "x", "y", 1, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double").repartition(4)
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(30)] + [(0, None), (None, 0)], "doc_id long, quality int")
    got = quality.quality(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.kept for r in got}
    assert all(by[i] for i in range(30)) and not any(by[100 + i] for i in range(30)) and by[302]
    assert {r.score for r in quality.quality(docs, labels.limit(0)).collect()} == {1.0}
    assert quality.quality(docs.limit(0), labels).collect() == []
    assert sorted(quality.accepted(docs, labels).columns) == sorted(docs.columns)


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 3000).astype(float)
    views = tuple(np.column_stack([y + rng.normal(0, 0.6, 3000), rng.normal(0, 1, (3000, 20))]) for _ in range(2))
    few = np.arange(3000) < 45
    part = lambda m: tuple(v[m] for v in views)
    right = [((quality.co_train(part(few), y[few], part(~few), rounds=r).scores(part(~few))[2] > 0.5) == y[~few]).mean() for r in (0, 3)]
    assert right[1] > right[0] and right[1] > 0.85


def test_columns_named_like_scores(spark):
    docs = [(i, "good words here" if i % 2 else "!! ## !!", "en", f"s{i % 3}", 9, "kept", 1.0, 2, "x") for i in range(60)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars int, content_score string, Score double, metadata_score int, `a.b` string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    kept = quality.accepted(d, labels)
    assert kept.columns == d.columns
    rows = kept.collect()
    assert {r.doc_id for r in rows} <= set(range(60)) and all((r.content_score, r.Score, r.metadata_score, r["a.b"]) == ("kept", 1.0, 2, "x") for r in rows)
    assert quality.quality(d, labels).columns == ["doc_id", "content_score", "metadata_score", "score", "kept"]
