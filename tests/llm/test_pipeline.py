"""The pipeline, stage by stage, each against brute force on the input it got."""

import hashlib

import corpus_pipeline
import test_decontaminate
import test_exact_dedup
import test_lsh_forest

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, inputs = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        inputs.append({r.doc_id: r.text for r in docs.collect()})
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = [list(i.items()) for i in inputs]
    assert 150 < len(inputs[1]) < 200
    assert set(inputs[2]) == {r[0] for r in test_exact_dedup.brute(rows[1]) if r[3]}
    assert set(inputs[3]) == {r[0] for r in test_lsh_forest.brute(rows[2], 5, 80) if r[3]}
    assert set(inputs[4]) == {r[0] for r in test_decontaminate.brute(rows[3], items) if not r[5]}
    packed = docs.collect()
    assert {r.doc_id for r in packed} == set(inputs[4])
    total = sum(r.length for r in packed)
    assert max(r.offset + r.length for r in packed) <= 2048
    assert len({r.sequence_id for r in packed}) <= total / 2048 * 1.1 + 2


def test_run(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    rows = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found.collect())
    assert rows and hashlib.sha256(repr(rows).encode()).hexdigest() == hashlib.sha256(repr(sorted(set(rows))).encode()).hexdigest()


def test_tasks_give_back_what_they_freed(monkeypatch):
    """While they read much text, and at their end, also if they stop early."""
    import pyarrow as pa

    from regtables.llm import common

    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_pydict({"text": ["x" * (1 << 20)] * 20})
    assert sum(b.num_rows for b in common.slices(iter([batch] * 3))) == 60 and len(calls) == 4
    some = common.slices(iter([batch]))
    next(some)
    some.close()
    assert len(calls) == 5
    monkeypatch.undo()
    common.give_back()
