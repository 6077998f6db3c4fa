"""The commit log: loads side by side, datasets whole or not at all, merges that leave files alone, expiry."""

import json
import os
import threading
import uuid
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from regtables.plans import pipeline
from regtables.plans.pipeline import load_tables, run_dataset
from regtables.plans.specs import INGESTION_STATE, DatasetSpec, TableSpec
from regtables.sinks import tables
from regtables.sinks.log import CommitConflict, CommitLog, Edit, Part
from regtables.sinks.storage import Storage
from regtables.sinks.tables import bulk_load, compact, ensure_tables, execute_merge, log_of, read_table, show_last, stage, table_name

AS_OF = datetime(2025, 9, 10, 12, 0, tzinfo=timezone.utc)
T1 = TableSpec("t1", {"id": "BIGINT", "name": "TEXT"}, ("id",))
T2 = TableSpec("t2", {"code": "TEXT", "n": "INTEGER"}, ("code",))


@pytest.fixture
def place(spark, tmp_path):
    schema, root = f"s_{uuid.uuid4().hex[:8]}", str(tmp_path / "root")
    ensure_tables(spark, schema, [T1, T2], root)
    return schema, root


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def ids(spark, low, high, name="old", files=1):
    return spark.range(low, high, numPartitions=files).select("id", F.lit(name).alias("name"))


def both(spark, place, spec=T1):
    """The rows by the log, which must be those that the catalog shows."""
    found = rows(read_table(spark, place[0], spec, place[1]))
    assert rows(spark.table(table_name(place[0], spec))) == found
    return found


def files(place, table="t1"):
    """Data files with their time of change."""
    return {p.name: p.stat().st_mtime_ns for p in Path(place[1], place[0], table).rglob("part-*.parquet")}


# --- storage and log -----------------------------------------------------------------------------


def test_one_of_many_writers_takes_a_name(spark, tmp_path):
    storage = Storage(spark, str(tmp_path / "x"))
    won = []
    write = lambda k: won.append(k) if storage.put_if_absent("_log/1.json", str(k).encode() * 1000) else None
    threads = [threading.Thread(target=write, args=(k,)) for k in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and storage.read("_log/1.json") == str(won[0]).encode() * 1000
    assert [e.name for e in storage.entries("_log") if "crc" not in e.name] == ["1.json"]
    assert storage.entries("none") == [] and not storage.exists("none")


def test_commits_side_by_side_are_all_kept(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "x"))
    add = lambda k: [log.commit(lambda s: {f"t{k % 3}": Edit("append", (Part(f"t{k % 3}/{k}-{i}", 1),))}) for i in range(4)]
    threads = [threading.Thread(target=add, args=(k,)) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    last = log.latest()
    assert last.version == 24 and log.versions() == list(range(1, 25))
    assert sorted(p.folder for parts in last.tables.values() for p in parts) == sorted(f"t{k % 3}/{k}-{i}" for k in range(6) for i in range(4))


def test_a_rewrite_starts_again_from_what_others_made(spark, tmp_path):
    log, calls = CommitLog(spark, str(tmp_path / "x")), []

    def rewrite(snapshot):
        calls.append(snapshot.version)
        if len(calls) == 1:  # another load comes between
            log.commit(lambda s: {"t": Edit("append", (Part("t/other", 5),))})
        parts = snapshot.parts("t")
        return {"t": Edit("rewrite", (Part("t/new", sum(p.n_rows for p in parts)),), parts)}

    assert log.commit(rewrite).tables == {"t": (Part("t/new", 5),)} and calls == [0, 1]

    # A load of another table in between does no harm.
    def once(snapshot):
        log.commit(lambda s: {"u": Edit("append", (Part("u/1", 1),))})
        return {"t": Edit("rewrite", (Part("t/newer", 5),), snapshot.parts("t"))}

    assert log.commit(once).tables == {"t": (Part("t/newer", 5),), "u": (Part("u/1", 1),)}

    def never(snapshot):
        log.commit(lambda s: {"t": Edit("append", (Part(f"t/{uuid.uuid4().hex}", 1),))})
        return {"t": Edit("rewrite", (), snapshot.parts("t"))}

    with pytest.raises(CommitConflict):
        log.commit(never)


# --- loads ---------------------------------------------------------------------------------------


def test_an_append_writes_once(spark, place):
    staged = stage(ids(spark, 0, 10, files=2), T1, *place)
    before = files(place)
    bulk_load(staged, T1, place[0])
    assert files(place) == before and both(spark, place) == [(i, "old") for i in range(10)]
    bulk_load(stage(ids(spark, 10, 20), T1, *place), T1, place[0])
    assert len(both(spark, place)) == 20 and [p.n_rows for p in log_of(spark, *place).latest().parts("t1")] == [10, 10]


def test_loads_that_cross_lose_nothing(spark, place, monkeypatch):
    """A merge and an append that are worked out from the same version, then committed one after the other."""
    bulk_load(stage(ids(spark, 0, 10), T1, *place), T1, place[0])
    plain, others = tables._merged, [1]

    def interrupted(*args):
        made = plain(*args)
        while others:
            others.pop()
            bulk_load(stage(ids(spark, 8, 14, "appended"), T1, *place), T1, place[0])
            execute_merge(stage(ids(spark, 0, 2, "merged first"), T1, *place), T1, *place)
        return made

    monkeypatch.setattr(tables, "_merged", interrupted)
    execute_merge(stage(ids(spark, 1, 9, "merged"), T1, *place), T1, *place)
    want = [(0, "merged first")] + [(i, "merged") for i in range(1, 9)] + [(9, "appended"), (9, "old")] + [(i, "appended") for i in range(10, 14)]
    assert both(spark, place) == sorted(want)


def test_threads_that_merge_at_once(spark, place):
    bulk_load(stage(ids(spark, 0, 40), T1, *place), T1, place[0])
    staged = [stage(ids(spark, 10 * k, 10 * k + 5, f"m{k}"), T1, *place) for k in range(4)]
    threads = [threading.Thread(target=execute_merge, args=(s, T1, *place)) for s in staged]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    show_last(spark, place[0], [T1], place[1])
    assert both(spark, place) == sorted((i, f"m{i // 10}" if i % 10 < 5 else "old") for i in range(40))


def test_a_dataset_appears_whole(spark, place, monkeypatch):
    spec = DatasetSpec("d", "merge", {"a": T1, "b": T2}, place[0])
    frames = {"a": ids(spark, 0, 3), "b": spark.createDataFrame([("x", 1)], "code string, n int")}
    run_dataset(spark, spec, lambda: frames, place[1], AS_OF, {"etag": "1"})
    log = log_of(spark, *place)
    first = log.latest()
    # Both tables and the run's state came with one commit.
    assert first.version == 1 and {t: sum(p.n_rows for p in parts) for t, parts in first.tables.items()} == {"t1": 3, "t2": 1, INGESTION_STATE.name: 1}

    def broken(*args, **settings):
        raise OSError("no space left")

    monkeypatch.setattr(pipeline, "state_edit", broken)
    more = {"a": ids(spark, 2, 5, "new"), "b": spark.createDataFrame([("y", 2)], "code string, n int")}
    with pytest.raises(OSError):
        run_dataset(spark, spec, lambda: more, place[1], AS_OF, {"etag": "2"})
    assert both(spark, place) == [(0, "old"), (1, "old"), (2, "old")] and both(spark, place, T2) == [("x", 1)]
    assert rows(spark.table(f"{place[0]}.{INGESTION_STATE.name}").select("status", "last_watermark")) == [("FAILED", '{"etag": "1"}')]
    monkeypatch.undo()
    assert load_tables(spark, spec, more, place[1]) == {"t1": 3, "t2": 1}
    assert both(spark, place) == [(0, "old"), (1, "old"), (2, "new"), (3, "new"), (4, "new")]


def test_an_earlier_version(spark, place):
    bulk_load(stage(ids(spark, 0, 3), T1, *place), T1, place[0])
    bulk_load(stage(ids(spark, 5, 6), T1, *place), T1, place[0], "overwrite")
    assert rows(read_table(spark, place[0], T1, place[1], version=1)) == [(0, "old"), (1, "old"), (2, "old")]
    assert both(spark, place) == [(5, "old")]


def test_a_new_session_sees_the_log(spark, place):
    bulk_load(stage(ids(spark, 0, 3), T1, *place), T1, place[0])
    spark.sql(f"DROP VIEW {table_name(place[0], T1)}")
    ensure_tables(spark, place[0], [T1], place[1])
    assert len(both(spark, place)) == 3


# --- merges --------------------------------------------------------------------------------------


def spoil(place, but):
    """Makes all data files but these unreadable."""
    for p in Path(place[1], place[0], "t1").rglob("part-*.parquet"):
        if p.name not in but:
            os.chmod(p, 0o644)
            p.write_bytes(b"spoilt")
            crc = p.with_name(f".{p.name}.crc")
            if crc.exists():
                crc.unlink()


def test_a_merge_neither_reads_nor_writes_other_files(spark, place):
    for k in range(4):
        bulk_load(stage(ids(spark, 100 * k, 100 * k + 100, files=2), T1, *place), T1, place[0])
    log = log_of(spark, *place)
    before, was = log.latest().parts("t1"), files(place)
    changes = stage(ids(spark, 240, 245, "new").unionByName(ids(spark, 900, 902, "new")), T1, *place)
    own = {e.name for e in log.storage.entries(changes.folder)}
    third = {n: f for n, f in json.loads(log.storage.read(f"{before[2].folder}/_files.json")).items()}
    touched = [n for n, (_, low, high) in third.items() if low <= 240 <= high]
    assert len(third) == 2 and len(touched) == 1
    spoil(place, own | set(touched))
    merge = lambda s: {"t1": tables.edit_of(changes, T1, place[0], "merge", s.parts("t1"))}
    after = log.commit(merge).parts("t1")
    assert (after[0], after[1], after[3]) == (before[0], before[1], before[3])
    assert after[2] == Part(before[2].folder, 50, tuple(touched))
    # What stays of the touched file is new, the staged files are the rest.
    assert [p.n_rows for p in after[4:]] == [45, 7] and after[5].folder == changes.folder
    now = files(place)
    assert len(now) == len(was) + len([n for n in own if n.endswith(".parquet")]) + len(list(Path(place[1], place[0], after[4].folder).glob("*.parquet")))


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "double"])
def test_ranges_of_other_keys(spark, place, kind):
    """Files are told apart by what a key's rank says, which may only rise with the key."""
    spec = TableSpec("t3", {"k": {"string": "TEXT", "date": "DATE", "timestamp": "TIMESTAMPTZ", "double": "DOUBLE"}[kind], "v": "TEXT"}, ("k",))
    ensure_tables(spark, place[0], [spec], place[1])
    key = {"string": "concat('ключ', lpad(id, 4, '0'), 'é')", "date": "date_add(date'1969-12-01', cast(id AS int))", "timestamp": "timestamp_seconds(id * 86400 - 1000000)", "double": "id / 7"}[kind]
    load = lambda low, high, v: stage(spark.range(low, high).selectExpr(f"{key} AS k", f"'{v}' AS v").unionByName(spark.sql(f"SELECT cast(NULL AS {spec.schema['k'].dataType.simpleString()}) AS k, '{v}' AS v")), spec, *place)
    for k in range(3):
        bulk_load(load(20 * k, 20 * k + 20, "old"), spec, place[0])
    execute_merge(load(15, 25, "new"), spec, *place)
    found = read_table(spark, place[0], spec, place[1]).groupBy("v").count()
    # A null key matches nothing, so such rows are all there.
    assert rows(found) == [("new", 11), ("old", 60 - 10 + 3)]
    left = log_of(spark, *place).latest().parts("t3")
    assert sum(p.n_rows for p in left) == 64


def test_a_merge_resolves_repeated_keys_and_replaces_groups(spark, place):
    pages = TableSpec("pages", {"doc": "TEXT", "page": "INTEGER", "text": "TEXT"}, ("doc", "page"), replaced_by=("doc",))
    ensure_tables(spark, place[0], [pages], place[1])
    put = lambda data, **settings: execute_merge(stage(spark.createDataFrame(data, "doc string, page int, text string").coalesce(1), pages, *place), pages, *place, **settings)
    put([("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x")])
    put([("c", 1, "x")])
    put([("a", 1, "y"), ("a", 1, "z")], on_duplicate="last", order=("text",))
    assert both(spark, place, pages) == [("a", 1, "z"), ("b", 1, "x"), ("c", 1, "x")]
    with pytest.raises(ValueError, match="several rows"):
        put([("b", 1, "y"), ("b", 1, "z")])
    assert both(spark, place, pages) == [("a", 1, "z"), ("b", 1, "x"), ("c", 1, "x")]


def test_many_merges_against_a_dictionary(spark, place):
    want = {}
    for k in range(6):
        own = {i: f"v{k}" for i in range(k * 7, k * 7 + 15)}
        want |= own
        execute_merge(stage(spark.createDataFrame(list(own.items()), "id long, name string").repartition(3), T1, *place), T1, *place)
    assert both(spark, place) == sorted(want.items())
    n = len(log_of(spark, *place).latest().parts("t1"))
    compact(spark, place[0], T1, place[1])
    assert both(spark, place) == sorted(want.items()) and len(log_of(spark, *place).latest().parts("t1")) == 1 < n


# --- expiry --------------------------------------------------------------------------------------


def test_expiry_keeps_last_and_leased_versions(spark, place):
    log = log_of(spark, *place)
    for k in range(4):
        execute_merge(stage(ids(spark, k, 10, f"v{k}", files=1), T1, *place), T1, *place)
    under_way = stage(ids(spark, 50, 60), T1, *place)
    want = {v: rows(read_table(spark, place[0], T1, place[1], v)) for v in log.versions()}
    with log.leased(2) as held:
        assert held.version == 2
        removed = log.expire(keep=1, grace_seconds=0)
        # No grace: even the load under way is gone, as are versions 1 and 3.
        assert under_way.folder in removed and log.versions() == [2, 4]
        for v in (2, 4):
            assert rows(read_table(spark, place[0], T1, place[1], v)) == want[v]
    assert log.storage.entries("_log/leases") == []
    loaded = stage(ids(spark, 50, 60), T1, *place)
    assert log.expire(keep=1) == [] and log.versions() == [4]  # younger than the grace period
    log.expire(keep=1, grace_seconds=0)
    assert both(spark, place) == want[4]
    assert not log.storage.exists(loaded.folder)
    with pytest.raises(Exception):
        log.snapshot(2)
    with pytest.raises(Exception):
        with log.leased(2):
            pass


def test_expiry_removes_replaced_files_of_kept_folders(spark, place):
    bulk_load(stage(ids(spark, 0, 100, files=2), T1, *place), T1, place[0])
    execute_merge(stage(ids(spark, 0, 5, "new"), T1, *place), T1, *place)
    log = log_of(spark, *place)
    part = log.latest().parts("t1")[0]
    assert len(part.without) == 1
    assert log.expire(keep=2) == []
    assert log.expire(keep=1) == [f"{part.folder}/{part.without[0]}"]
    assert both(spark, place) == sorted([(i, "new") for i in range(5)] + [(i, "old") for i in range(5, 100)])


def test_a_lease_that_ran_out_holds_nothing(spark, place):
    bulk_load(stage(ids(spark, 0, 3), T1, *place), T1, place[0])
    log = log_of(spark, *place)
    with log.leased(1, seconds=-1):
        bulk_load(stage(ids(spark, 5, 6), T1, *place), T1, place[0], "overwrite")
        log.expire(keep=1, grace_seconds=0)
        assert log.versions() == [2]
