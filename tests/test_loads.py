import io
import json
import uuid
import zipfile
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from regtables.operators.sizing import _CLEANUP, shuffles_released
from regtables.operators.upsert import last_of_files, one_row_per_key, without_keys
from regtables.plans.datasets import (
    ADVERSE_EVENT_COLUMNS, APPROVAL_COLUMNS, OLD_APPROVAL_COLUMNS, adverse_events, approval_records, approval_rows, approval_tables, approvals, package_inserts, review_reports,
)
from regtables.plans.pipeline import LostInputError, ValidationError, load_tables, run_dataset, run_sources
from regtables.plans.specs import (
    ADVERSE_EVENTS, APPROVALS, DATASETS, PACKAGE_INSERTS, REVIEW_REPORTS, DatasetSpec, TableSpec, with_config,
)
from regtables.plans.types import is_required, schema_of, spark_type, store_type
from regtables.sinks.state import get_watermark, latest_state, list_states, read_states, run_row, upsert_state
from regtables.sources.archives import archive_tables
from regtables.sinks.tables import bulk_load, ensure_tables, execute_merge, log_of, merge_statement, stage, table_name, write_jdbc
from regtables.streaming.intake import read_new_files, stream_upsert

AS_OF = datetime(2025, 9, 10, 12, 0, tzinfo=timezone.utc)
T1 = TableSpec("t1", {"id": "INTEGER", "name": "TEXT", "email": "VARCHAR(50)"}, ("id",))


@pytest.fixture
def place(spark, tmp_path):
    return f"s_{uuid.uuid4().hex[:8]}", str(tmp_path / "root")


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order or df.columns).collect()]


# --- types and specs ---------------------------------------------------------------------------


def test_types():
    assert spark_type("VARCHAR(64) NOT NULL") == T.StringType() and is_required("VARCHAR(64) NOT NULL")
    assert spark_type("TIMESTAMPTZ") == T.TimestampType() and spark_type("whatever") == T.StringType()
    assert schema_of({"a": "INTEGER", "b": "DATE NOT NULL"}) == T.StructType(
        [T.StructField("a", T.IntegerType()), T.StructField("b", T.DateType(), False)]
    )
    assert [store_type("JSONB", s) for s in ("postgres", "redshift", "bigquery")] == ["JSONB", "SUPER", "JSON"]
    assert [store_type("VARCHAR(50)", s) for s in ("postgres", "redshift", "bigquery")] == ["VARCHAR(50)", "VARCHAR(50)", "STRING"]
    assert store_type("OTHER", "bigquery") == "STRING"


def test_specs():
    assert set(DATASETS) == {"approvals", "adverse_events", "package_inserts", "review_reports", "xml_report"}
    assert {"column": "drug_id", "check": "not_null"} in ADVERSE_EVENTS.tables["DRUG"].all_rules
    with pytest.raises(ValueError, match="load mode"):
        DatasetSpec("d", "delta")
    with pytest.raises(ValueError, match="primary key"):
        DatasetSpec("d", "merge", {"t": TableSpec("t", {"a": "TEXT"})})
    changed = with_config(APPROVALS, {"schema_name": "x", "load_mode": "merge", "table_name": "y", "primary_key": ["approval_date"], "validation": []})
    table = changed.tables["approvals"]
    assert (changed.schema_name, changed.load_mode, table.name, table.primary_key, table.rules) == ("x", "merge", "y", ("approval_date",), ())
    changed = with_config(ADVERSE_EVENTS, {"tables": {"DEMO": {"table_name": "z"}}})
    assert changed.tables["DEMO"].name == "z" and changed.tables["DRUG"] == ADVERSE_EVENTS.tables["DRUG"]


# --- load modes --------------------------------------------------------------------------------


def test_load_modes(spark, place):
    schema, root = place
    ensure_tables(spark, schema, [T1, TableSpec("nothing", {})], root)
    ensure_tables(spark, schema, [T1], root)
    table = table_name(schema, T1)
    assert spark.table(table).count() == 0 and not spark.catalog.tableExists(f"{schema}.nothing")
    # Columns come in another order; names count.
    data = spark.createDataFrame([("a@x", 1, "A"), ("b@x", 2, "B")], "email string, id int, name string")
    first = stage(data, T1, schema, root)
    assert first.n_rows == 2
    assert bulk_load(first, T1, schema, "append") == 2 and bulk_load(first, T1, schema, "append") == 2
    assert rows(spark.table(table)) == [(1, "A", "a@x")] * 2 + [(2, "B", "b@x")] * 2
    assert bulk_load(first, T1, schema, "overwrite") == 2
    assert rows(spark.table(table)) == [(1, "A", "a@x"), (2, "B", "b@x")]
    none = stage(data.where("false"), T1, schema, root)
    assert bulk_load(none, T1, schema, "overwrite") == 0 and execute_merge(none, T1, schema, root) == 0
    assert spark.table(table).count() == 2
    with pytest.raises(ValueError, match="append.*overwrite"):
        bulk_load(first, T1, schema, "replace")
    changes = stage(spark.createDataFrame([(2, "new"), (3, "C")], "id int, name string"), T1, schema, root)
    for _ in range(2):
        assert execute_merge(changes, T1, schema, root) == 2
        assert rows(spark.table(table)) == [(1, "A", "a@x"), (2, "new", None), (3, "C", None)]
    with pytest.raises(ValueError, match="needs key"):
        execute_merge(changes, T1, schema, root, keys=[])
    twice = stage(spark.createDataFrame([(2, "x"), (2, "y")], "id int, name string"), T1, schema, root)
    with pytest.raises(ValueError, match="several rows"):
        execute_merge(twice, T1, schema, root)
    # Overwritten versions stay until nobody reads them, and an append goes to the current one.
    assert bulk_load(first, T1, schema, "append") == 2 and spark.table(table).count() == 5


def test_bucketed_merge_shuffles_the_source_only(spark, place):
    schema, root = place
    spec = TableSpec("t1", dict(T1.columns), ("id",), buckets=4)
    ensure_tables(spark, schema, [spec], root)
    table = table_name(schema, spec)
    data = spark.range(100).selectExpr("id", "concat('n', id) AS name", "'e' AS email")
    assert bulk_load(stage(data, spec, schema, root), spec, schema, "overwrite") == 100
    source = data.where("id % 2 = 0").withColumn("name", F.lit("new")).unionByName(data.withColumn("id", F.col("id") + 1000))
    staged = stage(source, spec, schema, root)
    # More source rows than may be broadcast: the table is joined bucket by bucket.
    with_hint = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = without_keys(spark.table(table), staged.rows, ["id"], few=False)
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_hint)
    target_side, source_side = plan.split("LeftAnti")[1].split("Location", 1)
    assert "Bucketed: true" in target_side and "Exchange" not in target_side and "Exchange" in source_side
    for _ in range(2):
        assert execute_merge(staged, spec, schema, root) == 150
        got = spark.table(table)
        assert got.count() == 200 and got.where("name = 'new'").count() == 50
    bulk_load(stage(data.limit(1), spec, schema, root), spec, schema, "append")
    assert spark.table(table).count() == 201
    assert spark.sql(f"SHOW TABLES IN `{schema}`").count() == 1


def test_merge_statement(spark):
    text = merge_statement("a.t", "a.s", ["id", "v"], ["id"])
    assert spark._jsparkSession.sessionState().sqlParser().parsePlan(text) is not None
    assert "UPDATE SET t.`v` = s.`v`" in text and "ON t.`id` = s.`id`" in text
    with pytest.raises(ValueError, match="all columns are keys"):
        merge_statement("a.t", "a.s", ["id"], ["id"])


def test_jdbc_mode(spark):
    with pytest.raises(ValueError, match="append.*overwrite"):
        write_jdbc(spark.range(1), "jdbc:none", "t", "merge")


# --- state -------------------------------------------------------------------------------------


def test_state(spark):
    def run(name, hour, status, token):
        return run_row(spark, name, AS_OF.replace(hour=hour), status, token, "1.0")

    states = run("a", 1, "SUCCESS", {"etag": "1"}).unionByName(run("b", 1, "FAILED", {}))
    states = upsert_state(states, run("a", 2, "FAILED", {"etag": "1"}))
    states = upsert_state(states, run("c", 3, "SUCCESS", {"u": {"etag": "薬"}}))
    assert rows(list_states(states)) == [
        ("a", "FAILED", "2025-09-10 02:00:00", "2025-09-10 01:00:00", "1.0"),
        ("b", "FAILED", "2025-09-10 01:00:00", "", "1.0"),
        ("c", "SUCCESS", "2025-09-10 03:00:00", "2025-09-10 03:00:00", "1.0"),
    ]
    assert json.loads(latest_state(states, "c").first().last_watermark) == {"u": {"etag": "薬"}}
    assert latest_state(states, "none").count() == 0


# --- datasets ----------------------------------------------------------------------------------

APPROVAL_ROWS = [
    (0, "1", "医薬品", "Drug A", "Corp A", "Generic A", "令和7年1月1日"),
    (1, "2", "医療機器", "Drug B", "Corp B", "Generic B1", "令和7年2月2日"),
    (2, "2", "医療機器", "Drug B", "Corp B", "Generic B2", "令和7年2月2日"),
]


def _approvals(spark, data=APPROVAL_ROWS):
    columns = ["row_no", "approval_id", "application_type", "brand_name_jp", "applicant_name_jp", "generic_name_jp", "approval_date"]
    df = spark.createDataFrame(data, "row_no int, " + ", ".join(f"{c} string" for c in columns[1:]))
    return approval_tables(df, "https://h.org/a.xlsx", AS_OF, order=("row_no",))


def test_approvals_run(spark, place):
    spec = with_config(APPROVALS, {"schema_name": place[0]})
    loaded = run_dataset(spark, spec, lambda: _approvals(spark), place[1], AS_OF, {"etag": "1"})
    assert loaded == {"approvals": 2, "approval_records": 3}
    table = spark.table(table_name(place[0], spec.tables["approvals"]))
    assert table.columns == list(APPROVALS.tables["approvals"].columns)
    one, two = table.orderBy("approval_id").collect()
    assert (one.approval_id, one.brand_name_jp, one.approval_date, one.indication) == (1, "Drug A", date(2025, 1, 1), None)
    assert two.generic_name_jp == "Generic B1\nGeneric B2" and two.brand_name_jp == "Drug B"
    records = spark.table(table_name(place[0], spec.tables["records"])).where("approval_id = '2'").orderBy("source_order").collect()
    assert [json.loads(r.raw_data_full)["generic_name_jp"] for r in records] == ["Generic B1", "Generic B2"]
    assert two._meta_source_url == "https://h.org/a.xlsx" and len(two._meta_source_content_hash) == 64

    # The same source again is not built.
    assert run_dataset(spark, spec, lambda: 1 / 0, place[1], AS_OF.replace(hour=13), {"etag": "1"}) == {}
    assert get_watermark(spark, place[0], "approvals") == {"etag": "1"}

    # A null id breaks the rules: nothing is published, the failure is recorded, the last success stays.
    bad = [*APPROVAL_ROWS, (3, None, "その他", "X", "C", "G", "令和7年1月1日")]
    with pytest.raises(ValidationError, match="Data validation failed for table 'approvals'") as problem:
        run_dataset(spark, spec, lambda: _approvals(spark, bad), place[1], AS_OF.replace(hour=14), {"etag": "2"})
    assert "has 1 null values" in str(problem.value) and "[その他]" in str(problem.value)
    assert table.sparkSession.table(table_name(place[0], spec.tables["approvals"])).count() == 2
    assert rows(spark.table(f"{place[0]}.rule_values")) == [("approvals", "application_type", "その他", 1)]
    assert rows(list_states(read_states(spark, place[0]))) == [
        ("approvals", "FAILED", "2025-09-10 14:00:00", "2025-09-10 13:00:00", "0.1.0")
    ]
    assert get_watermark(spark, place[0], "approvals") == {"etag": "1"}


def test_approval_sheets(spark):
    head = ["No.", "申請区分", "販 売\n名", "一般名", "申請者名", "承認年月日", "備考"]
    lines = [["題", *[None] * 6], head, ["1", "医薬品", "A", "g1", "c", "2025/1/2", None], [None] * 7, [None, None, None, "g2", "c", None, "r"]]
    grid = spark.createDataFrame([("f", i, c) for i, c in enumerate(lines)], "file string, row_no long, cells array<string>")
    records = approval_records(grid)
    assert records.columns == ["file", "row_no", *APPROVAL_COLUMNS.values()]
    row = approvals(records, "u", AS_OF).collect()
    assert [(r.approval_id, r.brand_name_jp, r.generic_name_jp, r.approval_date) for r in row] == [(1, "A", "g1\ng2", date(2025, 1, 2))]
    with pytest.raises(ValueError, match="f: no header"):
        approval_records(grid.where("row_no <> 1"))
    short = grid.withColumn("cells", F.slice("cells", 1, 5))
    with pytest.raises(ValueError, match="f: missing columns: 承認年月日"):
        approval_records(short)


def test_old_approval_layout(spark):
    head = list(OLD_APPROVAL_COLUMNS)
    lines = [head, ["9", "医薬品", "A", "g", "c", "令和7年9月8日", "効能", "https://h.org/r.pdf"]]
    grid = spark.createDataFrame([("f", i, c) for i, c in enumerate(lines)], "file string, row_no long, cells array<string>")
    row = approvals(approval_records(grid, OLD_APPROVAL_COLUMNS), "u", AS_OF).first()
    assert (row.approval_id, row.indication, row.review_report_url) == (9, "効能", "https://h.org/r.pdf")
    single = approval_rows(approval_records(grid, OLD_APPROVAL_COLUMNS), "u", AS_OF).first()
    assert (single.approval_id, single.approval_date, single.review_report_url) == ("9", date(2025, 9, 8), "https://h.org/r.pdf")
    raw = json.loads(single.raw_data_full)
    assert raw["source_file_name"] == "f" and raw["original_values"]["approval_date"] == "令和7年9月8日"


def _case_frames(spark, ids):
    def frame(stem, values):
        names = list(ADVERSE_EVENT_COLUMNS[stem])
        data = [tuple([i, *values(i), *[None] * (len(names) - 1 - len(values(i)))]) for i in ids]
        return spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names))

    return {
        "DEMO": frame("DEMO", lambda i: ["男性", "30代"]),
        "DRUG": frame("DRUG", lambda i: ["被疑薬", "テスト"]),
        "REAC": frame("REAC", lambda i: ["めまい", "20250101"]),
        "HIST": frame("HIST", lambda i: ["高血圧"]),
    }


def test_adverse_events(spark, place):
    spec = with_config(ADVERSE_EVENTS, {"schema_name": place[0]})

    def run(frames, token):
        return run_dataset(spark, spec, lambda: adverse_events(frames, "u", AS_OF), place[1], AS_OF, {"etag": token})

    assert run(_case_frames(spark, ["1", "2"]), "1") == {"adverse_demo": 2, "adverse_drug": 2, "adverse_reac": 2, "adverse_hist": 2}
    changed = _case_frames(spark, ["2", "3"])
    changed["DEMO"] = changed["DEMO"].withColumn("性別", F.lit("女性"))
    changed["HIST"] = changed["HIST"].where("false")
    assert run(changed, "2") == {"adverse_demo": 2, "adverse_drug": 2, "adverse_reac": 2}

    def get(key):
        return spark.table(table_name(place[0], spec.tables[key]))

    assert rows(get("DEMO").select("identification_number", "gender")) == [("1", "男性"), ("2", "女性"), ("3", "女性")]
    assert {k: get(k).count() for k in spec.tables} == {"DEMO": 3, "DRUG": 3, "REAC": 3, "HIST": 2}
    reac = get("REAC").where("identification_number = '1'").first()
    assert reac.onset_date == date(2025, 1, 1) and len(reac.reac_id) == 64
    assert json.loads(reac.raw_data_full) == {"識別番号": "1", "副作用名": "めまい", "発現日": "20250101"}
    assert get("DRUG").join(get("DEMO"), "identification_number", "left_anti").count() == 0


def test_no_table_is_published_if_one_fails(spark, place):
    spec = with_config(ADVERSE_EVENTS, {"schema_name": place[0]})
    frames = _case_frames(spark, ["1"])
    frames["HIST"] = frames["HIST"].withColumn("識別番号", F.lit(None).cast("string"))
    with pytest.raises(ValidationError, match="adverse_hist"):
        run_dataset(spark, spec, lambda: adverse_events(frames, "u", AS_OF), place[1], AS_OF)
    assert all(spark.table(table_name(place[0], t)).count() == 0 for t in spec.tables.values())
    with pytest.raises(ValueError, match="load mode"):
        load_tables(spark, spec, {}, place[1], mode="full")


def test_runs_that_end_together_both_keep_their_state(spark, place, monkeypatch):
    from regtables.plans.specs import INGESTION_STATE
    from regtables.sinks import state

    ensure_tables(spark, place[0], [INGESTION_STATE], place[1])
    row = lambda name: run_row(spark, name, AS_OF, "SUCCESS", {}, "1")
    plain, others = state.stage, ["b"]

    def interrupted(*args):
        staged = plain(*args)
        while others:
            state.save_run(spark, place[0], place[1], row(others.pop()))
        return staged

    monkeypatch.setattr(state, "stage", interrupted)
    state.save_run(spark, place[0], place[1], row("a"))
    assert rows(read_states(spark, place[0]).select("dataset_id")) == [("a",), ("b",)]


def test_unreadable_inputs_are_no_success(spark, place):
    spec = with_config(ADVERSE_EVENTS, {"schema_name": place[0]})
    inputs = spark.createDataFrame([("a.zip", "DEMO", "ok"), ("b.zip", "DEMO", "unreadable")], "archive string, stem string, status string")
    build = lambda: adverse_events(_case_frames(spark, ["1"]), "u", AS_OF)
    with pytest.raises(LostInputError, match="1 inputs"):
        run_dataset(spark, spec, build, place[1], AS_OF, {"etag": "1"}, account=lambda: inputs)
    assert spark.table(table_name(place[0], spec.tables["DEMO"])).count() == 0
    assert [r.status for r in latest_state(read_states(spark, place[0]), "adverse_events").collect()] == ["FAILED"]
    # Allowed, the rest is loaded and the watermark stays where it was, so the next run reads the source again.
    assert run_dataset(spark, spec, build, place[1], AS_OF, {"etag": "1"}, account=lambda: inputs, allow_lost=True)["adverse_demo"] == 1
    assert not get_watermark(spark, place[0], "adverse_events")
    assert spark.table(f"{place[0]}.run_inputs").where("status = 'unreadable'").count() == 2


REVIEW = "販売名: テスト錠\n申請者名: テスト製薬\n申請年月日: 令和7年1月15日\n承認年月日: 2025年9月10日\n審査の概要\n本文\n2. 次"


PAGES = "url string, page_no int, text string, tables array<array<array<string>>>"


def test_documents(spark, place):
    pages = spark.createDataFrame([("u1", 1, REVIEW, [[["a"], ["1"]]]), ("u2", 1, "", [[["a"], ["2"]]]), ("u3", 1, "", []), ("u4", 1, None, None)], PAGES)
    spec = with_config(REVIEW_REPORTS, {"schema_name": place[0]})
    assert run_dataset(spark, spec, lambda: review_reports(pages, AS_OF), place[1], AS_OF) == {"review_reports": 1, "review_report_pages": 1}
    row = spark.table(table_name(place[0], spec.tables["review_reports"])).first()
    assert (row.brand_name_jp, row.generic_name_jp, row.applicant_name_jp, row.n_pages) == ("テスト錠", None, "テスト製薬", 1)
    assert (row.application_date, row.approval_date, row.review_summary_text) == (date(2025, 1, 15), date(2025, 9, 10), "本文")
    page = spark.table(table_name(place[0], spec.tables["pages"])).first()
    assert (page.page_text, page.page_tables) == (REVIEW, '[[["a"],["1"]]]')
    inserts = package_inserts(pages, AS_OF)["package_inserts"]
    assert inserts.columns == list(PACKAGE_INSERTS.tables["package_inserts"].columns)
    assert rows(inserts.select("_meta_source_url")) == [("u1",), ("u2",)]


def test_fields_are_read_from_whichever_page_has_them(spark):
    lines = REVIEW.split("\n")
    pages = spark.createDataFrame([("u", i, line, None) for i, line in enumerate(lines)], PAGES).repartition(5)
    one = review_reports(spark.createDataFrame([("u", 0, REVIEW, None)], PAGES), AS_OF)["review_reports"].first()
    many = review_reports(pages, AS_OF)["review_reports"].first()
    fields = ["brand_name_jp", "generic_name_jp", "applicant_name_jp", "application_date", "approval_date", "review_summary_text"]
    assert [one[f] for f in fields] == [many[f] for f in fields]
    assert many.n_pages == len(lines) and many._meta_source_content_hash != one._meta_source_content_hash


def test_a_document_that_got_shorter_leaves_no_old_page(spark, place):
    spec = with_config(PACKAGE_INSERTS, {"schema_name": place[0]})
    first = [("u1", i, f"page {i}", None) for i in range(5)] + [("u2", 1, "z", None)]
    tables = package_inserts(spark.createDataFrame(first, PAGES), AS_OF)
    assert load_after_ensure(spark, spec, tables, place[1]) == {"package_inserts": 2, "package_insert_pages": 6}
    again = package_inserts(spark.createDataFrame([("u1", 0, "only", [[["h"], ["v"]]])], PAGES), AS_OF)
    load_tables(spark, spec, again, place[1])
    found = spark.table(table_name(place[0], spec.tables["pages"])).collect()
    assert sorted((r.page_text, r.page_tables) for r in found if r.page_tables) == [("only", '[[["h"],["v"]]]')]
    assert sorted(r.page_text for r in found) == ["only", "z"]


def load_after_ensure(spark, spec, tables, root):
    ensure_tables(spark, spec.schema_name, list(spec.tables.values()), root)
    return load_tables(spark, spec, tables, root)


# --- streaming ---------------------------------------------------------------------------------


def test_stream(spark, place, tmp_path):
    schema, root = place
    spec = TableSpec("t1", dict(T1.columns), ("id",), ({"column": "name", "check": "not_null"},))
    ensure_tables(spark, schema, [spec], root)
    folder = str(tmp_path / "in")

    def arrive(data):
        spark.createDataFrame(data, "id int, name string").coalesce(1).write.mode("append").parquet(folder)

    def run(transform=None):
        stream = read_new_files(spark, folder, T1.schema, glob="*.parquet")
        stream_upsert(stream, spec, schema, root, str(tmp_path / "cp"), transform)
        return rows(spark.table(table_name(schema, spec)).select("id", "name"))

    arrive([(1, "a"), (2, "b")])
    assert run() == [(1, "a"), (2, "b")]
    arrive([(2, "c"), (3, "d")])
    assert run() == run() == [(1, "a"), (2, "c"), (3, "d")]
    # A bad batch stops the stream and waits for the next run.
    arrive([(4, None)])
    with pytest.raises(Exception, match="null values"):
        run()
    assert run(lambda df: df.fillna("fixed")) == [(1, "a"), (2, "c"), (3, "d"), (4, "fixed")]


# --- source by source --------------------------------------------------------------------------


def test_only_changed_sources_are_built(spark, place):
    spec = with_config(PACKAGE_INSERTS, {"schema_name": place[0]})
    seen = []

    def run(tokens, pages, as_of=AS_OF, **settings):
        sources = spark.createDataFrame([(u, t, None) for u, t in tokens.items()], "url string, etag string, last_modified string")
        df = spark.createDataFrame([(u, i, x, None) for u, own in pages.items() for i, x in enumerate(own)], PAGES)

        def build(changed):
            seen.append(sorted(r.url for r in changed.collect()))
            return package_inserts(df.join(changed.select("url"), "url", "left_semi"), as_of)

        return run_sources(spark, spec, sources, settings.get("build", build), place[1], as_of)

    def found():
        pages = spark.table(table_name(place[0], spec.tables["pages"])).select("page_text")
        documents = spark.table(table_name(place[0], spec.tables["package_inserts"])).select("_meta_source_url", "n_pages")
        return sorted(r.page_text for r in pages.collect()), rows(documents)

    first = {"a": ["a1", "a2"], "b": ["b1"], "c": ["c1", "c2", "c3"]}
    assert run({"a": "1", "b": "1", "c": "1"}, first) == {"package_inserts": 3, "package_insert_pages": 6}
    assert run({"a": "1", "b": "1", "c": "1"}, {}) == {} and len(seen) == 1
    # b changed, c has no pages any more, d is new, e has no token; a is not even looked at.
    more = {"a": ["never"], "b": ["b9"], "d": ["d1"], "e": ["e1"]}
    assert run({"a": "1", "b": "2", "c": "2", "d": "1", "e": None}, more) == {"package_inserts": 3, "package_insert_pages": 3}
    assert seen[1] == ["b", "c", "d", "e"]
    state = found()
    assert state == (["a1", "a2", "b9", "d1", "e1"], [("a", 2), ("b", 1), ("d", 1), ("e", 1)])
    # A source without a token always counts as changed.
    assert run({"e": None}, {"e": ["e2"]}) == {"package_inserts": 1, "package_insert_pages": 1} and seen[2] == ["e"]

    with pytest.raises(ZeroDivisionError):
        run({"a": "2"}, {}, build=lambda changed: 1 / 0)
    assert rows(list_states(read_states(spark, place[0])).select("status")) == [("FAILED",)]
    # It is built by the next run, as its token was not stored.
    assert run({"a": "2"}, {"a": ["a9"]}) and seen[3] == ["a"] and found()[0] == ["a9", "b9", "d1", "e2"]
    tokens = spark.table(f"{place[0]}.source_state").select("url", "etag")
    assert rows(tokens.where("url <> 'e'")) == [("a", "2"), ("b", "2"), ("c", "2"), ("d", "1")]


def test_the_account_of_archives_comes_with_their_tables(spark, place, tmp_path):
    spec = with_config(ADVERSE_EVENTS, {"schema_name": place[0]})

    def write(name, members):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for stem, names in members.items():
                z.writestr(f"{stem}.csv", ",".join(names) + "\n" + ",".join("1" for _ in names) + "\n")

    write("1.zip", ADVERSE_EVENT_COLUMNS)
    (tmp_path / "2.zip").write_bytes(b"cut off")
    build = lambda: adverse_events(archive_tables(spark, str(tmp_path), ADVERSE_EVENT_COLUMNS), "u", AS_OF)
    with pytest.raises(LostInputError, match="4 inputs"):
        run_dataset(spark, spec, build, place[1], AS_OF, {"etag": "1"})
    assert spark.table(table_name(place[0], spec.tables["DEMO"])).count() == 0
    assert run_dataset(spark, spec, build, place[1], AS_OF, {"etag": "1"}, allow_lost=True)["adverse_demo"] == 1
    assert not get_watermark(spark, place[0], "adverse_events")
    write("2.zip", {"DEMO": ADVERSE_EVENT_COLUMNS["DEMO"]})
    run_dataset(spark, spec, build, place[1], AS_OF, {"etag": "1"}, on_duplicate="last")
    assert get_watermark(spark, place[0], "adverse_events") == {"etag": "1"}
    assert rows(spark.table(f"{place[0]}.run_inputs").groupBy("status").count()) == [("missing", 3), ("ok", 4 + 4 + 5), ("unreadable", 8)]


def test_files_of_a_load_are_compressed_well(spark, place):
    """Hashes in hex and JSON are most of what a load writes."""
    ensure_tables(spark, place[0], [T1], place[1])
    staged = stage(spark.range(20000).select(F.col("id").cast("int").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("name")), T1, *place)
    files = list(Path(staged.location.removeprefix("file:")).glob("*.parquet"))
    assert sum(f.stat().st_size for f in files) < 0.75 * 20000 * 64


def test_last_rows_are_told_by_their_places(spark, tmp_path):
    """The same rows as by moving whole rows; only keys that have other rows still are resolved by these."""
    spec = "cast({} AS string) AS k", "cast(id % 3 AS int) AS a", "if(id % 5 < 2, 'x', NULL) AS b", "cast(id % 2 AS double) - 0.5 AS c", "timestamp_micros(id % 2) AS t"
    for i, key in enumerate(["if(id % 10 < 4, id % 100, id)", "id", "if(id % 7 = 0, NULL, id div 2)", "'hot'"]):
        spark.range(6000).selectExpr(spec[0].format(key), *spec[1:]).repartition(3).write.option("parquet.block.size", 20000).parquet(f"{tmp_path}/{i}")
        source = spark.read.parquet(f"{tmp_path}/{i}")
        for order in ((), ("c", "a", "b", "t")):
            found, expected = last_of_files(source, ["k"], order), one_row_per_key(source, ["k"], "last", order)
            assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
        assert (found is source) == (i == 1)
    # Equal rows: nothing but their places is moved.
    equal = spark.range(6000).selectExpr("cast(id % 4000 AS string) AS k", "id % 4000 AS v").repartition(3)
    equal.write.parquet(f"{tmp_path}/equal")
    found = last_of_files(spark.read.parquet(f"{tmp_path}/equal"), ["k"], ())
    assert "Aggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == rows(equal.distinct())


def test_a_load_leaves_only_the_files_of_its_table(spark, place):
    """Staged rows whose repeated keys were resolved go, and so do shuffle files; the count is of all rows loaded."""
    spec = DatasetSpec("d", "merge", {"t": T1}, place[0])
    df = spark.range(300).selectExpr("cast(id % 200 AS int) AS id", "concat('n', id % 200) AS name")
    before = spark.conf.get(_CLEANUP, None)
    within = []
    for _ in range(2):
        ensure_tables(spark, place[0], [T1], place[1])
        assert load_tables(spark, spec, {"t": df}, place[1], on_duplicate="last") == {"t1": 300}
        within.append(spark.table(table_name(place[0], T1)).count())
    assert within == [200, 200] and spark.conf.get(_CLEANUP, None) == before
    with shuffles_released(spark):
        assert spark.conf.get(_CLEANUP) == "true"
    log = log_of(spark, *place)
    named = {p.folder for v in log.versions() for p in log.snapshot(v).parts("t1")}
    assert {f"t1/{e.name}" for e in log.storage.entries("t1") if e.is_folder} == named
