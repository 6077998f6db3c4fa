import io
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from regtables.plans.datasets import ADVERSE_EVENT_COLUMNS
from regtables.sources.archives import archive_csv, archive_frames, archive_members, archive_tables, decode_files, in_pieces
from regtables.sources.documents import assemble_documents, document_marks, page_links, page_section, page_table_rows
from regtables.sources.files import binary_files, csv_records, with_source_file, xml_nodes, xml_rows


def archive(members, charset="cp932"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text if isinstance(text, bytes) else text.encode(charset))
    return out.getvalue()


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('識別番号,名\n007,"a ""b"", c"\n008,\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("識別番号,名\n009,d\n", encoding="utf-8")
    df = with_source_file(csv_records(spark, str(tmp_path)))
    assert sorted(tuple(r) for r in df.fillna("null").collect()) == [
        ("007", 'a "b", c', "a.csv"), ("008", "null", "a.csv"), ("009", "d", "b.csv"),
    ]


def test_csv_lines_of_other_lengths(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,No.\n1,2\n3\n4,5,\n"a,b",c\n', encoding="utf-8")
    rows = [("1", "2"), ("3", None), ("4", "5"), ("a,b", "c")]
    assert [tuple(r) for r in csv_records(spark, str(tmp_path)).collect()] == rows
    (tmp_path / "b.csv").write_text('x,No.\n6,"7 "" 8",9\n', encoding="utf-8")
    with pytest.raises(Exception, match="more cells than the header: 6"):
        csv_records(spark, str(tmp_path)).collect()
    kept = csv_records(spark, str(tmp_path), bad_line="bad").where("bad is not null")
    assert sorted(r.bad for r in kept.collect()) == ["3", "4,5,", '6,"7 "" 8",9']


@pytest.mark.parametrize("use", [lambda d: d.select("n"), lambda d: d.select("z"), lambda d: d.where("x = '1'"), lambda d: d.groupBy("z").count(), lambda d: d.groupBy().count()])
def test_surplus_cells_are_noticed_whatever_is_read(spark, tmp_path, use):
    (tmp_path / "a.csv").write_text("x,n,z\n1,2,3\n4,5\n", encoding="utf-8")
    assert csv_records(spark, str(tmp_path)).count() == 2 and len(use(csv_records(spark, str(tmp_path))).collect()) in (1, 2)
    (tmp_path / "b.csv").write_text("x,n,z\n6,7,8,9\n", encoding="utf-8")
    with pytest.raises(Exception, match="more cells than the header: 6"):
        use(csv_records(spark, str(tmp_path))).collect()


def test_csv_with_another_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n", encoding="utf-8")
    with pytest.raises(Exception, match="[Hh]eader"):
        csv_records(spark, str(tmp_path)).collect()


XML = """<?xml version="1.0" encoding="UTF-8"?>
<report><meta><date>2025-09-10</date></meta><products>
  <product id="A1"><name>薬A</name><category>C1</category><status approved="true">Approved</status></product>
  <product id="B2"><name>器B</name><status approved="false">Pending</status></product>
</products></report>"""


def test_xml(spark, tmp_path):
    (tmp_path / "r.xml").write_text(XML, encoding="utf-8")
    columns = ["id", "name", "category", "status"]
    df = xml_rows(spark, str(tmp_path), "./products/product", columns)
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("A1", "薬A", "C1", "Approved"), ("B2", "器B", None, "Pending")]
    with pytest.raises(ValueError, match="xpath is required"):
        xml_rows(spark, str(tmp_path), "", columns)
    with pytest.raises(ValueError, match="no node"):
        xml_rows(spark, str(tmp_path), "./products/device", columns)
    assert xml_rows(spark, str(tmp_path), "./device", columns, require_rows=False).count() == 0


def test_xml_files_honour_every_step_and_fail_loudly(spark, tmp_path):
    elsewhere = '<r><other><product id="no"/></other><products><product id="yes"/></products></r>'
    (tmp_path / "a.xml").write_text(elsewhere, encoding="utf-8")
    assert [r.id for r in xml_rows(spark, str(tmp_path), "./products/product", ["id"]).collect()] == ["yes"]
    for name, text in {"broken.xml": '<r><products><product id="1"></products></r>', "cut.xml": '<r><products><product id="1"/>'}.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
        with pytest.raises(Exception, match="(?i)malformed"):
            xml_rows(spark, str(tmp_path), "./products/product", ["id"], require_rows=False).collect()
        (tmp_path / name).write_text("<r/>", encoding="utf-8")


@pytest.mark.parametrize("path", ["./products/product", "/report/products/product", "products/product"])
def test_xml_nodes(spark, path):
    more = XML.replace("</report>", '<products><product id="C3"/></products><x><product id="no"/></x></report>')
    docs = spark.createDataFrame([(1, more), (2, "<report/>")], "n int, text string")
    found = xml_nodes(docs, "text", path, ["id", "name", "status"])
    assert [tuple(r) for r in found.orderBy("id").collect()] == [
        (1, "A1", "薬A", "Approved"), (1, "B2", "器B", "Pending"), (1, "C3", None, None),
    ]


def test_xml_nodes_need_a_path(spark):
    docs = spark.createDataFrame([("<a/>",)], "text string")
    for path in ("", "//product", "/report"):
        with pytest.raises(ValueError, match="path of steps"):
            xml_nodes(docs, "text", path, ["id"])


def test_decode(spark):
    files = spark.createDataFrame([
        ("u", bytearray("医薬品".encode("utf-8"))), ("b", bytearray("医薬品".encode("utf-8-sig"))),
        ("s", bytearray("医薬品,①".encode("cp932"))), ("x", bytearray(b"a\x81\x20b\x81\x20")), ("e", bytearray(b"")),
    ], "path string, content binary")
    got = {r.path: (r.charset, r.decode_errors, r.text) for r in decode_files(files).collect()}
    assert got["u"] == ("utf-8", 0, "医薬品") and got["b"] == ("utf-8-sig", 0, "医薬品")
    assert got["s"] == ("cp932", 0, "医薬品,①") and got["e"] == ("utf-8", 0, "")
    assert got["x"] == ("cp932", 2, "a\ufffd b\ufffd ")


def test_what_a_decoding_task_holds_is_bounded(spark):
    """In rows for short files, in bytes for long ones."""
    schema = pa.schema([("path", pa.string()), ("n", pa.int64())])
    short = [b.num_rows for b in in_pieces(((40, (str(i), i)) for i in range(50_000)), schema)]
    assert max(short) <= 5000 and sum(short) == 50_000
    long = [b.num_rows for b in in_pieces(((300_000, (str(i), i)) for i in range(20)), schema)]
    assert max(long) <= 4 and sum(long) == 20
    assert list(in_pieces(iter([]), schema)) == []
    files = spark.range(30_000, numPartitions=1).selectExpr("cast(id AS string) AS path", "encode(concat('é', id), 'UTF-8') AS content")
    assert decode_files(files).where("text = concat('é', path) AND charset = 'utf-8' AND decode_errors = 0").distinct().count() == 30_000


def test_archives(spark, tmp_path):
    good = archive({"demo.CSV": '識別番号,性別,転帰\n0001,男性,"回復\n軽快"\n0002,,"a,b"\n', "DRUG.csv": "医薬品名,識別番号\n薬A,0001\n", "REAC.csv": "", "sub/HIST.csv": "x\n1\n"})
    ragged = archive({"DEMO.csv": "識別番号,性別\n1,x\n2,y,z,w\n"}, "utf-8")
    for name, content in {"1.zip": good, "2.zip": b"no archive", "3.zip": ragged}.items():
        (tmp_path / name).write_bytes(content)
    files = binary_files(spark, str(tmp_path), "*.zip")
    demo = archive_csv(files, "DEMO", list(ADVERSE_EVENT_COLUMNS["DEMO"])).orderBy("record_no").collect()
    assert [(r["record_no"], r["識別番号"], r["性別"], r["転帰"], r["年齢"]) for r in demo] == [
        (0, "0001", "男性", "回復\n軽快", None), (1, "0002", None, "a,b", None),
    ]
    assert archive_csv(files, "DRUG", ["識別番号", "医薬品名"]).first()["医薬品名"] == "薬A"
    assert archive_csv(files, "REAC", ["識別番号"]).count() == archive_csv(files, "HIST", ["識別番号"]).count() == 0
    status = {(r.archive[-5:], r.stem): r.status for r in archive_members(files, ["DEMO", "REAC", "HIST"]).collect()}
    assert status == {
        ("1.zip", "DEMO"): "ok", ("1.zip", "REAC"): "empty", ("1.zip", "HIST"): "missing",
        ("2.zip", "DEMO"): "unreadable", ("2.zip", "REAC"): "unreadable", ("2.zip", "HIST"): "unreadable",
        ("3.zip", "DEMO"): "unreadable", ("3.zip", "REAC"): "missing", ("3.zip", "HIST"): "missing",
    }


def test_archive_cells_are_kept_as_written(spark, tmp_path):
    members = {"DEMO.csv": "id,drug\n100,x,\n007,NA,\nabc,None,\n,null\n200\n", "DRUG.csv": "id,drug,\n1,x,\n", "REAC.csv": "id,drug\n1,x,y\n"}
    (tmp_path / "1.zip").write_bytes(archive(members, "utf-8"))
    files = binary_files(spark, str(tmp_path), "*.zip")
    read = lambda stem: [tuple(r)[1:] for r in archive_csv(files, stem, ["id", "drug"]).orderBy("record_no").collect()]
    assert read("DEMO") == [(0, "100", "x"), (1, "007", "NA"), (2, "abc", "None"), (3, None, "null"), (4, "200", None)]
    assert read("DRUG") == [(0, "1", "x")] and read("REAC") == []
    problem = archive_members(files, ["REAC"]).first()
    assert (problem.status, problem.n_rows) == ("unreadable", 0) and "record 0 has more cells" in problem.problem


PAGES = [
    ("a", 2, "second", [[["n", None, "n"], ["1", "2", "3"], ["4"]]]),
    ("a", 1, "first", [[[None, ""], ["dropped", "x"]], []]),
    ("a", 3, "", None),
    ("b", 1, None, []),
]


def _pages(spark):
    return spark.createDataFrame(PAGES, "doc string, page_no int, text string, tables array<array<array<string>>>")


def test_documents(spark):
    done = assemble_documents(_pages(spark).repartition(3))
    got = {r.doc: (r.full_text, r.tables) for r in done.select("doc", "full_text", F.to_json("tables").alias("tables")).collect()}
    assert got == {"a": ("first\nsecond", '[[{"null":"2","n":"3"},{"null":null,"n":null}]]'), "b": ("", "[]")}


def test_section_over_page_breaks(spark):
    pages = [
        ("a", 1, "x\n審査の概要"), ("a", 2, ""), ("a", 3, "one\ntwo"), ("a", 4, "three\n2. next\n審査の概要\nno"), ("a", 5, "3. more"),
        ("b", 1, "審査の概要\nall"), ("b", 2, "of it"), ("c", 1, "none"), ("d", 1, None), ("e", 1, "審査の概要\nshort"), ("e", 2, "2. end"),
    ]
    df = spark.createDataFrame(pages, "doc string, page_no int, text string").repartition(4)
    got = {r.doc: r.s for r in page_section(df, "審査の概要", "s").collect()}
    assert got == {"a": "one\ntwo\nthree", "b": "all\nof it", "e": "short"}


def test_marks_of_documents(spark):
    found = document_marks(_pages(spark), {"at": F.when(F.col("text").contains("s"), F.col("text"))}).collect()
    got = {r.doc: (r.n_pages, r.has_text, r.has_tables, r.at) for r in found}
    assert got == {"a": (3, True, True, "first"), "b": (1, False, False, None)}


def test_page_rows(spark):
    row = '<tr><td>薬A</td><td></td><td></td><td></td><td><a href="a.pdf">審査報告書</a></td></tr>'
    html = f'<a href="/top">t</a><div id="ContentMainArea"><table class="result_list_table">{row}{row}</table></div>'
    pages = spark.createDataFrame([(7, "https://h.org/d/", html)], "page_id int, url string, html string")
    assert [(r.page_id, r.pos, r.link_url) for r in page_links(pages).collect()] == [
        (7, 0, "https://h.org/top"), (7, 1, "https://h.org/d/a.pdf"), (7, 2, "https://h.org/d/a.pdf"),
    ]
    assert [(r.row_no, r.cells[0], r.links[0].href) for r in page_table_rows(pages).collect()] == [(0, "薬A", "a.pdf"), (1, "薬A", "a.pdf")]


NESTED = """<div id="ContentMainArea"><table><tr><td>layout<table id=t class="x result_list_table"><tbody>
<tr><td>薬A<td>g<td>c<td>d<td><table><tbody><tr><td>in<a href="a1.pdf">one</a></td></tr><tr><td><table><tr><td>deep <a href=a2.pdf>two</a></table></td></tr></tbody></table><a href="a3.pdf">three</a></td></tr>
<tr><td>薬B</td><td>g</td><td><TABLE><TR><TD>x</TD><TD>y</TD></TR></TABLE></td><td>d</td><td><a href="b.pdf">four</a></td><td>more</td></tr>
<tr><td>short</td><td><table><tr><td>1</td><td>2</td><td>3</td><td>4</td><td>5</td></tr></table></td></tr>
<tr><td>薬C</td><td></td><td></td><td></td><td><a href="c.pdf">five</a>
</table> after <table><tr><td>1</td><td>2</td><td>3</td><td>4</td><td>5</td></tr></table></td></tr></table>
<table class="result_list_table"><tr><td>no</td><td></td><td></td><td></td><td></td></tr></table></div>"""


def test_rows_of_tables_that_hold_tables(spark):
    pages = spark.createDataFrame([(1, "https://h.org/d/", NESTED), (2, "https://h.org/", NESTED.split("</table> after")[0]), (3, "https://h.org/", "<div id=ContentMainArea></div>")], "page_id int, url string, html string")
    found = page_table_rows(pages).orderBy("page_id", "row_no").collect()
    for page in (1, 2):
        own = [r for r in found if r.page_id == page]
        assert [(r.row_no, r.cells) for r in own] == [
            (0, ["薬A", "g", "c", "d", "inonedeeptwothree"]), (1, ["薬B", "g", "xy", "d", "four", "more"]), (3, ["薬C", "", "", "", "five"]),
        ]
        assert [[a.href for a in r.links] for r in own] == [["a1.pdf", "a2.pdf", "a3.pdf"], ["b.pdf"], ["c.pdf"]]
    assert {r.page_id for r in found} == {1, 2}


def test_a_page_of_many_tables(spark):
    """Tables inside tables, level by level, and many beside each other: the same as a stack would give."""
    deep = "<table><tr><td>i" * 60 + "</td></tr></table>" * 60
    row = f"<tr><td>a</td><td>b</td><td>c</td><td>d</td><td>{deep}</td></tr>"
    html = f'<div id="ContentMainArea"><table class="result_list_table">{row * 30}</table></div>'
    found = page_table_rows(spark.createDataFrame([(1, "https://h.org/", html)], "page_id int, url string, html string")).collect()
    assert [r.row_no for r in found] == list(range(30)) and {r.cells[4] for r in found} == {"i" * 60}


def test_archive_files_in_one_pass(spark, tmp_path):
    """The source and the pass over rows give what the functions for one member give."""
    rng = lambda k, n: "id,drug,名\n" + "".join(f'{k}-{i},"a, {i}",薬{i}\n' for i in range(n))
    good = {"demo.CSV": rng(1, 50), "DRUG.csv": rng(2, 2), "REAC.csv": "", "x/HIST.csv": "id\n1\n"}
    broken = archive({"DEMO.csv": rng(3, 3000), "DRUG.csv": rng(4, 5)}, "utf-8")
    at = broken.index(b"DEMO.csv") + 400
    contents = {"1.zip": archive(good), "2.zip": b"no archive", "3.zip": broken[:at] + bytes(200) + broken[at + 200 :], "4.zip": archive({"DEMO.csv": "id,drug\n1,x,y\n"}), "5.ZIP": b"", "note.txt": b"x"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    tables = {"DEMO": ["drug", "id", "none"], "DRUG": ["名"], "REAC": ["id"], "HIST": ["id"]}
    files = binary_files(spark, str(tmp_path), "*.zip")
    found = [archive_tables(spark, str(tmp_path), tables), archive_frames(files, tables)]
    want = {stem: sorted(tuple(r)[1:] for r in archive_csv(files, stem, names).collect()) for stem, names in tables.items()}
    assert [len(want[s]) for s in tables] == [50, 7, 0, 0]
    account = sorted((r.archive[-5:], r.stem, r.status, r.charset, r.n_rows) for r in archive_members(files, list(tables)).collect())
    for frames in found:
        assert {stem: sorted(tuple(r)[1:] for r in f.collect()) for stem, f in frames.items()} == want
        assert [f.columns for f in frames.values()] == [["archive", "record_no", *names] for names in tables.values()]
        assert sorted((r.archive[-5:], r.stem, r.status, r.charset, r.n_rows) for r in frames.account.collect()) == account
    one = archive_tables(spark, str(tmp_path / "1.zip"), {"DEMO": ["id"]})
    assert one["DEMO"].count() == 50 and one.account.count() == 1
    assert archive_tables(spark, str(tmp_path), {"DEMO": ["id"]}, glob="*.none")["DEMO"].count() == 0


def test_a_partition_for_each_member(spark, tmp_path):
    from regtables.sources.archives import _ArchiveReader

    for k in range(3):
        (tmp_path / f"{k}.zip").write_bytes(archive({"A.csv": "x\n1\n", "B.csv": "x\n2\n", "C.csv": ""}))
    planned = _ArchiveReader({"path": str(tmp_path), "tables": '{"A": ["x"], "B": ["x"], "C": ["x"], "D": ["x"]}'}).partitions()
    assert sorted((p.path[-5:], p.stems) for p in planned) == sorted((f"{k}.zip", s) for k in range(3) for s in (("A",), ("B",), ("C", "D")))


def test_many_small_archives_share_tasks(spark, tmp_path):
    """Tasks do not grow in number with the archives; rows and account are those of a task per member."""
    from regtables.sources.archives import _ArchiveReader, _Members

    for k in range(90):
        (tmp_path / f"{k:02d}.zip").write_bytes(b"no archive" if k == 7 else archive({"A.csv": f"x\n{k}\n", "B.csv": "" if k % 2 else "x\n2\n"}))
    rows = "x\n" + "".join(f"{i * 7919 % 100_003}\n" for i in range(20_000))
    (tmp_path / "large.zip").write_bytes(archive({"A.csv": rows, "B.csv": rows}))
    tables = '{"A": ["x"], "B": ["x"]}'
    planned = _ArchiveReader({"path": str(tmp_path), "tables": tables, "tasks": "8"}).partitions()
    assert len(planned) <= 20
    assert sorted(p.stems for p in planned if isinstance(p, _Members) and p.path.endswith("large.zip")) == [("A",), ("B",)]
    assert sorted(n[-6:] for p in planned if not isinstance(p, _Members) for n in p.paths) == [f"{k:02d}.zip" for k in range(90)]
    found = archive_tables(spark, str(tmp_path), {"A": ["x"], "B": ["x"]})
    assert found["A"].count() == 89 + 20_000 and found["B"].count() == 45 + 20_000
    assert found["A"].where("archive LIKE '%/11.zip' AND x = '11'").count() == 1
    status = {(r.status, r.stem): r["count"] for r in found.account.groupBy("status", "stem").count().collect()}
    assert status == {("ok", "A"): 90, ("ok", "B"): 46, ("empty", "B"): 44, ("unreadable", "A"): 1, ("unreadable", "B"): 1}
