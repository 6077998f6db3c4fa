from datetime import date

import pytest
from pyspark.sql import functions as F

from regtables.functions.dates import display_timestamp, to_iso_date
from regtables.functions.html import (
    all_links_by_href, anchors, attribute, inner_text, link_by_href, link_by_text, link_preferred, result_rows, unescape,
)
from regtables.functions.records import lenient_int, lenient_number, raw_json, row_hash_id
from regtables.functions.text import label_value, section_text, strip
from regtables.functions.urls import url_file_name, url_join, url_suffix


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("v")).first().v


# The first and last days of eras, leap days, and the forms in which dates are written.
DATES = [
    ("1998-12-31", date(1998, 12, 31)),
    ("2004.02.29", date(2004, 2, 29)),
    ("令和2年2月29日", date(2020, 2, 29)),
    ("平成元年1月8日", date(1989, 1, 8)),
    ("平成12年11月3日", date(2000, 11, 3)),
    ("昭和元年12月25日", date(1926, 12, 25)),
    ("昭和39年10月10日", date(1964, 10, 10)),
    ("大正元年7月30日", date(1912, 7, 30)),
    ("明治33年2月28日", date(1900, 2, 28)),
    (" 平成30年12月1日　", date(2018, 12, 1)),
    ("昭和55年 7月 6日", date(1980, 7, 6)),
    ("2025年9月10日", date(2025, 9, 10)),
    ("2025/4/1", date(2025, 4, 1)),
    ("20250101", date(2025, 1, 1)),
    ("2025-09-08 10:11:12", date(2025, 9, 8)),
    ("2025-02-30", None),
    ("20251301", None),
    ("令和7年2月30日", None),
    ("202501", None),
    ("2025", None),
    ("未定", None),
    ("no date here", None),
    ("", None),
    (None, None),
]


def test_dates(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(DATES)], "i int, t string")
    found = {r.i: r.d for r in df.select("i", to_iso_date(F.col("t")).alias("d")).collect()}
    assert [found[i] for i in range(len(DATES))] == [d for _, d in DATES]


@pytest.mark.parametrize("text, shown", [
    ("2025-09-08T10:00:00Z", "2025-09-08 10:00:00"),
    ("2025-09-08 10:00:00+09:00", "2025-09-08 10:00:00"),
    ("2025-09-08 10:00:01.25", "2025-09-08 10:00:01"), ("2025-09-08", "2025-09-08 00:00:00"), ("12:30", "12:30"),
    ("soon", "soon"), ("", ""), (None, ""),
])
def test_display_timestamp(spark, text, shown):
    assert one(spark, display_timestamp(F.col("t")), t=text) == shown


TEXT = "1. 販売名: 内側\n販売名:  薬A　\n申請者名: \n区分 (旧): x\n販売名: 薬B\n審査の概要 \n 一行目\n二行 2.5\n\n 2. 審査の結果\n後"


def test_label_values(spark):
    def get(label):
        return one(spark, label_value(F.col("t"), label), t=TEXT)

    assert get("販売名") == "薬A"
    assert get("申請者名") == ""
    assert get("区分 (旧)") == "x"
    assert get("一般的名称") is None


def test_section(spark):
    assert one(spark, section_text(F.col("t"), "審査の概要"), t=TEXT) == "一行目\n二行 2.5"
    assert one(spark, section_text(F.col("t"), "審査の概要"), t="審査の概要\n最後まで\n") == "最後まで"
    assert one(spark, section_text(F.col("t"), "審査の概要"), t="審査の概要 なし") is None


def test_strip(spark):
    assert one(spark, strip(F.col("t")), t="　\t a b \n ") == "a b"


@pytest.mark.parametrize("href, url", [
    ("/files/a.xlsx", "https://h.org/files/a.xlsx"),
    ("a.xlsx?x=/../y", "https://h.org/d/e/a.xlsx?x=/../y"),
    ("../a.xlsx", "https://h.org/d/a.xlsx"),
    ("./a/./b/../c", "https://h.org/d/e/a/c"),
    ("../../../a", "https://h.org/a"),
    ("//other.org/a", "https://other.org/a"),
    ("http://x.org/b", "http://x.org/b"),
    ("?p=2", "https://h.org/d/e/page.html?p=2"),
    ("#top", "https://h.org/d/e/page.html?q=1#top"),
    ("", "https://h.org/d/e/page.html?q=1#f"),
])
def test_url_join(spark, href, url):
    assert one(spark, url_join(F.col("b"), F.col("h")), b="https://h.org/d/e/page.html?q=1#f", h=href) == url


def test_url_pieces(spark):
    assert one(spark, url_file_name(F.col("u")), u="https://h.org/d/a.tar.gz") == "a.tar.gz"
    assert one(spark, url_suffix(F.col("u")), u="https://h.org/d/a.xlsx?v=1.2") == ".xlsx"
    assert one(spark, url_suffix(F.col("u")), u="https://h.org/d/") == ""
    assert one(spark, url_join(F.col("b"), F.col("h")), b="https://h.org", h="a") == "https://h.org/a"


def test_markup_pieces(spark):
    assert one(spark, unescape(F.col("t")), t="a &amp;lt; b&#33307;&#x1F600;&#xD800;&#0; &nbsp;&quot;") == "a &lt; b舛😀&#xD800;&#0; \u00a0\""
    assert one(spark, inner_text(F.col("t")), t="<td> a <b>b </b>\n&amp;c</td>") == "ab&c"
    assert one(spark, attribute(F.col("t"), "href"), t="<a data-href='x' HREF = y>") == "y"
    assert one(spark, attribute(F.col("t"), "class"), t="<a href=''>") is None
    assert one(spark, attribute(F.col("t"), "href"), t='<a href="">') == ""


PAGE = """
<html><head><script>document.write('<a href="/no">no</a>')</script></head><body>
<!-- <a href="/hidden.xlsx">2025年度</a> -->
<a name="top">2025年度</a> <a href="/2024.html"> 2024年度 </a>
<A class='big excel' HREF='files/b.xlsx?a=1&amp;b=2'><span>2025年度</span> 一覧</A>
<a href=/files/a.xlsx>plain</a> <a class="excels" href="/zip/All-CASES-1.zip">zip</a><a href="/zip/cases.ZIP">z</a>
</body></html>
"""


def test_links(spark):
    page = spark.createDataFrame([(PAGE, "https://h.org/x/")], "html string, url string")
    links = page.select(anchors(F.col("html"), F.col("url")).alias("l"))
    row = links.select(
        F.size("l").alias("n"),
        link_by_text(F.col("l"), "2025年度").alias("by_text"),
        link_by_text(F.col("l"), "2024年度", exact=True).alias("exact"),
        link_by_text(F.col("l"), "2023年度").alias("none"),
        link_preferred(F.col("l"), ".xlsx", "excel").alias("preferred"),
        link_preferred(F.col("l"), ".xlsx", "pdf").alias("fallback"),
        link_by_href(F.col("l"), "cases", ".zip").alias("by_href"),
        all_links_by_href(F.col("l"), suffix=".xlsx").alias("all"),
        F.col("l")[1]["text"].alias("text"),
    ).first()
    assert row.n == 5
    assert row.by_text == row.preferred == "https://h.org/x/files/b.xlsx?a=1&b=2"
    assert row.exact == "https://h.org/2024.html"
    assert row.none is None
    assert row.fallback == "https://h.org/x/files/b.xlsx?a=1&b=2"
    assert row.by_href == "https://h.org/zip/All-CASES-1.zip"
    assert row["all"] == ["https://h.org/files/a.xlsx"]
    assert row.text == "2025年度一覧"


def _results(spark, html):
    page = spark.createDataFrame([(html, "https://h.org/search")], "html string, url string")
    return page.select(result_rows(F.col("html"), F.col("url")).alias("r")).first().r


ROW = '<tr><td> {0} </td><td>g</td><td>c</td><td><a href="d/1">D</a></td><td><a href="/p/{0}.pdf">審査<b>報告書</b></a></td></tr>'


def test_result_rows(spark):
    table = '<table class="x result_list_table"><tr><th>h</th></tr><tr><td>few</td></tr>' + ROW.format("薬A") + ROW.format("薬B") + "</table>"
    rows = _results(spark, f'<div id="ContentMainArea"><div></div>{table}</div>')
    assert [(r.row_no, r.cells[0], r.links[0].url, r.links[0].text) for r in rows] == [
        (2, "薬A", "https://h.org/p/薬A.pdf", "審査報告書"), (3, "薬B", "https://h.org/p/薬B.pdf", "審査報告書"),
    ]
    # The table must lie inside the container, and the first one there counts.
    assert _results(spark, f'<div id="ContentMainArea"><div></div></div>{table}') == []
    assert _results(spark, table) == []
    assert _results(spark, '<div id="ContentMainArea"><table class="result_list_tables"></table></div>') == []
    twice = f'<div id=ContentMainArea><table class="result_list_table"><tbody>{ROW.format("1")}</tbody></table>{table}'
    assert [r.cells[0] for r in _results(spark, twice)] == ["1"]


def test_records(spark):
    df = spark.createDataFrame([(1, None, "薬")], "b int, a string, c string")
    assert df.select(raw_json(["b", "a", "c"]).alias("v")).first().v == '{"b":1,"a":null,"c":"薬"}'
    ids = df.select(row_hash_id(["a", "b", "c"]).alias("x"), row_hash_id(["c", "b", "a"]).alias("y")).first()
    assert ids.x == ids.y and len(ids.x) == 64
    other = spark.createDataFrame([(1, "", "薬")], df.schema).select(row_hash_id(df.columns).alias("x")).first()
    assert other.x != ids.x


@pytest.mark.parametrize("text, number, whole", [
    ("12", 12.0, 12), (" 7 ", 7.0, 7), ("3.5", 3.5, None), ("4.0", 4.0, 4), ("1e3", 1000.0, 1000),
    ("12d", None, None), ("NaN", None, None), ("x", None, None), (None, None, None), ("9007199254740993", 9007199254740992.0, 9007199254740993),
])
def test_numbers(spark, text, number, whole):
    assert one(spark, lenient_number(F.col("t")), t=text) == number
    assert one(spark, lenient_int(F.col("t")), t=text) == whole


@pytest.mark.parametrize("text,wanted", [
    ("&#38;lt;b", "&lt;b"), ("&#x10FFFF;|&#1114111;", "\U0010ffff|\U0010ffff"), ("&#0000065;&#x000041;", "AA"),
    ("&copy;&yen;&hellip;&Eacute;", "©¥…É"), ("&#1114112;&#99999999999999999999;&nosuch;& &;", "&#1114112;&#99999999999999999999;&nosuch;& &;"),
    ("a&amp;amp;b", "a&amp;b"), ("", ""), (None, None),
])
def test_references_are_decoded_once(spark, text, wanted):
    assert one(spark, unescape(F.col("t")), t=text) == wanted


def test_messy_anchors(spark):
    page = """<a title="a>b" href="1.pdf">one</a><a href=2.pdf>two <a class='x' href='3.pdf'>three</a> no
        <abbr href="4.pdf">x</abbr><a data-href="no.pdf" href="5.pdf"><b>fi</b>ve<a name="n">none</a><a href="6.pdf">six"""
    found = one(spark, anchors(F.col("t"), F.lit("https://h.org/d/")), t=page)
    assert [(a["href"], a["text"]) for a in found] == [("1.pdf", "one"), ("2.pdf", "two"), ("3.pdf", "three"), ("5.pdf", "five"), ("6.pdf", "six")]


def test_rows_and_cells_without_closing_tags(spark):
    page = """<div id="ContentMainArea"><table class="result_list_table"><tbody><tr><td>a<td title="x>y">b<td>c<td>d<td><a href="1.pdf">p</a>
        <tr><td>e</td><td>f<td>g<td>h</td><td>i</tr></tbody></table></div>"""
    found = one(spark, result_rows(F.col("t"), F.lit("https://h.org/")), t=page)
    assert [r["cells"] for r in found] == [["a", "b", "c", "d", "p"], ["e", "f", "g", "h", "i"]]
    assert [a["url"] for a in found[0]["links"]] == ["https://h.org/1.pdf"]
