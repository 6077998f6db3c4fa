"""Files read by byte ranges give what they give as a whole."""

import random

import pytest
from pyspark.sql import functions as F

from regtables.sources import xml
from regtables.sources.files import xml_nodes, xml_rows
from regtables.sources.ranges import byte_ranges, is_readable_by_range


def document(seed, n=120):
    rng = random.Random(seed)
    parts = ['<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE report [ <!ELEMENT report (#PCDATA)> ]>\n<report date="2025-09-10">\n<meta>a &lt; b <!-- <product id="c"> --></meta>']
    for i in range(n):
        kind = rng.randrange(8)
        name = rng.choice(["薬A", "B &amp; C", "été > 3", "", "x" * rng.randrange(200)])
        if kind == 0:
            parts.append(f'<products><product id="{i}"/></products>')
        elif kind == 1:
            parts.append(f"<!-- > <products><product id='no'> {'-' * 0}{'y ' * rng.randrange(150)}</product> --> ")
        elif kind == 2:
            parts.append(f"<other><product id='no'><name>n</name></product><deep><products><product id='no'/></products></deep></other>")
        elif kind == 3:
            parts.append(f"<products><product id='{i}' note='a > b'><name><![CDATA[<product> ]] {name}]]></name></product><x/></products>")
        elif kind == 4:
            parts.append(f"<products ><product\n id = '{i}' ><name lang=\"de\">{name}</name><product id='inner'><name>z</name></product></product ></products>")
        elif kind == 5:
            parts.append(f"<?run <products> ?><products><product><id>{i}</id><status ok='1'>{name}</status></product><product id='{i}b'/></products>")
        else:
            parts.append(f"<products><product id='{i}'><name>{name}</name><status>s{i}</status></product></products>")
    return "\n".join([*parts, "</report>"])


COLUMNS = ["id", "name", "status"]


def whole(spark, texts, path="./products/product"):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return sorted((tuple(r) for r in xml_nodes(df, "text", path, COLUMNS).collect()), key=str)


@pytest.mark.parametrize("size", [1 << 20, 900, 200])
def test_ranges_give_the_same_nodes(spark, tmp_path, size):
    texts = [document(k, 40) for k in range(2)] + ["<report/>", "﻿<report><products><product id='q'/></products></report>"]
    for k, t in enumerate(texts):
        (tmp_path / f"{k}.xml").write_text(t, encoding="utf-8")
    want = whole(spark, [t.lstrip("﻿") for t in texts])
    assert len(want) > 30
    got = xml_rows(spark, str(tmp_path), "./products/product", COLUMNS, range_bytes=size)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert xml_rows(spark, str(tmp_path), "/report/other/deep", ["id"], range_bytes=size).count() > 0


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<r><p>" + "".join(f"<q id='{i}'><name>{'n' * 40}</name></q>" for i in range(4000)) + "</p></r>", encoding="utf-8")
    found = xml.xml_node_texts(spark, str(tmp_path), ["p", "q"], 20_000)
    tasks = found.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(tasks) > 3 and sum(r["count"] for r in tasks) == 4000
    assert max(r["count"] for r in tasks) < 2000
    ranges = byte_ranges(spark, str(tmp_path), size=20_000).orderBy("start").collect()
    assert [r.start for r in ranges[1:]] == [r.end for r in ranges[:-1]] and ranges[-1].end == ranges[0].length


@pytest.mark.parametrize("size", [1 << 20, 90])
@pytest.mark.parametrize("change", [
    lambda t: t.replace("</report>", ""), lambda t: t.replace("</products>", "</product>", 1), lambda t: t + "</report>",
    lambda t: t[: len(t) // 2], lambda t: t.replace("<meta>", "<meta><b", 1), lambda t: t.replace("</report>", "<!-- </report>"),
])
def test_malformed_files_are_an_error(spark, tmp_path, size, change):
    (tmp_path / "a.xml").write_text(change(document(1, 12)), encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        xml_rows(spark, str(tmp_path), "./products/product", COLUMNS, require_rows=False, range_bytes=size).collect()


def test_effects_compose_as_the_whole(tmp_path):
    (tmp_path / "a.xml").write_bytes(document(5, 40).encode())
    path, length = str(tmp_path / "a.xml"), len(document(5, 40).encode())
    assert xml.effect(path, 0, length) == ([], [], length)
    for cut in range(0, length, 37):
        closes, opens, resume = xml.effect(path, 0, cut)
        more_closes, more_opens, _ = xml.effect(path, max(cut, resume), length)
        assert closes == [] and opens[::-1] == more_closes and more_opens == []


def test_stores_that_tasks_cannot_open(spark, tmp_path):
    assert is_readable_by_range(spark, str(tmp_path)) and is_readable_by_range(spark, f"file://{tmp_path}")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.here.link./in", f"file://{tmp_path}")
    (tmp_path / "a.xml").write_text("<r><p id='1'/></r>", encoding="utf-8")
    assert not is_readable_by_range(spark, "viewfs://here/in")
    assert [r.id for r in xml_rows(spark, "viewfs://here/in", "./p", ["id"]).collect()] == ["1"]
