import json
import random

import pytest
from pyspark.sql import functions as F, types as T

from regtables.operators.changes import changed_sources
from regtables.operators.collapse import collapse_by_key, rows_as_json, source_rows
from regtables.operators.conform import conform, rename_columns, require_columns, union_files
from regtables.operators.grid import detect_header, drop_empty_rows, files_without_header, fill_down, grid_records
from regtables.operators.match import first_name_per_text, match_contains_all, match_exact_first, orphan_keys, orphan_rows
from regtables.operators.quality import check, failures, invalid_values
from regtables.operators import sizing
from regtables.operators.sizing import size_of, small_side
from regtables.operators.upsert import upsert


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order or df.columns).collect()]


# --- grids -------------------------------------------------------------------------------------


def _grid(spark, files):
    return spark.createDataFrame(
        [(f, i, cells) for f, lines in files.items() for i, cells in enumerate(lines)], "file string, row_no long, cells array<string>"
    )


def test_grid(spark):
    grid = _grid(spark, {
        "a": [["list", None], [None, None], ["No.", "販 売\n名"], ["1", "A"], ["2", None]],
        "b": [["販売名", "No.", "備考"], ["B", "3", "r"]],
        "late": [["x", "y"]] * 10 + [["No.", "販売名"], ["4", "C"]],
        "none": [["x", "y"]],
    })
    headers = detect_header(grid, "販売名")
    assert rows(headers.select("file", "header_row")) == [("a", 2), ("b", 0)]
    assert rows(files_without_header(grid, headers)) == [("late",), ("none",)]
    found = grid_records(grid, headers, ["No.", "販売名", "備考"])
    assert rows(found, "file", "row_no") == [("a", 3, "1", "A", None), ("a", 4, "2", None, None), ("b", 1, "3", "B", "r")]


@pytest.mark.parametrize("slice_rows", [1, 2, 3, 100])
def test_fill_down_over_slices(spark, slice_rows):
    values = [None, "a", None, None, "b", None, None, None, None, "c"]
    data = [("f", i, v, v) for i, v in enumerate(values)] + [("g", i, None, "k") for i in range(3)]
    df = spark.createDataFrame(data, "file string, row_no long, x string, kept string").repartition(3)
    done = fill_down(df, ["x"], slice_rows=slice_rows)
    assert done.columns == df.columns
    assert [r.x for r in done.where("file = 'f'").orderBy("row_no").collect()] == [None, "a", "a", "a", "b", "b", "b", "b", "b", "c"]
    assert [r.x for r in done.where("file = 'g'").collect()] == [None] * 3
    assert done.where("file = 'f' and kept is null").count() == 7


def test_drop_empty_rows(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None)], "n int, `No.` string, b string")
    assert rows(drop_empty_rows(df, ["No.", "b"]), "n") == [(2, "a", None)]


# --- conform -----------------------------------------------------------------------------------


def test_conform(spark):
    df = spark.createDataFrame([("1", "x", 2.5)], "a string, b string, extra double")
    target = T.StructType([T.StructField("c", T.DateType()), T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    assert rows(conform(df, target)) == [(None, 1, None)]
    assert rename_columns(df, {"a": "z"}).columns == ["z", "b", "extra"]
    assert rename_columns(df, {"a": "z"}, keep_unmapped=False).columns == ["z"]
    require_columns(df, ["a", "b", "remarks"], ["remarks"])
    with pytest.raises(ValueError, match="missing.*'d', 'e'"):
        require_columns(df, ["a", "e", "d"])


def test_union_files(spark):
    a = spark.createDataFrame([(1, "x")], "n int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, n int")
    assert rows(union_files([a, b]), "n") == [(1, "x", None), (2, None, "y")]
    with pytest.raises(ValueError):
        union_files([])


# --- collapse ----------------------------------------------------------------------------------

LINES = [
    (1, 1.0, "t1", None, "B1", "A"),
    (2, 2.0, None, "g2", "B2", "A"),
    (3, 2.0, "t2", "g1", "B2", None),
    (4, 2.0, "t3", "g2", None, "C"),
    (5, None, "t4", None, None, None),
    (6, None, "t5", None, None, "x"),
]


def _lines(spark):
    return spark.createDataFrame(LINES, "row_no int, k double, t string, g string, b string, a string")


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_collapse(spark, partitions):
    df = _lines(spark).orderBy(F.rand(5)).repartition(partitions)
    done = collapse_by_key(df, "k", ["row_no"], first=["t"], joined=["g", "b", "a", "absent"], record=["k", "t", "g"])
    got = {r.k: r for r in done.collect()}
    assert set(got) == {1.0, 2.0, None}
    assert (got[2.0].t, got[2.0].g, got[2.0].b, got[2.0].a, got[2.0].n_rows) == ("t2", "g2\ng1", "B2", "A\nC", 3)
    assert (got[None].t, got[None].g, got[None].a) == ("t4", "", "x")
    gathered = {r.k: json.loads(r.raw_data_full) for r in rows_as_json(df, "k", ["row_no"], ["k", "t", "g"]).collect()}
    assert gathered[2.0][0] == {"k": 2.0, "t": None, "g": "g2"}
    assert [x["t"] for x in gathered[2.0]] == [None, "t2", "t3"]
    apart = source_rows(df, "k", ["row_no"], ["k", "t", "g"]).where("k = 2").collect()
    assert sorted((json.loads(r.source_order)["row_no"], json.loads(r.raw_data_full)) for r in apart) == list(zip([2, 3, 4], gathered[2.0]))


def test_collapse_of_a_key_with_half_of_all_rows(spark):
    df = spark.range(4000).selectExpr("if(id % 2 = 0, 7, id) AS k", "id", "concat('v', id % 5) AS v", "nullif(id % 3, 1) AS w")
    done = collapse_by_key(df.repartition(9), "k", ["id"], first=["w"], joined=["v"], record=["v", "w"])
    hot = done.where("k = 7").first()
    assert (hot.n_rows, hot.w, hot.v) == (2001, 0, "v0\nv2\nv4\nv1\nv3")
    assert done.where("_meta_source_content_hash IS NULL OR v IS NULL").isEmpty()


def test_hash_of_a_group_sees_every_change_and_no_reordering(spark):
    def mark(df):
        return {r.k: r._meta_source_content_hash for r in collapse_by_key(df, "k", ["row_no"], record=["t", "g"]).collect()}

    df = _lines(spark)
    assert mark(df) == mark(df.repartition(5))
    changed = mark(df.withColumn("g", F.when(F.col("row_no") == 4, "zz").otherwise(F.col("g"))))
    assert {k for k, h in mark(df).items() if changed[k] != h} == {2.0}
    # A value that moves to another column is a change.
    left = spark.createDataFrame([(1, 1, "a", None)], "k int, row_no int, t string, g string")
    right = spark.createDataFrame([(1, 1, None, "a")], "k int, row_no int, t string, g string")
    assert mark(left) != mark(right)


def test_collapse_first_only(spark):
    done = collapse_by_key(_lines(spark), "k", ["row_no"], first={"u": F.upper("t")})
    assert {r.k: r.u for r in done.collect()} == {1.0: "T1", 2.0: "T2", None: "T4"}


# --- matching ----------------------------------------------------------------------------------

BRANDS = ["イグザレルト", "イグザレルトOD", " リクシアナ ", "エリキュース", "リクシアナ"]


def _links(spark):
    data = []
    for row_no, brand in enumerate(BRANDS):
        data.append((row_no, 0, brand, "IF", f"/{row_no}.html", f"u{row_no}"))
        data.append((row_no, 1, brand, "審査報告書 (1)", f"/{row_no}.pdf?x", f"p{row_no // 2}"))
    return spark.createDataFrame(data, "row_no int, link_no int, brand string, text string, href string, url string")


def test_exact_match(spark):
    names = spark.createDataFrame([("リクシアナ",), ("イグザレルト",), ("アイリーア",), ("リクシアナ",)], "name string")
    found = match_exact_first(_links(spark), names)
    assert rows(found) == [("イグザレルト", "p0"), ("リクシアナ", "p1")]


def test_contains_match(spark):
    names = spark.createDataFrame([(1, "クシア"), (2, "イグザレルト"), (3, "リ"), (4, "")], "name_no int, name string")
    found = match_contains_all(_links(spark), names)
    # p1 belongs to rows 2 and 3, p2 to row 4; each url once, under the first name.
    assert rows(found, "url") == [("p0", 2, "イグザレルト", 0, 1), ("p1", 1, "クシア", 2, 1), ("p2", 1, "クシア", 4, 1)]


def test_contains_is_brute_force(spark):
    texts = ["aab", "abab", "ba", "", "zzz", None, "aaaa"]
    names = [(1, "zz"), (2, "bab"), (3, "a"), (4, "aa"), (5, "b")]
    found = first_name_per_text(
        spark.createDataFrame([(t,) for t in texts], "t string"), spark.createDataFrame(names, "name_no int, name string"), "t"
    )
    wanted = [(t, *min((n for n in names if n[1] in t))) for t in texts if t and any(n[1] in t for n in names)]
    assert rows(found) == sorted(wanted)
    none = first_name_per_text(found.select("t"), spark.createDataFrame([(1, "")], "name_no int, name string"), "t")
    assert none.columns == ["t", "name_no", "name"] and none.count() == 0


def test_orphans(spark):
    children = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    parents = spark.createDataFrame([(1,)], "id int")
    assert rows(orphan_keys(children, parents, "k", "id")) == [(None, 1), (2, 1)]
    assert rows(orphan_rows(children, parents, "k", "id")) == [(None, "d"), (2, "c")]


def test_changed_sources(spark):
    schema = "url string, etag string, last_modified string"
    sources = spark.createDataFrame(
        [("same", "1", None), ("new etag", "2", "x"), ("new date", None, "y"), ("no token", None, None), ("unseen", "1", None)], schema
    )
    known = spark.createDataFrame([("same", "1", None), ("new etag", "1", "x"), ("new date", None, "x"), ("no token", None, None)], schema)
    assert [r[0] for r in rows(changed_sources(sources, known))] == ["new date", "new etag", "no token", "unseen"]


def test_small_side(spark, monkeypatch):
    df = spark.range(10).withColumn("name", F.lit("x" * 84))

    def is_broadcast():
        return "broadcast" in small_side(df)._jdf.queryExecution().toString().lower()

    assert size_of(df) == (10, 10 * (2 * 16 + 84)) and size_of(df.where("false")) == (0, 0)
    assert is_broadcast()
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 9)
    assert not is_broadcast()
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 10)
    monkeypatch.setattr(sizing, "MAX_BROADCAST_BYTES", 1000)
    assert not is_broadcast()


# --- rules -------------------------------------------------------------------------------------


@pytest.fixture
def parcels(spark):
    """Parcels: one without a place, one place twice, weights that are whole and not, a code of digits."""
    data = [(70, "Oslo", 3, "007", 2.0), (71, None, 12, "12", 0.5), (72, "Lima", 12, "x9", 4.0), (73, "Oslo", 120, "8", -1.0)]
    return spark.createDataFrame(data, "no long, place string, days int, code string, weight double")


@pytest.mark.parametrize("rule, message", [
    ({"column": "place", "check": "not_null"}, "has 1 null values"),
    ({"column": "code", "check": "not_null"}, None),
    ({"column": "place", "check": "is_unique"}, "Found 1 duplicate values"),
    ({"column": "days", "check": "is_unique"}, "Found 1 duplicate values"),
    ({"column": "no", "check": "is_unique"}, None),
    ({"column": "code", "check": "has_type", "type": "integer"}, "contains non-integer values"),
    ({"column": "no", "check": "has_type", "type": "integer"}, None),
    ({"column": "weight", "check": "has_type", "type": "integer", "integral": True}, "contains non-integer values"),
    ({"column": "weight", "check": "has_type", "type": "float"}, None),
    ({"column": "place", "check": "has_type", "type": "float"}, "contains non-float values"),
    ({"column": "code", "check": "has_type", "type": "datetime"}, "contains non-datetime values"),
    ({"column": "days", "check": "has_type", "type": "int32"}, None),
    ({"column": "days", "check": "has_type", "type": "int64"}, "has type int32, expected int64"),
    ({"column": "days", "check": "is_in_range", "min_value": 3, "max_value": 12}, "1 values outside the range [3, 12]"),
    ({"column": "weight", "check": "is_in_range", "min_value": -1, "max_value": 4}, None),
    ({"column": "place", "check": "is_in_range", "min_value": 0, "max_value": 1}, "4 values outside"),
    ({"column": "code", "check": "is_in_set", "allowed_values": ["007", "12", "8"]}, "not in the allowed set: [x9]"),
    ({"column": "days", "check": "is_in_set", "allowed_values": [3, 12, 120]}, None),
    ({"column": "place", "check": "is_in_set", "allowed_values": ["Lima", "Oslo"]}, "not in the allowed set: [None]"),
    ({"column": "place", "check": "is_in_set", "allowed_values": [None, "Lima", "Oslo"]}, None),
    ({"column": "no", "check": "is_pretty"}, "Unknown validation check: is_pretty"),
    ({"column": "gone", "check": "is_unique"}, "Column 'gone' not found"),
    ({"column": "days", "check": "is_in_set"}, "Error during validation check 'is_in_set'"),
])
def test_rule(parcels, rule, message):
    found = failures(parcels, [rule])
    assert found == [] if message is None else message in found[0]


def test_all_rules_run(parcels, spark):
    rules = [{"column": "place", "check": "not_null"}, {"column": "x", "check": "not_null"}, {"column": "no", "check": "is_unique"}]
    assert [(r.rule_no, r.passed) for r in check(parcels, rules).orderBy("rule_no").collect()] == [(0, False), (1, False), (2, True)]
    assert check(parcels, []).count() == 0 and failures(parcels, None) == []


def test_two_nulls_are_a_repeat(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "v string")
    assert "Found 0 duplicate values" in failures(df, [{"column": "v", "check": "is_unique"}])[0]


def test_nan_is_null_and_empty_passes(spark):
    df = spark.createDataFrame([(float("nan"),)], "v double")
    assert "has 1 null" in failures(df, [{"column": "v", "check": "not_null"}])[0]
    rules = [{"column": "v", "check": c} for c in ("not_null", "is_unique")] + [{"column": "v", "check": "is_in_set", "allowed_values": [1]}]
    assert failures(df.where("false"), rules) == []


def test_many_invalid_values_are_counted(spark):
    df = spark.range(50).withColumn("v", F.col("id") % 30)
    message = failures(df, [{"column": "v", "check": "is_in_set", "allowed_values": [0]}])[0]
    assert message.endswith("] of 29 values") and message.count(",") == 19
    assert invalid_values(df, "v", [0]).count() == 29


# --- upsert ------------------------------------------------------------------------------------


def _table(spark, data, schema="id int, a string, b string"):
    return spark.createDataFrame(data, schema)


def test_upsert(spark):
    target = _table(spark, [(1, "old", "x"), (2, "old", "y"), (None, "kept", "z")])
    source = _table(spark, [(2, "new", "n"), (3, "new", None), (None, "inserted", None)])
    once = upsert(target, source, ["id"])
    wanted = [(None, "inserted", None), (None, "kept", "z"), (1, "old", "x"), (2, "new", "n"), (3, "new", None)]
    assert rows(once, "id", "a") == wanted
    with_keys = source.where("id is not null")
    assert rows(upsert(upsert(target, with_keys, ["id"]), with_keys, ["id"]), "id") == rows(upsert(target, with_keys, ["id"]), "id")


def test_upsert_keeps_columns_the_source_lacks(spark):
    target = _table(spark, [(1, "old", "x"), (2, "old", "y")])
    source = _table(spark, [("new", 2), ("new", 3)], "a string, id int")
    assert rows(upsert(target, source, ["id"]), "id") == [(1, "old", "x"), (2, "new", "y"), (3, "new", None)]


def test_upsert_duplicates(spark):
    target = _table(spark, [(1, "old", "x")])
    source = _table(spark, [(1, "b", "2"), (1, "a", "3"), (2, "c", "1")])
    with pytest.raises(ValueError, match="several rows"):
        upsert(target, source, ["id"])
    assert rows(upsert(target, source, ["id"], "last", ["b"]), "id") == [(1, "a", "3"), (2, "c", "1")]


@pytest.mark.parametrize("keys, message", [([], "needs key"), (["z"], "missing"), (["id", "a", "b"], "all columns are keys")])
def test_upsert_errors(spark, keys, message):
    target = _table(spark, [(1, "old", "x")])
    with pytest.raises(ValueError, match=message):
        upsert(target, target, keys)


def test_a_file_without_first_rows_or_header_is_named(spark):
    grid = spark.createDataFrame([("a", 3, ["x"]), ("a", 4, ["y"]), ("b", 20, ["Name"]), ("c", 2, ["Name"]), ("c", 3, ["z"])], "file string, row_no long, cells array<string>")
    headers = detect_header(grid, "Name")
    assert rows(files_without_header(grid, headers)) == [("a",), ("b",)]


def test_links_of_one_row_go_by_their_place(spark):
    links = [("A", 1, 1, "x.pdf", "u2"), ("A", 1, 0, "y.pdf", "u9"), ("A", 0, 0, "z.html", "u0"), ("B", 5, 0, "b.pdf", "u5"), ("B", 5, 0, "b.pdf", "u4")]
    df = spark.createDataFrame(links, "brand string, row_no int, link_no int, href string, url string").repartition(4)
    names = spark.createDataFrame([("A",), ("B",)], "name string")
    assert rows(match_exact_first(df, names)) == [("A", "u9"), ("B", "u4")]
    assert rows(match_exact_first(df.drop("link_no"), names)) == [("A", "u2"), ("B", "u4")]


def test_both_ways_to_find_names_in_texts(spark):
    from regtables.operators.match import by_automaton, by_rarest_gram

    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abé薬🙂 ") for _ in range(n))
    texts = [word(rng.choice([0, 1, 2, 5, 30])) for _ in range(300)] + ["aaaa", None]
    names = [(i, word(rng.choice([1, 2, 3, 4, 8]))) for i in range(60, 0, -1)] + [(0, ""), (99, "aa"), (98, "aa"), (97, "none of it")]
    want = {t: min((n, x) for n, x in names if x and x in t) for t in set(texts) if t is not None and any(x and x in t for _, x in names)}
    t = spark.createDataFrame([(x,) for x in texts], "t string").repartition(3)
    n = spark.createDataFrame(names, "name_no int, name string").repartition(3)
    distinct, known = t.where("t IS NOT NULL").distinct(), n.where("name <> ''").groupBy("name").agg(F.min("name_no").alias("name_no")).select("name_no", "name")
    for found in (first_name_per_text(t, n, "t"), by_automaton(distinct, known, "t"), by_rarest_gram(distinct, known, "t")):
        assert found.columns == ["t", "name_no", "name"]
        assert {r.t: (r.name_no, r.name) for r in found.collect()} == want
        assert found.count() == len(want)
    for way in (by_automaton, by_rarest_gram):
        assert way(distinct, known.where("false"), "t").count() == way(distinct.where("false"), known, "t").count() == 0


def test_all_groupings_of_rules_read_the_table_once(spark):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(x):
        reads.add(1)
        return x

    df = spark.range(1000, numPartitions=3).select(seen(F.col("id").cast("int")).alias("a"), (F.col("id") / 2).alias("b"), F.when(F.col("id") > 5, F.col("id") % 40).alias("c"))
    df = df.withColumns({"b": F.when(F.col("a") >= 0, F.col("b")), "c": F.when(F.col("a") >= 0, F.col("c"))})
    rules = [{"column": "a", "check": "is_unique"}, {"column": "c", "check": "is_unique"}, {"column": "c", "check": "is_in_set", "allowed_values": list(range(10))},
             {"column": "b", "check": "is_in_set", "allowed_values": [i / 2 for i in range(1000)]}, {"column": "b", "check": "is_in_set", "allowed_values": [0.0, -0.0]}]
    found = {r.rule_no: (r.passed, r.violations, r.message) for r in check(df, rules).collect()}
    assert reads.value == 1000
    shown = ", ".join(sorted(["None", *map(str, range(10, 29))]))
    assert found == {
        0: (True, 0, None), 1: (False, 41, "Column 'c' is not unique. Found 40 duplicate values."),
        2: (False, 6 + sum(1 for i in range(6, 1000) if i % 40 > 9), f"Column 'c' contains values not in the allowed set: [{shown}] of 31 values"),
        3: (True, 0, None), 4: (False, 999, f"Column 'b' contains values not in the allowed set: [{', '.join(sorted(str(i / 2) for i in range(1, 21)))}] of 999 values"),
    }
    # Row-wise rules take one more reading, however many there are.
    check(df, [*rules, {"column": "b", "check": "not_null"}, {"column": "b", "check": "is_in_range", "min_value": 0, "max_value": 9}]).collect()
    assert reads.value == 3000


def test_a_collapsed_group_and_its_values_meet_in_one_shuffle(spark):
    """Groups, distinct values, and both by key; a null key is a group of its own."""
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "a"), ("k", 1, None), ("l", 1, "x"), ("l", 2, "x")], "k string, n int, v string")
    done = collapse_by_key(df, "k", ["n"], first=["v"], joined=["v"], record=["v"])
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3 and "Join" not in plan
    rows = collapse_by_key(df, "k", ["n"], first={"f": "v"}, joined=["v"]).collect()
    assert {(r.k, r.f, r.v, r.n_rows) for r in rows} == {(None, "a", "a\nb", 2), ("k", None, "", 1), ("l", "x", "x", 2)}


def test_rows_of_small_groups_are_moved_once(spark, monkeypatch):
    """Measured groups: one shuffle for the small ones; those of large buckets are combined first, with the same result."""
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 > 0 THEN cast(id % 700 AS string) END AS k", "id AS n",
        "concat('v', id % 11) AS v", "nullif(id % 4, 1) AS w", "if(id % 2 = 0, NULL, id % 5) AS f",
    ).repartition(6)
    collapsed = lambda sized: collapse_by_key(df, "k", ["n"], first=["f"], joined=["v", "w"], record=["v", "w"], sized=sized)
    hashed = lambda done: done._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    expected = rows(collapsed(False), "k")
    assert hashed(collapsed(False)) == 3 and hashed(collapsed(True)) == 1
    assert rows(collapsed(True), "k") == expected
    monkeypatch.setattr("regtables.operators.collapse._BUCKET_ROWS", 20)  # the hot key and the null one
    assert hashed(collapsed(True)) == 4
    assert rows(collapsed(True), "k") == expected
    monkeypatch.setattr("regtables.operators.collapse._BUCKET_ROWS", 0)
    assert rows(collapsed(True), "k") == expected


def test_bytes_count_before_a_broadcast(spark):
    """A side of few rows is not small if they hold large binaries."""
    assert size_of(spark.range(3).selectExpr("id", "cast(repeat('x', 5000) AS binary) AS b")) == (3, 3 * (5000 + 32))
