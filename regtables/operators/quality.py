"""Declared data-quality rules and their report.

A rule is a dict such as ``{"column": "id", "check": "is_unique"}``. All rules run, and each gives
one row ``(rule_no, column, check, passed, violations, message)``. Row-wise rules share one
aggregation, all ``is_unique`` and ``is_in_set`` rules one grouping whose counts are combined before
the shuffle. Only the report leaves the executors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from regtables.functions.dates import to_iso_date
from regtables.functions.records import lenient_number

REPORT_SCHEMA = "rule_no int, column string, check string, passed boolean, violations bigint, message string"

# Values shown in a message. The report counts all of them; invalid_values() lists all of them.
SHOWN_VALUES = 20

# Column type names accepted by has_type, by Spark type.
TYPE_NAMES: dict[type, tuple[str, ...]] = {
    T.ByteType: ("int8", "Int8"),
    T.ShortType: ("int16", "Int16"),
    T.IntegerType: ("int32", "Int32"),
    T.LongType: ("int64", "Int64"),
    T.FloatType: ("float32", "Float32"),
    T.DoubleType: ("float64", "Float64"),
    T.BooleanType: ("bool", "boolean"),
    T.StringType: ("object", "string", "str"),
    T.DateType: ("date",),
    T.TimestampType: ("datetime64[ns, UTC]",),
    T.TimestampNTZType: ("datetime64[ns]",),
}


def _is_null(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _number(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    if isinstance(kind, T.NumericType):
        return F.when(~_is_null(df, name), c.cast("double"))
    return lenient_number(c)


def _moment(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.coalesce(c.try_cast("timestamp"), to_iso_date(c).cast("timestamp"))
    return c


def in_set(df: DataFrame, name: str, allowed: Sequence[Any]) -> Column:
    """True if the value is one of ``allowed``; null counts only if listed."""
    c = F.col(f"`{name}`")
    listed = [v for v in allowed if v is not None]
    found = F.coalesce(c.isin(listed), F.lit(False)) if listed else F.lit(False)
    return found | c.isNull() if None in allowed else found


def in_range(df: DataFrame, name: str, low: float, high: float) -> Column:
    """True if the value is a number between both ends, ends included."""
    return F.coalesce(_number(df, name).between(low, high), F.lit(False))


def _violation(df: DataFrame, rule: Mapping[str, Any]) -> Column:
    """True for a row that breaks a row-wise rule."""
    name, check = rule["column"], rule["check"]
    if check == "not_null":
        return _is_null(df, name)
    if check == "is_in_range":
        return ~in_range(df, name, rule["min_value"], rule["max_value"])
    if rule["type"] == "datetime":
        return _moment(df, name).isNull()
    number = _number(df, name)
    if rule["type"] == "integer" and rule.get("integral"):
        return number.isNull() | (number != F.floor(number))
    return number.isNull()


# The wording of the messages.
def _message(rule: Mapping[str, Any], n: Column) -> Column:
    name, check = rule["column"], rule["check"]
    shown = n.cast("string")
    if check == "not_null":
        return F.concat(F.lit(f"Column '{name}' has "), shown, F.lit(" null values."))
    if check == "is_in_range":
        ends = f"[{rule['min_value']}, {rule['max_value']}]"
        return F.concat(F.lit(f"Column '{name}' has "), shown, F.lit(f" values outside the range {ends}."))
    return F.concat(F.lit(f"Column '{name}' contains non-{rule['type']} values: "), shown, F.lit("."))


def _row(no: int, rule: Mapping[str, Any], violations: Column, message: Column) -> Column:
    n = F.coalesce(violations, F.lit(0)).cast("bigint")
    return F.struct(
        F.lit(no).cast("int").alias("rule_no"),
        F.lit(rule.get("column")).cast("string").alias("column"),
        F.lit(rule["check"]).alias("check"),
        (n == 0).alias("passed"),
        n.alias("violations"),
        F.when(n > 0, message).alias("message"),
    )


def invalid_values(df: DataFrame, column: str, allowed_values: Sequence[Any]) -> DataFrame:
    """``(value, n_rows)`` of every value outside the allowed set."""
    bad = df.where(~in_set(df, column, allowed_values))
    return bad.groupBy(F.col(f"`{column}`").alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))


def as_text(df: DataFrame, name: str) -> Column:
    """The value as text, the same for equal values and for them only."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (c + 0.0).cast("string")  # one zero
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    return F.to_json(F.struct(c)) if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)) else c.cast("string")


# The wording of the messages.
def _grouped_message(rule: Mapping[str, Any], found: Column) -> Column:
    name = rule["column"]
    if rule["check"] == "is_unique":
        # Two nulls are a repeat, yet null is left out of the number in the message.
        return F.concat(F.lit(f"Column '{name}' is not unique. Found "), found["repeated_values"].cast("string"), F.lit(" duplicate values."))
    more = F.when(found["distinct"] > SHOWN_VALUES, F.concat(F.lit(" of "), found["distinct"].cast("string"), F.lit(" values")))
    return F.concat(F.lit(f"Column '{name}' contains values not in the allowed set: ["), found["shown"], F.lit("]"), F.coalesce(more, F.lit("")))


def _grouped_report(df: DataFrame, rules: Mapping[int, Mapping[str, Any]]) -> DataFrame:
    """The rules that need groups of equal values, by one grouping over (rule, value): the table is read once, and
    counts are combined before they are moved."""

    def entry(no: int, rule: Mapping[str, Any]) -> Column:
        listed = rule["check"] == "is_in_set"
        e = F.struct(F.lit(no).alias("rule_no"), as_text(df, rule["column"]).alias("value"), F.lit(listed).alias("listed"))
        return F.when(~in_set(df, rule["column"], rule["allowed_values"]), e) if listed else e

    entries = F.filter(F.array(*(entry(no, r) for no, r in rules.items())), lambda e: e.isNotNull())
    counts = df.select(F.explode(entries).alias("e")).select("e.*").groupBy("rule_no", "value").agg(F.count(F.lit(1)).alias("n"), F.max("listed").alias("listed"))
    # Both take all of the counts as they are, so these are made once.
    sums = counts.groupBy("rule_no").agg(
        F.sum(F.when(F.col("listed"), F.col("n"))).alias("rows"), F.count(F.lit(1)).alias("distinct"),
        F.count_if(F.col("n") > 1).alias("repeated"), F.count_if((F.col("n") > 1) & F.col("value").isNotNull()).alias("repeated_values"),
    )
    first = Window.partitionBy("rule_no").orderBy(F.col("value").try_cast("double"), "value")
    top = counts.where(F.col("listed") & (F.col("n") > 0)).withColumn("at", F.row_number().over(first)).where(F.col("at") <= SHOWN_VALUES)
    shown = top.groupBy("rule_no").agg(F.array_join(F.array_sort(F.collect_list(F.coalesce("value", F.lit("None")))), ", ").alias("shown"))
    found = sums.join(shown, "rule_no", "left").select("rule_no", F.struct("rows", "distinct", "repeated", "repeated_values", "shown").alias("f"))
    given = df.sparkSession.createDataFrame([(no,) for no in rules], "rule_no int").join(found, "rule_no", "left")  # a row per rule
    row = F.lit(None)
    for no, rule in rules.items():
        n = F.col("f")["repeated" if rule["check"] == "is_unique" else "rows"]
        row = F.when(F.col("rule_no") == no, _row(no, rule, n, _grouped_message(rule, F.col("f")))).otherwise(row)
    return given.select(row.alias("r"))


# Options each check needs besides the column.
_NEEDS = {
    "not_null": (),
    "is_unique": (),
    "has_type": ("type",),
    "is_in_range": ("min_value", "max_value"),
    "is_in_set": ("allowed_values",),
}


def _static_problem(df: DataFrame, rule: Mapping[str, Any]) -> str | None:
    """What can be told from the rule and the schema alone."""
    check, column = rule["check"], rule.get("column")
    if check not in _NEEDS:
        return f"Unknown validation check: {check}"
    if column not in df.columns:
        return f"Validation failed: Column '{column}' not found in DataFrame."
    missing = [o for o in _NEEDS[check] if o not in rule]
    if missing:
        return f"Error during validation check '{check}' on column '{column}': missing {missing}"
    if check == "has_type" and rule["type"] not in ("integer", "float", "datetime"):
        names = TYPE_NAMES.get(type(df.schema[column].dataType), (df.schema[column].dataType.simpleString(),))
        if rule["type"] not in names:
            return f"Column '{column}' has type {names[0]}, expected {rule['type']}."
    return None


def check(df: DataFrame, rules: Sequence[Mapping[str, Any]] | None) -> DataFrame:
    """The report of all rules; empty if there are none."""
    spark = df.sparkSession
    fixed: list[Column] = []
    by_row: list[Column] = []
    grouped: dict[int, Mapping[str, Any]] = {}
    for no, rule in enumerate(rules or []):
        problem = _static_problem(df, rule)
        if problem is not None:
            fixed.append(_row(no, rule, F.lit(1), F.lit(problem)))
        elif rule["check"] == "has_type" and rule["type"] not in ("integer", "float", "datetime"):
            fixed.append(_row(no, rule, F.lit(0), F.lit("")))
        elif rule["check"] in ("is_unique", "is_in_set"):
            grouped[no] = rule
        else:
            n = F.count_if(_violation(df, rule))
            by_row.append(_row(no, rule, n, _message(rule, n)))

    parts = [_grouped_report(df, grouped)] if grouped else []
    if by_row:
        parts.append(df.agg(F.array(*by_row).alias("rs")).select(F.explode("rs").alias("r")))
    if fixed:
        parts.append(spark.range(1).select(F.explode(F.array(*fixed)).alias("r")))
    if not parts:
        return spark.createDataFrame([], REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, parts).select("r.*")


def failures(df: DataFrame, rules: Sequence[Mapping[str, Any]] | None) -> list[str]:
    """Messages of the rules that failed, in rule order; empty means the data passed."""
    if not rules:
        return []
    rows = check(df, rules).where(~F.col("passed")).collect()
    return [r.message for r in sorted(rows, key=lambda r: r.rule_no)]
