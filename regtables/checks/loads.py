"""Load modes, merges and stream intake, on tables of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from regtables.checks.registry import check, new_folder, new_schema, table
from regtables.operators.sizing import pin
from regtables.operators.upsert import duplicate_keys, latest_per_key, upsert
from regtables.plans.specs import TableSpec
from regtables.sinks.tables import bulk_load, edit_of, ensure_tables, execute_merge, log_of, read_table, stage, table_name
from regtables.streaming.intake import read_new_files, stream_upsert

_ORDERS = TableSpec("orders", {"o_orderkey": "BIGINT", "o_orderstatus": "TEXT", "o_orderpriority": "TEXT"}, ("o_orderkey",))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")


def _changes(orders: DataFrame) -> DataFrame:
    """Pending orders get a status; urgent ones come again under new keys."""
    updated = orders.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("X"))
    new = orders.where("o_orderpriority = '1-URGENT'").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return updated.unionByName(new)


_MERGED = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders
UNION ALL SELECT -o_orderkey - 1, o_orderstatus, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'
"""


@check("upsert", _MERGED)
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    return upsert(orders, _changes(orders), ["o_orderkey"])


@check("latest_per_key", """
SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey
""")
def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return latest_per_key(rows, ["o_custkey"], ["o_orderkey"])


@check("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _loaded_table(spark: SparkSession, sf_dir: str):
    schema, root = new_schema(), new_folder(spark)
    ensure_tables(spark, schema, [_ORDERS], root)
    bulk_load(stage(_orders(spark, sf_dir), _ORDERS, schema, root), _ORDERS, schema, "append")
    return schema, root


@check("load_append", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders UNION ALL SELECT o_orderkey, 'again', o_orderpriority FROM orders WHERE o_orderstatus = 'F'")
def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, root = _loaded_table(spark, sf_dir)
    again = _orders(spark, sf_dir).where("o_orderstatus = 'F'").select("o_orderpriority", F.lit("again").alias("o_orderstatus"), "o_orderkey")
    bulk_load(stage(again, _ORDERS, schema, root), _ORDERS, schema, "append")
    return spark.table(table_name(schema, _ORDERS))


@check("load_overwrite", "SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'")
def load_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, root = _loaded_table(spark, sf_dir)
    some = _orders(spark, sf_dir).where("o_orderstatus = 'F'").drop("o_orderpriority")
    bulk_load(stage(some, _ORDERS, schema, root), _ORDERS, schema, "overwrite")
    # No rows: the table stays as it is.
    bulk_load(stage(some.where("false"), _ORDERS, schema, root), _ORDERS, schema, "overwrite")
    return spark.table(table_name(schema, _ORDERS))


@check("load_merge", _MERGED)
def load_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, root = _loaded_table(spark, sf_dir)
    staged = stage(_changes(_orders(spark, sf_dir)), _ORDERS, schema, root)
    # Twice is the same as once.
    execute_merge(staged, _ORDERS, schema, root)
    execute_merge(staged, _ORDERS, schema, root)
    return spark.table(table_name(schema, _ORDERS))


@check("load_interleaved", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'X' WHEN o_orderstatus = 'F' THEN 'Y' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders
UNION ALL SELECT -o_orderkey - 1, o_orderstatus, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT o_orderkey, 'again', o_orderpriority FROM orders WHERE o_orderpriority = '5-LOW'
""")
def load_interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two merges and an append, all worked out from the same version of the table. What comes second is not lost
    and loses nothing."""
    schema, root = _loaded_table(spark, sf_dir)
    orders, log = _orders(spark, sf_dir), log_of(spark, schema, root)
    first = stage(_changes(orders), _ORDERS, schema, root)
    second = stage(orders.where("o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("Y")), _ORDERS, schema, root)
    third = stage(orders.where("o_orderpriority = '5-LOW'").withColumn("o_orderstatus", F.lit("again")), _ORDERS, schema, root)
    others = [first]

    def merge(snapshot):
        edit = edit_of(second, _ORDERS, schema, "merge", snapshot.parts("orders"))
        if others:  # another load commits while this one is under way
            execute_merge(others.pop(), _ORDERS, schema, root)
        return {"orders": edit}

    log.commit(merge)
    bulk_load(third, _ORDERS, schema, "append")
    return read_table(spark, schema, _ORDERS, root)


@check("table_versions", f"""
SELECT 1 AS version, o_orderkey, o_orderstatus, o_orderpriority FROM orders UNION ALL SELECT 2, * FROM ({_MERGED})
""")
def table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table before and after a merge; versions in between were expired, a leased one was not."""
    schema, root = _loaded_table(spark, sf_dir)
    log = log_of(spark, schema, root)
    changes = stage(_changes(_orders(spark, sf_dir)), _ORDERS, schema, root)
    with log.leased():
        for _ in range(2):
            execute_merge(changes, _ORDERS, schema, root)
        log.expire(keep=1, grace_seconds=0)
        first, last = log.versions()
        before, after = (read_table(spark, schema, _ORDERS, root, version=v) for v in (first, last))
        return pin(before.withColumn("version", F.lit(1)).unionByName(after.withColumn("version", F.lit(2))))


@check("load_counts", "SELECT count(*) AS staged, count(*) + count(*) FILTER (WHERE o_orderstatus = 'P') AS loaded FROM orders")
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, root = new_schema(), new_folder(spark)
    ensure_tables(spark, schema, [_ORDERS], root)
    first = stage(_orders(spark, sf_dir), _ORDERS, schema, root)
    loaded = bulk_load(first, _ORDERS, schema, "append")
    pending = _orders(spark, sf_dir).where("o_orderstatus = 'P'")
    loaded += execute_merge(stage(pending, _ORDERS, schema, root), _ORDERS, schema, root)
    kept = spark.table(table_name(schema, _ORDERS)).agg(F.count(F.lit(1)).alias("staged"))
    return kept.select("staged", F.lit(loaded).cast("bigint").alias("loaded"))


_EVENTS = TableSpec("events", {"event_id": "BIGINT", "user_id": "BIGINT", "event_type": "TEXT"}, ("event_id",),
                    ({"column": "event_id", "check": "is_unique"},))


@check("stream_upsert", "SELECT event_id, user_id, event_type FROM events UNION ALL SELECT -event_id - 1, user_id, 'old' FROM events WHERE event_type = 'view'")
def stream_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, root = new_schema(), new_folder(spark)
    events = table(spark, sf_dir, "events")
    ensure_tables(spark, schema, [_EVENTS], root)
    # The table already holds views, under their own keys to be updated and under others to be kept.
    old = events.where("event_type = 'view'").select("event_id", "user_id", F.lit("old").alias("event_type"))
    before = old.unionByName(old.withColumn("event_id", -F.col("event_id") - 1))
    bulk_load(stage(before, _EVENTS, schema, root), _EVENTS, schema, "append")
    for _ in range(2):  # the second run finds no new file
        rows = read_new_files(spark, sf_dir, events.schema, glob="events.parquet")
        stream_upsert(rows, _EVENTS, schema, root, f"{root}/checkpoint")
    return spark.table(table_name(schema, _EVENTS))
