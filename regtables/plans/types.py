"""SQL type names of the table specs, as Spark types and as store types."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Type names used in specs. JSON is kept as text; lengths are not types in Spark.
_SPARK_TYPES = {
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMPTZ": T.TimestampType(),
    "TEXT": T.StringType(),
    "VARCHAR": T.StringType(),
    "JSONB": T.StringType(),
}

# What the warehouses call these types; unknown names become their text type.
_STORE_TYPES = {
    "postgres": {},
    "redshift": {"JSONB": "SUPER"},
    "bigquery": {
        "INTEGER": "INT64", "BIGINT": "INT64", "DOUBLE": "FLOAT64", "BOOLEAN": "BOOLEAN", "DATE": "DATE",
        "TIMESTAMPTZ": "TIMESTAMP", "TEXT": "STRING", "VARCHAR": "STRING", "JSONB": "JSON",
    },
}


def _split(sql_type: str) -> tuple[str, bool]:
    text = sql_type.strip().upper()
    required = text.endswith("NOT NULL")
    return re.sub(r"\(.*?\)|NOT NULL", "", text).strip(), required


def spark_type(sql_type: str) -> T.DataType:
    return _SPARK_TYPES.get(_split(sql_type)[0], T.StringType())


def is_required(sql_type: str) -> bool:
    return _split(sql_type)[1]


def store_type(sql_type: str, store: str) -> str:
    """The type's name in a warehouse: ``postgres``, ``redshift`` or ``bigquery``."""
    base, _ = _split(sql_type)
    names = _STORE_TYPES[store]
    if store == "bigquery":
        return names.get(base, "STRING")
    length = re.search(r"\(.*?\)", sql_type)
    return names.get(base, base + (length.group(0) if length else ""))


def schema_of(columns: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(c, spark_type(t), not is_required(t)) for c, t in columns.items()])
