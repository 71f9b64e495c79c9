"""Catalog look-ups: list tables, check existence, list columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def require_table(spark: SparkSession, name: str) -> None:
    if not spark.catalog.tableExists(name):
        raise LookupError(f"table {name!r} is not registered")


def columns_frame(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """(table_name, column_name, position) of registered tables/views."""
    rows = []
    for n in names:
        require_table(spark, n)
        for i, c in enumerate(spark.catalog.listColumns(n)):
            rows.append((n, c.name, i + 1))
    schema = T.StructType([T.StructField("table_name", T.StringType()),
                           T.StructField("column_name", T.StringType()),
                           T.StructField("position", T.LongType())])
    return spark.createDataFrame(rows, schema)


def tables_frame(spark: SparkSession) -> DataFrame:
    """(table_name, is_temporary) of the current database's tables/views."""
    rows = [(t.name, bool(t.isTemporary)) for t in spark.catalog.listTables()]
    schema = T.StructType([T.StructField("table_name", T.StringType()),
                           T.StructField("is_temporary", T.BooleanType())])
    return spark.createDataFrame(rows, schema)
