"""Sinks.

Snapshots are written to a new folder every time and then read back; a
table is never read and overwritten at the same path in one job.  Fact
tables are partitioned on disk by a coarse date column so later reads prune.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, mode: str = "errorifexists",
                partition_by: Sequence[str] = (), sort_within: Sequence[str] = ()) -> str:
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append_table(df: DataFrame, path: str) -> str:
    """Append rows to a table folder (the default load mode)."""
    return write_table(df, path, mode="append")


def load_all(spark: SparkSession, outputs: Mapping[str, DataFrame], base: str,
             partition_by: Mapping[str, Sequence[str]] | None = None) -> dict[str, str]:
    """Write every output under ``base/<name>`` in the given order
    (dimensions before facts) and return the paths."""
    paths = {}
    for name, df in outputs.items():
        paths[name] = write_table(df, f"{base}/{name}", partition_by=(partition_by or {}).get(name, ()))
    return paths


def written_digests(spark: SparkSession, paths: Mapping[str, str], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """(table_name, row_count, contents) read back from storage: the load
    audit.  ``contents`` sums a 32-bit hash of each row's ``columns``, so it
    does not depend on row order and wrong values show."""
    out = None
    for name, path in paths.items():
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns[name]])
        row = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
        one = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(row), F.lit(0).cast("bigint")).alias("contents"))
        one = one.select(F.lit(name).alias("table_name"), "row_count", "contents")
        out = one if out is None else out.unionByName(one)
    return out


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """Declare ``name`` in the catalog with the schema's types and NOT NULL
    marks, empty, stored under ``path``; an old table of that name is dropped."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    spark.sql(f"CREATE TABLE `{name}` ({cols}) USING parquet LOCATION '{path}'")
