"""JDBC tables.

Reads are split into ``num_partitions`` range slices of a numeric column
(one query each, run in parallel by the executors) instead of one partition
per table; the slice bounds come from a cheap ``min/max`` push-down query.
Writes go in batches with a bounded number of concurrent connections.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, props: Mapping[str, str],
              partition_column: str | None = None, num_partitions: int = 1,
              bounds: tuple[int, int] | None = None, fetch_size: int = 10_000) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("fetchsize", str(fetch_size))
    for k, v in props.items():
        reader = reader.option(k, v)
    if partition_column and num_partitions > 1:
        if bounds is None:
            bounds = jdbc_bounds(spark, url, table, props, partition_column)
        lo, hi = bounds
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lo)).option("upperBound", str(hi + 1))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()


def jdbc_bounds(spark: SparkSession, url: str, table: str, props: Mapping[str, str],
                column: str) -> tuple[int, int]:
    """min/max of ``column``, computed by the database (one row back)."""
    q = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) b"
    r = spark.read.format("jdbc").option("url", url).option("dbtable", q)
    for k, v in props.items():
        r = r.option(k, v)
    row = r.load().first()
    return int(row["lo"] or 0), int(row["hi"] or 0)


def write_jdbc(df: DataFrame, url: str, table: str, props: Mapping[str, str],
               mode: str = "append", batch_size: int = 10_000, max_connections: int = 16) -> None:
    """Append (default) or overwrite; at most ``max_connections`` tasks write
    at once (``numPartitions`` makes Spark coalesce before writing)."""
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)).option("numPartitions", str(max_connections)))
    for k, v in props.items():
        w = w.option(k, v)
    w.save()
