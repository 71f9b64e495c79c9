"""Surrogate keys over a total order, numbered without a single task.

``ranged`` range-partitions a frame on its order, sorts inside the ranges and
writes it as Parquet to the shared folder with each row's range and place.
Everything else reads that table, column by column: range sizes from the range
column alone, their running sum from a table with one row per range.  The
numbers depend on stored columns only, so they survive lost executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import scratch_path

PART, PLACE = "_sk_part", "_sk_place"


def _cols(order: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def row_number_key(df: DataFrame, order: Sequence, name: str, offset: int = 0) -> DataFrame:
    """1-based key over a global order, plus ``offset``, in one task: for
    literal lists only."""
    w = Window.orderBy(*_cols(order))
    return df.withColumn(name, (F.row_number().over(w) + F.lit(offset)).cast("bigint"))


def ranged(df: DataFrame, order: Sequence, num_partitions: int | None = None) -> DataFrame:
    """``df`` stored in ranges of ``order``, with the range and the 0-based
    place inside it."""
    oc = _cols(order)
    ex = df.repartitionByRange(num_partitions, *oc) if num_partitions else df.repartitionByRange(*oc)
    part = F.spark_partition_id()
    rows = ex.sortWithinPartitions(*oc).withColumn(PART, part).withColumn(
        PLACE, F.monotonically_increasing_id() - F.shiftleft(part.cast("bigint"), 33))
    path = scratch_path(df.sparkSession, "ranged")
    rows.write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def range_starts(stored: DataFrame) -> DataFrame:
    """One row per range: rows in the ranges before it, rows in all ranges."""
    sizes = stored.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy(PART)) - F.col("_n")
    return sizes.select(PART, before.alias("_sk_before"), F.sum("_n").over(Window.partitionBy()).alias("_sk_total"))


def numbered(stored: DataFrame, name: str, offset: int = 0, total: str | None = None) -> DataFrame:
    """Stored ranges with a dense 1-based number, plus ``offset``; ``total``
    names a column for the number of all rows."""
    # as many rows as ranges, that is at most spark.sql.shuffle.partitions
    out = stored.join(F.broadcast(range_starts(stored)), PART)
    out = out.withColumn(name, F.col("_sk_before") + F.col(PLACE) + F.lit(1 + offset).cast("bigint"))
    if total:
        out = out.withColumn(total, F.col("_sk_total"))
    return out.drop("_sk_before", "_sk_total")


def dense_key(df: DataFrame, order: Sequence, name: str, offset: int = 0,
              num_partitions: int | None = None, total: str | None = None) -> DataFrame:
    """Distributed 1-based dense key over a total order, plus ``offset``.

    Runs one job now, which writes ``df`` once in range order; the returned
    plan reads that table.  ``total`` names a column for the row count."""
    return numbered(ranged(df, order, num_partitions), name, offset, total).drop(PART, PLACE)


def max_key(df: DataFrame, col: str) -> int:
    """Current maximum of an id column (0 when empty): one scalar to the driver."""
    return int(df.agg(F.coalesce(F.max(col), F.lit(0)).cast("bigint")).first()[0])


def continue_key(new_rows: DataFrame, existing: DataFrame, id_col: str, order: Sequence, name: str) -> DataFrame:
    """Number ``new_rows`` from ``max(existing.id_col) + 1`` on."""
    return dense_key(new_rows, order, name, offset=max_key(existing, id_col))
