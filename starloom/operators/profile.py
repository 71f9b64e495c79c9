"""Column profiles computed in one scan each, returned in long form
``(column_name, …)`` so the width of the input never becomes the width of
the output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _long(df_wide: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return df_wide.selectExpr(f"stack({len(names)}, {pairs}) as (column_name, {value})")


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    return _long(wide, cols, "null_count")


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """Exact distinct counts (nulls not counted); ``approx`` uses
    HyperLogLog++ sketches, merge-able and constant in memory per column."""
    cols = list(cols or df.columns)
    if approx:
        aggs = [F.approx_count_distinct(F.col(f"`{c}`"), rsd).alias(c) for c in cols]
    else:
        aggs = [F.count_distinct(F.col(f"`{c}`")).alias(c) for c in cols]
    return _long(df.agg(*aggs), cols, "distinct_count")


def distinct_sketches(df: DataFrame, cols: Sequence[str] | None = None, lg_k: int = 12) -> DataFrame:
    """(column_name, sketch): a HyperLogLog sketch of each column's values, as
    text, nulls left out.  One pass that keeps 2 ** ``lg_k`` registers a
    column; rows are not copied per column.  Sketches are values: stored with a
    load, they merge with those of other loads."""
    cols = list(cols or df.columns)
    aggs = [F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), lg_k).alias(c) for c in cols]
    return _long(df.agg(*aggs), cols, "sketch")


def merged_distincts(sketches: DataFrame, lg_k: int = 12, sigmas: float = 3.0) -> DataFrame:
    """(column_name, loads, estimate, low, high) from (column_name, sketch) of
    any number of loads: distinct values over all of them, and the range of
    ``sigmas`` standard errors (1.04 / sqrt(2 ** lg_k) of the estimate)."""
    error = sigmas * 1.04 / (1 << lg_k) ** 0.5
    n = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate")
    out = sketches.groupBy("column_name").agg(F.count(F.lit(1)).alias("loads"), n)
    return (out.withColumn("low", F.floor(F.col("estimate") / F.lit(1 + error)).cast("bigint"))
               .withColumn("high", F.ceil(F.col("estimate") / F.lit(1 - error)).cast("bigint")))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value, n) for every non-null value; one pass, one
    shuffle of pre-aggregated (column, value) pairs."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, value)")
    return long.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n"))


def schema_frame(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(position, column_name, data_type) of a frame: metadata, not data."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([T.StructField("position", T.LongType()),
                           T.StructField("column_name", T.StringType()),
                           T.StructField("data_type", T.StringType())])
    return spark.createDataFrame(rows, schema)


def counts_by(df: DataFrame, cols: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))
