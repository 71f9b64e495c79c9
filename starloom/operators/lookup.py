"""Dimension look-ups.

No join carries a hint: the planner broadcasts a side whose bytes are known to
be small, AQE does so on measured shuffle sizes, and splits a skewed side of a
sort-merge join otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.text import NAMES, collated


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    return fact.join(dim, on, how)


def unique_lookup(dim: DataFrame, natural: str, key: str, natural_as: str | None = None) -> DataFrame:
    """(natural, key) with one row per non-null natural key, the smallest
    surrogate: a look-up by it cannot multiply rows."""
    return (dim.where(F.col(natural).isNotNull()).groupBy(F.col(natural).alias(natural_as or natural))
               .agg(F.min(key).alias(key)))


def has_repeats(dim: DataFrame, natural: str) -> bool:
    """Whether a non-null natural key has several rows, so that a look-up by it
    multiplies rows: one flag to the driver."""
    rows = dim.where(F.col(natural).isNotNull()).groupBy(natural).agg(F.count(F.lit(1)).alias("_n"))
    return bool(rows.agg(F.max("_n") > 1).first()[0])


def collated_lookup(df: DataFrame, name: str, dim: DataFrame, dim_name: str, key: str, out: str, collation: str = NAMES) -> DataFrame:
    """Left look-up of a name's key under a collation (case and accents do not
    count, nor how they are written).  Several dimension names that compare
    equal are one, with the smallest key, so rows are never multiplied; null
    names find nothing.  Spark joins by the names' collation keys."""
    keys = dim.where(F.col(dim_name).isNotNull()).groupBy(collated(dim_name, collation).alias("_cl_name")).agg(F.min(key).alias(out))
    return df.join(keys, collated(df[name], collation) == F.col("_cl_name"), "left").drop("_cl_name")


def replace_with_key(df: DataFrame, dim: DataFrame, natural: str, dim_natural: str,
                     dim_key: str, out: str) -> DataFrame:
    """Left look-up that swaps a natural key for the dimension's surrogate."""
    d = dim.select(F.col(dim_natural).alias("_rk_nat"), F.col(dim_key).alias(out))
    j = join_dim(df, d, df[natural] == d["_rk_nat"], "left")
    return j.drop("_rk_nat", natural) if natural != out else j.drop("_rk_nat")


def anti_new(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``existing`` (null keys are kept,
    unlike ``NOT IN``)."""
    return df.join(existing.select(*keys), list(keys), "left_anti")


def semi_exists(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other.select(*keys), list(keys), "left_semi")
