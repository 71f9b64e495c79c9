"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the
    lineage ends there, and every executor can read the rows again."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` evaluated once: a lambda variable holds it,
    so array expressions that index it many times do not recompute it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def at(array: Column, zero_based: Column) -> Column:
    """Element of an array, null outside it."""
    return F.get(array, zero_based)


def text_hash() -> Column:
    """Hash of the text, null as empty; with doc_id it names a row."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
