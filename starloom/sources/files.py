"""File sources: parquet tables of a data folder and CSV feeds."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text forms used for CSV timestamps (feed format).
CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_tables(spark: SparkSession, sf_dir: str, names: Iterable[str],
                optional: Iterable[str] = ()) -> dict[str, DataFrame]:
    """Named sources as one explicit dict.  A missing source is an error
    unless listed in ``optional`` (then it is left out)."""
    out: dict[str, DataFrame] = {}
    optional = set(optional)
    for n in names:
        path = os.path.join(sf_dir, f"{n}.parquet")
        if not os.path.exists(path) and n in optional:
            continue
        out[n] = spark.read.parquet(path)
    return out


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for n, df in tables.items():
        df.createOrReplaceTempView(n)


def write_csv(df: DataFrame, path: str, bom: bool = False) -> str:
    """Header CSV, one folder of part files.  ``bom`` prefixes the header
    (first column name) with a UTF-8 byte-order mark, as spreadsheet exports do."""
    out = df
    if bom:
        first = df.columns[0]
        out = df.withColumnRenamed(first, "﻿" + first)
    (out.write.mode("errorifexists")
        .option("header", True)
        .option("timestampNTZFormat", CSV_TS_FORMAT)
        .option("timestampFormat", CSV_TS_FORMAT)
        .csv(path))
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             delimiter: str = ",", infer: bool = False) -> DataFrame:
    """Header CSV.  Production reads pass an explicit ``schema`` (inference
    scans the data twice and can change with the sample); ``infer`` is for
    profiling.  A UTF-8 BOM in front of the header is dropped by the reader."""
    r = (spark.read.option("header", True).option("sep", delimiter)
         .option("timestampNTZFormat", CSV_TS_FORMAT).option("mode", "PERMISSIVE"))
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_csv_head(spark: SparkSession, path: str, n: int, order: Iterable[str],
                  schema: T.StructType | None = None) -> DataFrame:
    """The first ``n`` rows in a stated order (a preview; top-k plan)."""
    return read_csv(spark, path, schema).orderBy(*order).limit(n)


def dotted(name: str) -> F.Column:
    """Reference a column whose name contains dots (``pre.blankVotes``)."""
    return F.col(f"`{name}`")


def snake(name: str) -> str:
    """``pre.blankVotes`` → ``pre_blank_votes``."""
    out = []
    for ch in name.replace(".", "_"):
        if ch.isupper():
            out.append("_" + ch.lower())
        else:
            out.append(ch)
    return "".join(out).replace("__", "_").lstrip("_")
