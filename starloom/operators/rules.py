"""Declared rules checked while a table is loaded.

All rules become one column of flags.  The input is scanned once: its rows are
staged with the flags that a row shows by itself or by its parent tables; the
keys that occur twice are counted from the staged key columns.  One last write
parts the rows: those that keep all rules, and those that fail any, with the
names of the rules, in a folder of their own.  Counts are taken by ``observe``
while that is written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starloom.session import scratch_path

FAILED = "failed_rules"


@dataclass(frozen=True)
class Rule:
    """A rule by name.  Of ``bad`` (a condition that holds in bad rows, for
    rules a row shows by itself), ``unique`` (columns that no two rows share)
    and ``parent`` (a table whose first column must hold the value of
    ``column``) one is given.  Null values break neither of the last two."""

    name: str
    bad: Column | None = None
    unique: Sequence[str] = ()
    column: str = ""
    parent: DataFrame | None = field(default=None, compare=False)


def not_null(column: str) -> Rule:
    return Rule(f"not_null {column}", bad=F.col(column).isNull())


def max_length(column: str, length: int) -> Rule:
    return Rule(f"max_length {column}", bad=F.length(column) > length)


def parses(column: str, parsed: Column) -> Rule:
    return Rule(f"parses {column}", bad=F.col(column).isNotNull() & parsed.isNull())


def unique(*columns: str) -> Rule:
    return Rule(f"unique {', '.join(columns)}", unique=columns)


def foreign_key(column: str, parent: DataFrame, parent_column: str) -> Rule:
    return Rule(f"foreign_key {column}", column=column, parent=parent.select(parent_column))


def one_to_one(column: str, parent: DataFrame, parent_column: str) -> list[Rule]:
    return [unique(column), foreign_key(column, parent, parent_column)]


@dataclass(frozen=True)
class Loaded:
    """Folders of the two parts, rows read, and the failing rows of each rule."""

    good: str
    quarantine: str
    rows: int
    failed: int
    violations: dict[str, int]


def load_with_rules(df: DataFrame, rules: Sequence[Rule], path: str) -> Loaded:
    """Write ``df`` under ``path``: rows that keep all rules to ``kept=true``,
    the others to ``kept=false`` with the column ``failed_rules`` (names in the
    order of ``rules``).  A row that breaks several rules counts under each."""
    spark = df.sparkSession
    names = [r.name for r in rules]
    if len(set(names)) < len(names) or {FAILED, "kept"} & set(df.columns):
        raise ValueError("rules need names of their own, the table none of the added columns")
    rows = df
    for k, rule in enumerate(rules):
        if rule.parent is not None:
            keys = rule.parent.toDF(f"_rl_key{k}").where(F.col(f"_rl_key{k}").isNotNull()).distinct()
            rows = rows.join(keys, F.col(rule.column) == F.col(f"_rl_key{k}"), "left").withColumn(
                f"_rl_{k}", F.col(rule.column).isNotNull() & F.col(f"_rl_key{k}").isNull()).drop(f"_rl_key{k}")
        elif rule.bad is not None:
            rows = rows.withColumn(f"_rl_{k}", F.coalesce(rule.bad, F.lit(False)))
    staged_at = scratch_path(spark, "rules-staged")
    rows.write.parquet(staged_at)
    rows = spark.read.schema(rows.schema).parquet(staged_at)
    for k, rule in enumerate(rules):
        if not rule.unique:
            continue
        whole = F.lit(True)
        for c in rule.unique:
            whole = whole & F.col(c).isNotNull()
        twice = rows.where(whole).groupBy(*rule.unique).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        twice = twice.select(*[F.col(c).alias(f"_rl_{k}_{i}") for i, c in enumerate(rule.unique)], F.lit(True).alias(f"_rl_{k}"))
        same = F.lit(True)
        for i, c in enumerate(rule.unique):
            same = same & (F.col(c) == F.col(f"_rl_{k}_{i}"))
        rows = rows.join(twice, same, "left").drop(*[f"_rl_{k}_{i}" for i in range(len(rule.unique))])
        rows = rows.withColumn(f"_rl_{k}", F.coalesce(f"_rl_{k}", F.lit(False)))
    flags = F.array_compact(F.array(*[F.when(F.col(f"_rl_{k}"), F.lit(name)) for k, name in enumerate(names)])) if rules else F.array().cast("array<string>")
    told = rows.withColumn(FAILED, flags)
    seen = Observation()
    told = told.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size(FAILED) > 0).alias("failed"),
                        *[F.count_if(F.col(f"_rl_{k}")).alias(f"rule_{k}") for k in range(len(names))])
    told.select(*df.columns, FAILED, (F.size(FAILED) == 0).alias("kept")).write.partitionBy("kept").parquet(path)
    got = seen.get
    return Loaded(f"{path}/kept=true", f"{path}/kept=false", got["rows"], got["failed"], {n: got[f"rule_{k}"] for k, n in enumerate(names)})


def part(df: DataFrame, loaded: Loaded, kept: bool) -> DataFrame:
    """One part of a load of ``df``, read again; empty where no row fell into it."""
    schema = df.select("*", F.lit(None).cast("array<string>").alias(FAILED)).schema
    if (loaded.rows - loaded.failed if kept else loaded.failed) == 0:
        return df.sparkSession.createDataFrame([], schema)
    rows = df.sparkSession.read.schema(schema).parquet(loaded.good if kept else loaded.quarantine)
    return rows.drop(FAILED) if kept else rows
