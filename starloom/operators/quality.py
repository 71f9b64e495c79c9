"""Declared constraints (NOT NULL, UNIQUE, FOREIGN KEY, 1:1, length, parse)
turned into checks.  Each returns violation counts or the violating keys as a
DataFrame; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(rule, column_name, violations) for every column, one scan."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, violations)") \
               .withColumn("rule", F.lit("not_null"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count (UNIQUE / PK)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col("n_rows") > 1))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null FK has no parent (null FKs are allowed)."""
    p = parent.select(F.col(parent_key).alias("_pk"))
    return child.where(F.col(child_key).isNotNull()).join(p, child[child_key] == p["_pk"], "left_anti")


def one_to_one(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """(rule, violations): FK values used more than once, and orphans."""
    dup = duplicate_keys(child.where(F.col(child_key).isNotNull()), [child_key])
    dup_n = dup.agg(F.count(F.lit(1)).alias("violations")).withColumn("rule", F.lit("fk_reused"))
    orph_n = orphans(child, parent, child_key, parent_key).agg(
        F.count(F.lit(1)).alias("violations")).withColumn("rule", F.lit("fk_orphan"))
    return dup_n.unionByName(orph_n)


def too_long(df: DataFrame, col: str, max_len: int) -> DataFrame:
    return df.where(F.length(F.col(col)) > max_len)


def parse_failures(df: DataFrame, raw: str, parsed: str, by: Sequence[str] = ()) -> DataFrame:
    """(…by, n_input, n_failed): text present but unparsable."""
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.count(F.col(raw)).alias("n_input"),
                 F.count_if(F.col(raw).isNotNull() & F.col(parsed).isNull()).alias("n_failed"))


def diagnostics(df: DataFrame, checks: Sequence[tuple[str, F.Column, F.Column | None]]) -> DataFrame:
    """(reason, value, n) from one pass: for every check (reason, condition of
    a bad row, its value to list or None) the number of bad rows by value, the
    rows read and the rows that fail any check (``rows dropped``).  A row
    counts under each of its reasons."""
    told = [F.when(bad, F.struct(F.lit(reason).alias("reason"), (F.lit(None) if value is None else value).cast("string").alias("value")))
            for reason, bad, value in checks]
    count = [F.struct(F.lit("rows read").alias("reason"), F.lit(None).cast("string").alias("value"))]
    any_bad = F.lit(False)
    for _, bad, _ in checks:
        any_bad = any_bad | F.coalesce(bad, F.lit(False))
    count.append(F.when(any_bad, F.struct(F.lit("rows dropped").alias("reason"), F.lit(None).cast("string").alias("value"))))
    rows = df.select(F.explode(F.array_compact(F.array(*told, *count))).alias("d"))
    return rows.groupBy("d.reason", "d.value").agg(F.count(F.lit(1)).alias("n"))
