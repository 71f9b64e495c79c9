"""Column-set helpers: declared cleaning, defaults for absent columns, first
present column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import clean_name

#: Text rules a cleaning spec may name.
TEXT_RULES = {"trim": F.trim, "name": clean_name, None: lambda c: c}


def clean(df: DataFrame, spec: Mapping[str, tuple]) -> DataFrame:
    """``spec``: output column → (source column, type, text rule or None).  A
    source column that ``df`` lacks gives typed nulls."""
    def one(out: str, source: str, kind: str, rule: str | None = None):
        value = TEXT_RULES[rule](F.col(source)) if source in df.columns else F.lit(None)
        return value.cast(kind).alias(out)
    return df.select(*[one(out, *how) for out, how in spec.items()])


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Every column of ``defaults`` exists afterwards: an absent column is
    the default literal, a present one has its nulls replaced by it."""
    out = df
    for name, value in defaults.items():
        lit = F.lit(value)
        out = out.withColumn(name, F.coalesce(F.col(name), lit) if name in df.columns else lit)
    return out


def first_present(df: DataFrame, preference: Sequence[str]) -> str:
    for c in preference:
        if c in df.columns:
            return c
    raise ValueError(f"none of {list(preference)} in {df.columns}")
