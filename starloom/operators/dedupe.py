"""Repeatable de-duplication: which row survives is stated, never "any"."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.text import NAMES, collated


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence,
                  keep_null_keys: bool = True) -> DataFrame:
    """Keep the first row of every key in ``order`` (ascending column names;
    the other columns break remaining ties, so the pick is repeatable).

    Implemented as ``min(struct(order…, rest…))`` per key: map-side partial
    aggregation shrinks a hot key before the shuffle, where a window would
    send all its rows to one task.  Rows whose key is null are all kept when
    ``keep_null_keys`` (they are not duplicates of each other), else dropped.
    ``order`` takes column names only; ``last_per_key`` has the other end."""
    keys = list(keys)
    if not all(isinstance(o, str) for o in order):
        raise TypeError("order takes column names")
    rest = [c for c in df.columns if c not in keys]
    payload = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                       *[F.col(c) for c in rest])
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    if not keep_null_keys:
        return (df.where(~any_null).groupBy(*keys).agg(F.min(payload).alias("_p"))
                   .select(*keys, *[F.col("_p")[c].alias(c) for c in rest]).select(*df.columns))
    # Null-key rows are not duplicates of each other: they are grouped by
    # their whole value (one group per distinct row, with its multiplicity)
    # and expanded again, so the input is read once and no row is lost.
    whole = F.when(any_null, F.struct(*[F.col(c) for c in df.columns]))
    g = (df.groupBy(*keys, whole.alias("_dd_row"))
            .agg(F.min(payload).alias("_p"), F.count(F.lit(1)).alias("_dd_n")))
    g = g.withColumn("_dd_rep", F.explode(F.sequence(F.lit(1), F.when(F.col("_dd_row").isNull(), F.lit(1))
                                                     .otherwise(F.col("_dd_n").cast("int")))))
    return g.select(*keys, *[F.col("_p")[c].alias(c) for c in rest]).select(*df.columns)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row of every non-null key in ascending ``order``
    (``ORDER BY … DESC LIMIT 1`` per key), as ``max(struct(order…, rest…))``."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    payload = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                       *[F.col(c) for c in rest])
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    return (df.where(has_key).groupBy(*keys).agg(F.max(payload).alias("_p"))
              .select(*keys, *[F.col("_p")[c].alias(c) for c in rest])
              .select(*df.columns))


def union_prefer(frames: Sequence[DataFrame], keys: Sequence[str], order: Sequence | None = None) -> DataFrame:
    """Union by name; for a key present in several frames the earlier frame
    wins (then ``order`` inside a frame)."""
    tagged = [f.withColumn("_src_rank", F.lit(i)) for i, f in enumerate(frames)]
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t, allowMissingColumns=True)
    return first_per_key(u, keys, ["_src_rank", *(order or [])]).drop("_src_rank")


def spellings(df: DataFrame, name: str, collation: str = NAMES) -> DataFrame:
    """One row per name under a collation: (name, n_rows, n_spellings), the
    name in its smallest spelling by bytes; null names are left out."""
    counts = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    return (counts.groupBy(collated(name, collation).alias("_name"))
                  .agg(F.min(name).alias(name), F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_spellings")).drop("_name"))
