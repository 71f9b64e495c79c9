"""As-of look-up: the version of a key that is valid at a fact's time.

Facts and versions are merged in order of key and time and the last version is
carried to the facts after it: one sorted pass, no join on inequalities.  Keys
with more rows than a task should hold are merged in stored ranges, and each
range takes over the version that the ranges before it end with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.keys import PART, PLACE, ranged
from starloom.operators.sequence import KEY_ROWS, large_keys

_ORDER = ["_ao_time", "_ao_kind", "_ao_turn", "_ao_tie"]


def as_of(facts: DataFrame, versions: DataFrame, keys: Sequence[str], time: str, since: str, carry: Sequence[str],
          until: str | None = None, turn: str | None = None, key_rows: int = KEY_ROWS) -> DataFrame:
    """Every row of ``facts`` with the columns ``carry`` of the version of its
    key that starts last at or before its ``time`` (column ``since`` of
    ``versions``); null where there is none, or where the version's ``until``
    is not after the time.  Of versions that start together the last by
    ``turn`` counts.  Keys are matched by equal names; null keys, and facts
    without a time, find no version; versions without a start are never found."""
    clash = set(carry) & set(facts.columns)
    if clash:
        raise ValueError(f"carried columns are in the facts already: {sorted(clash)}")
    keys = list(keys)
    version = [*[F.col(c) for c in carry], (F.col(until) if until else F.lit(None)).alias("_ao_until")]
    shape = versions.select(F.struct(*version).alias("v")).schema["v"].dataType
    fact = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    left = facts.select(*keys, F.col(time).alias("_ao_time"), F.lit(1).alias("_ao_kind"), F.lit(None).cast("bigint").alias("_ao_turn"),
                        fact.alias("_ao_fact"), F.lit(None).cast(shape).alias("_ao_version"))
    right = versions.where(F.col(since).isNotNull()).select(
        *keys, F.col(since).alias("_ao_time"), F.lit(0).alias("_ao_kind"), (F.col(turn) if turn else F.lit(None)).cast("bigint").alias("_ao_turn"),
        F.lit(None).cast(left.schema["_ao_fact"].dataType).alias("_ao_fact"), F.struct(*version).cast(shape).alias("_ao_version"))
    both = left.unionByName(right).withColumn("_ao_tie", F.xxhash64("_ao_version"))
    large = large_keys(both.select(*keys), keys, key_rows)
    if large is None:
        merged = _windows(both, keys)
    else:
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_sq_k{i}"))
        merged = _windows(both.join(large, same, "left_anti"), keys).unionByName(_ranges(both.join(large, same, "left_semi"), keys))
    known = F.col("_ao_time").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    valid = known & (F.col("_ao_last._ao_until").isNull() | (F.col("_ao_time") < F.col("_ao_last._ao_until")))
    out = merged.where(F.col("_ao_kind") == 1)
    return out.select(*[F.col("_ao_fact")[c].alias(c) for c in facts.columns], *[F.when(valid, F.col("_ao_last")[c]).alias(c) for c in carry])


def _carried(window) -> Column:
    return F.last("_ao_version", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _windows(both: DataFrame, keys: list[str]) -> DataFrame:
    return both.withColumn("_ao_last", _carried(Window.partitionBy(*keys).orderBy(*_ORDER)))


def _ranges(both: DataFrame, keys: list[str]) -> DataFrame:
    stored = ranged(both, [*keys, *_ORDER])
    # the version with its key: a range may begin in the middle of one
    own = F.struct(*[F.col(k).alias(f"_ao_k{i}") for i, k in enumerate(keys)], F.col("_ao_version").alias("v"))
    held = F.when(F.col("_ao_version").isNotNull(), own)
    rows = stored.withColumn("_ao_own", held)
    ends = rows.groupBy(PART).agg(F.max_by("_ao_own", F.when(F.col("_ao_own").isNotNull(), F.col(PLACE))).alias("_ao_end"))
    # one row per range: what the ranges before it carry on
    before = F.last("_ao_end", ignorenulls=True).over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(F.col(PART).alias("_ao_part"), before.alias("_ao_before"))
    inside = Window.partitionBy(PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumn("_ao_own", F.last("_ao_own", ignorenulls=True).over(inside))
    out = out.join(F.broadcast(ends), F.col(PART) == F.col("_ao_part")).withColumn("_ao_own", F.coalesce("_ao_own", "_ao_before"))
    same = F.col("_ao_own").isNotNull()
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col("_ao_own")[f"_ao_k{i}"])
    return out.withColumn("_ao_last", F.when(same, F.col("_ao_own")["v"])).select(*both.columns, "_ao_last")
