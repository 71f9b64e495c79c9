"""Repeatable "random" choices and small arithmetic helpers.

A choice is a pure function of (salt, key): the first 32 bits of
``md5(salt || key)`` modulo the pool size.  It is identical across runs,
partition counts and engines, unlike ``rand()``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_bucket(key, salt: str, n: int) -> Column:
    """Bucket 0..n-1 of ``key`` (any type, compared as text)."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(salt), _c(key).cast("string"))), 1, 8), 16, 10)
    return (h.cast("bigint") % F.lit(n)).cast("bigint")


def hash_pick(key, salt: str, pool: Sequence[str]) -> Column:
    """Pick one value of ``pool`` for ``key``."""
    arr = F.array(*[F.lit(v) for v in pool])
    return F.element_at(arr, (hash_bucket(key, salt, len(pool)) + 1).cast("int"))


def hash_between(key, salt: str, lo: int, hi: int) -> Column:
    """Integer in [lo, hi] for ``key``."""
    return (F.lit(lo) + hash_bucket(key, salt, hi - lo + 1)).cast("bigint")


def safe_percentage(part, whole) -> Column:
    """``part / whole * 100``; null when ``whole`` is 0 or null."""
    return F.try_divide(_c(part), _c(whole)) * F.lit(100)
