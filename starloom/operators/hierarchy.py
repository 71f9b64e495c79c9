"""Closure of hierarchies of any depth.

An edge table (child, parent) becomes the table of all ancestors with their
depth by path doubling: paths of up to 2, 4, 8 … steps, each round one join, so
a hierarchy of depth d takes about log2(d) rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import dense_key
from starloom.session import scratch_path


class Circle(ValueError):
    """A member is its own ancestor."""


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def closure(edges: DataFrame, by: Sequence[str] = (), child: str = "child", parent: str = "parent") -> DataFrame:
    """(by…, ancestor, descendant, depth) from edges; ``by`` tells hierarchies
    apart.  Every member is its own ancestor at depth 0.  An edge without a
    parent names a root, one without a child says nothing; repeated edges count
    once.  Branches may have any depth and a member several parents: of several
    ways the shortest counts.  A circle raises ``Circle``."""
    by = list(by)
    edges = _stored(edges.select(*by, F.col(child).alias("descendant"), F.col(parent).alias("ancestor")).where(F.col("descendant").isNotNull()).distinct(), "edges")
    paths = _stored(edges.where(F.col("ancestor").isNotNull()).withColumn("depth", F.lit(1).cast("bigint")), "paths")
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"u.{c}").eqNullSafe(F.col(f"l.{c}"))
    reach = 1
    while True:
        if not paths.where(F.col("ancestor") == F.col("descendant")).isEmpty():
            raise Circle("the hierarchy has a circle")
        lower = paths.where(F.col("depth") == reach)
        if lower.isEmpty():
            break
        longer = (lower.alias("l").join(paths.alias("u"), same & (F.col("l.ancestor") == F.col("u.descendant")))
                       .select(*[F.col(f"l.{c}") for c in by], F.col("l.descendant"), F.col("u.ancestor"), (F.col("u.depth") + reach).alias("depth")))
        paths = _stored(paths.unionByName(longer).groupBy(*by, "descendant", "ancestor").agg(F.min("depth").alias("depth")), "paths")
        reach *= 2
    members = edges.select(*by, "descendant").unionByName(edges.where(F.col("ancestor").isNotNull()).select(*by, F.col("ancestor").alias("descendant"))).distinct()
    own = members.withColumn("ancestor", F.col("descendant")).withColumn("depth", F.lit(0).cast("bigint"))
    return paths.unionByName(own).select(*by, "ancestor", "descendant", "depth")


def keyed_closure(edges: DataFrame, by: Sequence[str] = (), child: str = "child", parent: str = "parent") -> DataFrame:
    """``closure`` with a dense key per member, in order of ``by`` and name:
    adds ancestor_tk and descendant_tk."""
    by = list(by)
    paths = _stored(closure(edges, by, child, parent), "closure")
    members = _stored(dense_key(paths.where(F.col("depth") == 0).select(*by, F.col("descendant").alias("member")), [*by, "member"], "tk"), "members")
    for side in ("ancestor", "descendant"):
        names = members.select(*[F.col(c).alias(f"_h_{c}") for c in by], F.col("member").alias("_h_member"), F.col("tk").alias(f"{side}_tk"))
        same = F.col(side) == F.col("_h_member")
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_h_{c}"))
        paths = paths.join(names, same).drop("_h_member", *[f"_h_{c}" for c in by])
    return paths
