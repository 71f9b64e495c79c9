"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import written


def _star(edges: DataFrame) -> DataFrame:
    """Every neighbour of u (and u) is tied to the smallest of them.  ``edges``
    (u, v) holds each u with the neighbours this star looks at."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star")
    return edges.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is
    its smallest node.  Large and small stars alternate until the edges stay
    as they are; each round ends in a written table, and a node with very many
    links is reduced to a minimum before it meets them again."""
    edges = written(links.filter(F.col("a") != F.col("b"))
                         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(_star(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .filter("u != v").distinct(), "large-star")
        tied = _star(large)
        edges = written(tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(tied.select("u", F.col("m").alias("v")))
                        .filter("u != v").distinct(), "small-star")
        now = state(edges)
        if now == before:
            break
        before = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
                 .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
