"""Nearest known names for names that match nothing.

Names within ``k`` edits share one of their ``q * k + 1`` rarest q-grams: an edit
changes at most q of them.  So each name is looked up by these alone, candidates
come from rare grams only, and the edit distance is computed for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _grams(text: Column, q: int) -> Column:
    """q-grams of the padded text, each with its number among equal ones."""
    pad = F.lit("\u0001" * (q - 1))
    padded = F.concat(pad, text, pad)
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - q + 1), lambda i: F.substring(padded, i, F.lit(q)))
    return F.when(F.length(padded) >= q, F.transform(grams, lambda g, i: F.concat(
        g, F.lit("\u0002"), F.size(F.filter(F.slice(grams, F.lit(1), i), lambda x: x == g)).cast("string")))).otherwise(F.array().cast("array<string>"))


def _pieces(text: Column, most: int) -> Column:
    """All subsequences of a text of at most ``most`` letters: texts too short
    to share a gram share one of them.  Empty for longer texts."""
    def pick(mask: Column) -> Column:
        letters = [F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.substring(text, i + 1, 1)).otherwise(F.lit("")) for i in range(most)]
        return F.concat(F.lit("\u0003"), *letters)
    masks = F.sequence(F.lit(0), F.pow(F.lit(2), F.length(text)).cast("int") - 1)
    return F.when(F.length(text) <= most, F.array_distinct(F.transform(masks, pick))).otherwise(F.array().cast("array<string>"))


def suggestions(unmatched: DataFrame, known: DataFrame, name: str, known_name: str, k: int = 2, q: int = 2) -> DataFrame:
    """(name, n_rows, suggestion, distance): for every distinct non-null name
    of ``unmatched`` the nearest of the ``known`` names within ``k`` edits, ties
    to the smallest; null and -1 where there is none."""
    if k < 1 or q < 1:
        raise ValueError("k and q start at 1")
    wrong = unmatched.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("text")).agg(F.count(F.lit(1)).alias("n_rows"))
    right = known.where(F.col(known_name).isNotNull()).select(F.col(known_name).alias("text")).distinct()
    both = wrong.select("text", F.lit(False).alias("known")).unionByName(right.select("text", F.lit(True).alias("known")))
    grams = both.select("known", "text", F.explode(_grams(F.col("text"), q)).alias("gram"))
    held = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("holders"))
    rarest = F.slice(F.array_sort(F.collect_list(F.struct("holders", "gram"))), 1, q * k + 1)
    rare = grams.join(held, "gram").groupBy("known", "text").agg(rarest.alias("rare"))
    keys = rare.select("known", "text", F.explode("rare.gram").alias("key"))
    short = q * k - q + 1
    keys = keys.unionByName(both.select("known", "text", F.explode(_pieces(F.col("text"), short)).alias("key")))
    left = keys.where(~F.col("known")).select("key", "text")
    other = keys.where("known").select("key", F.col("text").alias("suggestion"))
    pairs = left.join(other, "key").where(F.abs(F.length("text") - F.length("suggestion")) <= k).select("text", "suggestion").distinct()
    near = pairs.withColumn("distance", F.levenshtein("text", "suggestion", k)).where(F.col("distance") >= 0)
    best = near.groupBy("text").agg(F.min(F.struct("distance", "suggestion")).alias("best"))
    return (wrong.join(best, "text", "left")
                 .select(F.col("text").alias(name), "n_rows", F.col("best.suggestion").alias("suggestion"), F.coalesce("best.distance", F.lit(-1)).alias("distance")))
