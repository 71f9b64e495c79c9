"""Mixing sources to target weights along a time-varying curriculum.

Each source's documents form a stream in a fixed hash order.  Its target is
its weight's share of all words, at most ``max_repeats`` times its size (the
excess goes to the other sources by weight).  Its schedule, a rate over
training time 0..1, integrates to that target; inverting the integral at a
document's place in the stream gives the time at which it is trained on, and
the mix is range-sorted by that time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import text_hash, written

WORDS = r"[^\x20\x09-\x0D]+"
#: Weights by rank of the source, repeating.
WEIGHTS = (5, 2, 1)
#: Knots (time, relative rate) of each weight's schedule: early, even, late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))


def targets(sources: DataFrame, weights=WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """Adds rank, weight and target to (source, source_size).  One row per
    source: the windows here order the sources, never documents.

    Sources are taken by rising cap / weight; one is capped if the level that
    the words left would reach, ``left / weights left``, is at or above that
    ratio.  The first that is not fixes the level of all after it."""
    everyone = Window.partitionBy()
    rank = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).cast("int")
    cap = F.col("source_size") * F.lit(max_repeats)
    turn = Window.orderBy("ratio", "rank")
    left = F.sum("source_size").over(everyone) - F.sum("cap").over(turn) + F.col("cap")
    level = left / (F.sum("weight").over(everyone) - F.sum("weight").over(turn) + F.col("weight"))
    return (sources.withColumn("rank", rank)
                   .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod("rank", F.lit(len(weights))) + 1))
                   .withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
                   .withColumn("level", level)
                   .withColumn("first", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "rank", "level"))).over(everyone))
                   .withColumn("target", F.least(F.col("cap").cast("double"),
                                                 F.coalesce(F.col("weight") * F.col("first.level"), F.col("cap").cast("double"))))
                   .select("source", "source_size", "rank", "target"))


def _segments(knots) -> list[tuple[float, float, float, float, float]]:
    """(share before, share after, time before, rate, slope) of each piece,
    scaled so that the whole integrates to 1."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
    out, done = [], 0.0
    for (t0, r0), (t1, r1) in zip(knots, knots[1:]):
        r0, r1 = r0 / area, r1 / area
        after = done + (t1 - t0) * (r0 + r1) / 2
        out.append((done, after, t0, r0, (r1 - r0) / (t1 - t0)))
        done = after
    return out


def training_time(share: Column, schedule: Column, schedules=SCHEDULES) -> Column:
    """Time at which a source whose schedule has index ``schedule`` has used
    ``share`` (0..1) of its target: the inverse of the integrated schedule,
    a quadratic in each piece."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        time = None
        for before, after, t0, rate, slope in reversed(_segments(knots)):
            rest = share - F.lit(before)
            root = F.sqrt(F.greatest(F.lit(rate * rate) + F.lit(2.0 * slope) * rest, F.lit(0.0)))
            here = F.lit(t0) + F.coalesce(F.try_divide(F.lit(2.0) * rest, F.lit(rate) + root), F.lit(0.0))
            time = here if time is None else F.when(share < F.lit(after), here).otherwise(time)
        out = F.when(schedule == k, time).otherwise(out)
    return out


def mix(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, max_repeats: int = 3) -> DataFrame:
    """(doc_id, text_hash, source, size, source_size, target, passes) for every row of
    ``docs`` (doc_id, source, text; others ignored); ``passes`` lists each time
    the mix takes the document: pass number, words taken, training time.

    A source's stream is its documents in order of md5(doc_id), ties by doc_id
    and size, repeated up to ``max_repeats`` times; it is taken up to the
    rounded target, so the last document may be taken in part.  Null text has
    size 0 and is never taken; null sources form one source, ranked last.
    Running totals are kept per block of a source (4096 by hash), so that a
    source with a third of all rows is split over many tasks."""
    rows = written(docs.select(F.col("doc_id").cast("bigint"), text_hash().alias("text_hash"), "source",
                               F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS)).cast("bigint").alias("size"),
                               F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("turn")), "mix-sizes")
    rows = rows.withColumn("block", F.substring("turn", 1, 3))
    blocks = written(rows.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    goals = targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_repeats)
    by_block = Window.partitionBy("source").orderBy("block")
    starts = (blocks.withColumn("before", F.sum("words").over(by_block) - F.col("words"))
                    .join(goals.withColumnRenamed("source", "goal"), F.col("source").eqNullSafe(F.col("goal")))
                    .select(F.col("source").alias("s"), F.col("block").alias("b"), "before", "source_size", "rank", "target"))
    within = Window.partitionBy("source", "block").orderBy("turn", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.withColumn("within", F.sum("size").over(within) - F.col("size"))
                  .join(written(starts, "mix-starts"), F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
                  .withColumn("start", F.col("before") + F.col("within"))
                  .withColumn("goal", F.floor(F.col("target") + F.lit(0.5)).cast("bigint")))

    def one(k: int) -> Column:
        begin = F.col("start") + F.lit(k) * F.col("source_size")
        words = F.least(F.col("size"), F.greatest(F.col("goal") - begin, F.lit(0).cast("bigint")))
        share = (begin + words / F.lit(2.0)) / F.col("goal")
        return F.struct(F.lit(k).alias("pass"), words.alias("words"),
                        F.when(words > 0, training_time(share, F.pmod("rank", F.lit(len(schedules))), schedules)).alias("time"))

    passes = F.filter(F.array(*[one(k) for k in range(max_repeats)]), lambda p: p["words"] > 0)
    return placed.select("doc_id", "text_hash", "source", "size", "source_size", "target", passes.alias("passes"))


def in_training_order(df: DataFrame, time: str, *ties: str) -> DataFrame:
    """Range-sorted by training time, then ``ties`` (which also spread rows
    without a time): partition i precedes partition i + 1."""
    order = [F.col(c).asc_nulls_last() for c in (time, *ties)]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)
