"""Order MinHash fingerprints.

Tokens are words (single characters in scripts written without spaces).  Every
k-mer of tokens is numbered by occurrence, so repeats count, and hashed once;
the leading bits of the hash deal it to a bin.  Each bin keeps its ``width``
minimal k-mers, puts them back in text order and hashes the tuple.  Equal
components need the same k-mers in the same order, so the likeness of two
fingerprints follows edit distance, not just shared vocabulary.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import at, let

TOKEN = r"[\x{0E00}-\x{0EFF}\x{2E80}-\x{9FFF}\x{AC00}-\x{D7AF}\x{20000}-\x{3FFFF}]|[^\s\x{0E00}-\x{0EFF}\x{2E80}-\x{9FFF}\x{AC00}-\x{D7AF}\x{20000}-\x{3FFFF}]+"
#: Low bits that hold a k-mer's place; places beyond 2^24 tokens tie.
_PLACE = 24
_PLACES = (1 << _PLACE) - 1


def _high(x: Column) -> Column:
    return F.shiftrightunsigned(x, _PLACE)


def _packed(hashed: Column, place: Column) -> Column:
    """The hash's high bits with a place in its low bits: one sortable number."""
    return F.shiftleft(_high(hashed), _PLACE).bitwiseOR(place)


def fingerprint(text: Column, k: int = 3, width: int = 2, bin_bits: int = 6) -> Column:
    """array<int> of ``bin << 16 | component``, one entry per non-empty bin, in
    order of bin.  A text of fewer than k tokens has one k-mer, all of it; a
    null text or one without tokens has an empty fingerprint.  Linear in the
    text but for two sorts; nothing leaves the row."""
    def runs(kmers: Column) -> Column:
        """Occurrence-numbered k-mers from (k-mer, place) sorted: a run of
        equal k-mers starts where the value changes."""
        starts = F.filter(F.sequence(F.lit(0), F.size(kmers) - 1),
                          lambda i: (i == 0) | (_high(at(kmers, i)) != _high(at(kmers, i - 1))))
        return let(starts, lambda s: F.flatten(F.transform(s, lambda lo, j: F.transform(
            F.slice(kmers, lo + 1, F.coalesce(at(s, j + 1), F.size(kmers)) - lo),
            lambda x, nth: _packed(F.xxhash64(_high(x), nth), x.bitwiseAND(F.lit(_PLACES)))))))

    def bin_of(x: Column) -> Column:
        return F.shiftrightunsigned(x, 64 - bin_bits)

    def minimal(sorted_: Column) -> Column:
        """The first ``width`` of every bin."""
        return F.filter(sorted_, lambda x, i: (i < width) | (bin_of(at(sorted_, i - width)) != bin_of(x)))

    def components(chosen: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(0), F.size(chosen) - 1),
                          lambda i: (i == 0) | (bin_of(at(chosen, i)) != bin_of(at(chosen, i - 1))))

        def component(i: Column) -> Column:
            own = let(bin_of(at(chosen, i)), lambda b: F.filter(F.slice(chosen, i + 1, width), lambda x: bin_of(x) == b))
            # text order: place first, then the hash
            ordered = F.sort_array(F.transform(own, lambda x: F.shiftleft(x, 64 - _PLACE).bitwiseOR(_high(x))))
            told = F.xxhash64(F.transform(ordered, lambda x: F.shiftleft(x, _PLACE)))
            return (F.shiftleft(bin_of(at(chosen, i)), 16)).bitwiseOR(told.bitwiseAND(F.lit(0xFFFF))).cast("int")

        return F.transform(firsts, component)

    def of(tokens: Column) -> Column:
        n = F.greatest(F.size(tokens) - (k - 1), F.lit(1))
        kmers = let(F.transform(tokens, lambda t: F.xxhash64(t)), lambda h: F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: _packed(F.xxhash64(*[at(h, i + d) for d in range(k)]), F.least(i, F.lit(_PLACES)).cast("bigint"))))
        return F.when(F.size(tokens) > 0, let(F.sort_array(let(F.sort_array(kmers), runs)), lambda s: let(minimal(s), components)))

    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    return F.coalesce(let(tokens, of), F.array().cast("array<int>"))


def likeness(a: Column, b: Column) -> Column:
    """Equal components over bins that either fingerprint fills; 1 for two
    empty fingerprints."""
    def bins(x: Column) -> Column:
        return F.transform(x, lambda v: F.shiftright(v, 16))
    either = F.size(a) + F.size(b) - F.size(F.array_intersect(bins(a), bins(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def as_text(fp: Column) -> Column:
    """Two hexadecimal digits of bin and four of component for each entry."""
    return F.array_join(F.transform(fp, lambda v: F.lpad(F.hex(v), 6, "0")), "")


def with_next(docs: DataFrame, key: str, *columns: str) -> DataFrame:
    """``docs`` with, for each of ``columns``, ``next_<column>``: that of the
    following row in descending order of ``key`` (bigint; nulls last, ties by
    the columns' hash); the first row follows the last.

    Buckets of consecutive keys are cut at quantiles.  The head of a bucket is
    dealt to the bucket above as well, where it follows the last row, so that
    one exchange of the rows serves a window per bucket; the driver holds the
    bounds and heads of four buckets a shuffle partition, no rows."""
    spark = docs.sparkSession
    spot = docs.withColumn("_o", F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63))))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(spot.agg(F.percentile_approx("_o", [i / buckets for i in range(1, buckets)], 100 * buckets)).first()[0] or []))
    step = max(1, math.isqrt(len(bounds)))
    rows = [bounds[i:i + step] for i in range(0, len(bounds), step)]

    def numbers(values) -> Column:
        return F.array(*[F.lit(v).cast("bigint") for v in values]) if values else F.array().cast("array<bigint>")

    def below(values: Column, x: Column) -> Column:
        return F.size(F.filter(values, lambda v: v < x))

    grid = F.array(*[numbers(r) for r in rows]) if rows else F.array(numbers([]))
    # the rows of bounds that end below the key, then the bounds below it in the row after them
    bucket = let(below(numbers([r[-1] for r in rows]), F.col("_o")),
                 lambda j: j * step + F.coalesce(below(at(grid, j), F.col("_o")), F.lit(0)))
    spot = spot.withColumn("_b", bucket)
    heads = {r["_b"]: r["o"] for r in spot.groupBy("_b").agg(F.max("_o").alias("o")).collect()}
    used = sorted(heads)
    above = {b: used[(i + 1) % len(used)] for i, b in enumerate(used)}
    extra = F.lit(None).cast("int")
    if used:
        to = F.create_map(*[F.lit(x) for b in used for x in (heads[b], above[b])])
        extra = F.element_at(to, F.col("_o"))
    dealt = spot.select("*", F.posexplode(F.filter(F.array("_b", extra), lambda b: b.isNotNull())).alias("_ghost", "_to"))
    order = Window.partitionBy("_to").orderBy("_ghost", F.col("_o").desc(), F.col(key).desc_nulls_last(), F.xxhash64(*columns))
    return (dealt.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
                 .withColumnRenamed("_ghost", "is_ghost").withColumnRenamed("_to", "bucket").drop("_b"))
