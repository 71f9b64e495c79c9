"""Exact dedup over an extendible-hash index on shared files.

A text's key is the hash of its normalised form.  The directory addresses
buckets by the leading bits of the key: as long as a bucket holds more than
``bucket_keys`` distinct keys, the directory doubles (one more bit) and the
bucket splits.  Copies share a key and so never overfill a bucket.  Each
directory slot is a range of keys and belongs to one task, which chains texts
with equal keys and compares them byte by byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import written

SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Null as empty; every run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _slot(key: Column, depth: int) -> Column:
    """The leading ``depth`` bits of a 64-bit key (two shifts: one of 64 bits
    would be none, and a constant slot would turn joins on it into products)."""
    return F.shiftrightunsigned(F.shiftrightunsigned(key, 1), 63 - depth)


def directory(keys: DataFrame, bucket_keys: int, max_depth: int = 40) -> tuple[DataFrame, int]:
    """(slot, depth, bucket) of the directory over the distinct 64-bit ``key``s,
    and its global depth.

    Distinct keys are counted once at a depth where buckets are surely small
    enough, then summed over every shallower depth: a bucket's local depth is
    the first at which it is not overfull.  Keys that agree in all bits looked
    at stay together and are chained."""
    n = keys.count()
    deepest = min(max_depth, max(0, (n // bucket_keys).bit_length()) + 3)
    fine = keys.groupBy(_slot(F.col("key"), deepest).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    levels = fine.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(deepest))).alias("depth"))
    prefix = F.expr(f"shiftrightunsigned(slot, {deepest} - depth)")
    sums = levels.groupBy("depth", prefix.alias("bucket")).agg(F.sum("n").alias("n"))
    fits = sums.filter((F.col("n") <= bucket_keys) | (F.col("depth") == deepest)).select("depth", "bucket")
    local = (levels.select("slot", "depth", prefix.alias("bucket")).join(fits, ["depth", "bucket"])
                   .groupBy("slot").agg(F.min("depth").alias("depth")))
    local = written(local, "exact-directory")
    depth = local.agg(F.max("depth")).first()[0] or 0
    # the directory proper: its slots have as many bits as its deepest bucket
    slots = local.select(F.expr(f"shiftrightunsigned(slot, {deepest - depth})").alias("slot"), "depth").distinct()
    return slots.withColumn("bucket", F.expr(f"shiftrightunsigned(slot, {depth} - depth)")), depth


def exact_dedup(docs: DataFrame, bucket_keys: int = 4096, key_bits: int = 64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, key, bucket, depth, chain)
    for every row of ``docs`` (doc_id, text; others ignored).

    ``keep_id`` is the smallest doc_id with an equal normalised text.  Rows
    without doc_id count in ``group_size`` and are kept only if no row of
    their group has one; rows that repeat a doc_id and its text are one
    document and share its verdict.  ``bucket`` and ``depth`` name the index
    bucket, ``chain`` the place among texts with the same key.  ``key_bits``
    below 64 makes keys collide (for tests)."""
    text = normalised(F.col("text"))
    key = F.xxhash64("norm") if key_bits == 64 else F.shiftleft(F.shiftrightunsigned(F.xxhash64("norm"), 64 - key_bits), 64 - key_bits)
    rows = docs.select(F.col("doc_id").cast("bigint"), text.alias("norm")).withColumn("key", key)
    entries = written(rows.select("doc_id", "key", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")), "exact-entries")
    slots, depth = directory(entries.select("key").distinct(), bucket_keys)
    # copies are summed up in the map tasks; the group key holds the bytes compared
    chains = (rows.groupBy(_slot(F.col("key"), depth).alias("slot"), "key", "norm")
                  .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                  .withColumn("text_sha256", F.sha2(F.col("norm").cast("binary"), 256)).drop("norm"))
    chained = chains.withColumn("chain", F.row_number().over(Window.partitionBy("slot", "key").orderBy("text_sha256")) - 1)
    index = written(chained.join(slots, "slot"), "exact-index")
    return (entries.join(index, ["key", "text_sha256"])
                   .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                           "text_sha256", "key", "bucket", "depth", "chain"))
