"""Corpus pipeline: documents to packed training sequences.

Language ID, exact dedup, near-dedup, mixing to target weights, packing.  A
stage takes all rows that the one before it kept; all but the last return the
columns of documents (extra columns pass through).  Between stages the rows
are written to the folder named by ``spark.checkpoint.dir`` and read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm import curriculum, exact_index, langid, near_dups, packing
from starloom.llm.common import documents, text_hash, written


def _name() -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0).cast("bigint"))


def _named(verdicts: DataFrame, key: str, *more: str) -> DataFrame:
    """What joins rows to verdicts: doc_id (0 if null) and a hash of the text."""
    return verdicts.select(_name().alias("_llm_a"), F.col(key).alias("_llm_b"), *more)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told.  Those without a letter, or as near
    to two languages, go; with no labelled row to learn from, all stay."""
    model = langid.train(docs.select("doc_id", "text", "lang"))
    if not model.languages:
        return docs
    told = langid.identify(docs, model, *docs.columns, prefix="_llm_")
    return told.filter((F.col("_llm_lang_pred") != "und") & ~F.col("_llm_ambiguous")).select(*(F.col(f"`{c}`") for c in docs.columns))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: that with the smallest doc_id."""
    kept = written(_named(exact_index.exact_dedup(docs).filter("kept"), "key"), "pipeline-exact")
    rows = docs.withColumn("_llm_a", _name()).withColumn("_llm_b", F.xxhash64(exact_index.normalised(F.col("text"))))
    keys = ["_llm_a", "_llm_b"]
    # rows that repeat a doc_id and its text meet in one partition already
    return rows.join(kept, keys, "left_semi").dropDuplicates(keys).drop(*keys)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: that with the smallest
    doc_id (five-word shingles, similarity 0.8)."""
    kept = written(_named(near_dups.near_duplicates(docs).filter("kept"), "text_hash"), "pipeline-near")
    rows = docs.withColumn("_llm_a", _name()).withColumn("_llm_b", text_hash())
    return rows.join(kept, ["_llm_a", "_llm_b"], "left_semi").drop("_llm_a", "_llm_b")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order.  A pass
    counts if at least half of the document's words are taken in it."""
    passes = curriculum.mix(docs).withColumn("_llm_times", F.transform(
        F.filter("passes", lambda p: p["words"] * 2 >= F.col("size")), lambda p: p["time"]))
    same = Window.partitionBy("_llm_a", "_llm_b").orderBy(F.col("source").asc_nulls_last())
    told = _named(passes.withColumnRenamed("text_hash", "_h"), "_h", "source", "_llm_times").withColumn("_llm_n", F.row_number().over(same))
    told = written(told.filter(F.size("_llm_times") > 0).select("_llm_a", "_llm_b", F.col("_llm_n").alias("_llm_m"), "_llm_times"), "pipeline-mix")
    # rows that repeat a doc_id and its text are matched one to one
    rows = docs.withColumn("_llm_a", _name()).withColumn("_llm_b", text_hash()).withColumn("_llm_n", F.row_number().over(same))
    rows = rows.join(told, ["_llm_a", "_llm_b"]).filter(F.col("_llm_n") - F.col("_llm_m") == 0)
    taken = rows.withColumn("_llm_time", F.explode("_llm_times"))
    return curriculum.in_training_order(taken, "_llm_time").select(*(F.col(f"`{c}`") for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 ids."""
    return packing.pack(docs, "byte_bpe_50k.json", end_id=0)


STAGES = [("language ID", language), ("exact dedup", exact), ("near-dedup", near), ("mixing", mix), ("packing", pack)]

#: The models, hashes and tokenizer of the stages have no SQL; tests hold the
#: result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
