import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from starloom.operators.dedupe import first_per_key, last_per_key, union_prefer
from starloom.operators.sequence import flag_last, sequence_per_key


def test_first_per_key_nulls_dupes_ties(spark):
    df = spark.createDataFrame(
        [(1, 5, "b"), (1, 5, "a"), (1, 7, "z"), (2, 1, "q"), (None, 3, "n"), (None, 3, "n"), (None, 4, "m")],
        "k int, o int, v string")
    got = rows(first_per_key(df, ["k"], ["o"]))
    # tie on o=5 is broken by the remaining columns; null keys all kept (duplicates too)
    assert got == rows(spark.createDataFrame(
        [(1, 5, "a"), (2, 1, "q"), (None, 3, "n"), (None, 3, "n"), (None, 4, "m")], "k int, o int, v string"))
    dropped = rows(first_per_key(df, ["k"], ["o"], keep_null_keys=False))
    assert dropped == [(1, 5, "a"), (2, 1, "q")]


def test_first_per_key_empty(spark):
    df = spark.createDataFrame([], "k int, o int")
    assert first_per_key(df, ["k"], ["o"]).count() == 0


def test_last_per_key(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 3, "y"), (2, 2, "z"), (None, 9, "n")], "k int, t int, v string")
    assert rows(last_per_key(df, ["k"], ["t"])) == [(1, 3, "y"), (2, 2, "z")]


def test_union_prefer_first_source_wins(spark):
    db = spark.createDataFrame([(1, "db-a"), (2, "db-b")], "id int, name string")
    csv = spark.createDataFrame([(2, "csv-b"), (3, "csv-c")], "id int, name string")
    assert rows(union_prefer([db, csv], ["id"])) == [(1, "db-a"), (2, "db-b"), (3, "csv-c")]


def _seq_frame(spark):
    # key 0 holds a third of the rows (a hot key), plus a null key
    data = [(0 if i % 3 == 0 else i % 17, i, float(i)) for i in range(600)] + [(None, 1000, 1.0), (None, 1001, 2.0)]
    return spark.createDataFrame(data, "k int, t int, v double")


def test_sequence_per_key_matches_window(spark):
    df = _seq_frame(spark)
    w = Window.partitionBy("k").orderBy("t")
    expect = df.select("k", "t", F.row_number().over(w).cast("bigint").alias("rn"),
                       F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n"),
                       F.lead("v").over(w).alias("next_v"), F.lead("t").over(w).isNull().alias("last"))
    got = sequence_per_key(df, ["k"], ["t"], next_cols=["v"], rn="rn", size="n", is_last="last",
                           num_partitions=6)
    assert rows(got, "k", "t", "rn", "n", "next_v", "last") == rows(expect)


@pytest.mark.parametrize("key_rows", [1 << 21, 20, 1])
def test_sequence_with_large_keys_in_ranges(spark, key_rows):
    """All keys in windows, the hot and the null one in ranges, all in ranges."""
    df = _seq_frame(spark).unionByName(spark.createDataFrame([(None, 1000, 1.0)] * 40 + [(0, 5, 9.0)], "k int, t int, v double"))
    tie = [F.col("t"), F.xxhash64("k", "t", "v")]
    w = Window.partitionBy("k").orderBy(*tie)
    expect = df.select("k", "t", F.row_number().over(w).cast("bigint").alias("rn"), F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n"),
                       F.lead("v").over(w).alias("next_v"), F.lag("t").over(w).alias("prev_t"), (F.row_number().over(w) == 1).alias("first"),
                       F.lead("t").over(w).isNull().alias("last"))
    got = sequence_per_key(df, ["k"], ["t"], next_cols=["v"], prev_cols=["t"], rn="rn", size="n", is_first="first", is_last="last",
                           num_partitions=6, key_rows=key_rows)
    assert rows(got, *expect.columns) == rows(expect)
    assert sequence_per_key(df.limit(0), ["k"], ["t"], rn="rn", key_rows=key_rows).count() == 0


def test_sequence_is_one_exchange(spark):
    plan = sequence_per_key(_seq_frame(spark), ["k"], ["t"], next_cols=["v"], rn="rn", size="n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in plan


def test_flag_last(spark):
    df = _seq_frame(spark)
    expect = df.select("k", "t", F.lead("t").over(Window.partitionBy("k").orderBy("t")).isNull().alias("f"))
    assert rows(flag_last(df, ["k"], ["t"], "f"), "k", "t", "f") == rows(expect)
