from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from starloom.operators.keys import continue_key, dense_key, max_key, row_number_key


def _frame(spark, n=500):
    # duplicates and nulls in the leading order column, a unique id breaks ties
    data = [((i % 7) if i % 11 else None, f"n{i % 13}", i) for i in range(n)]
    return spark.createDataFrame(data, "a int, b string, id int")


def test_dense_key_equals_row_number(spark):
    df = _frame(spark)
    order = ["a", "b", "id"]
    expect = df.withColumn("k", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    for parts in (1, 3, 8, 13):
        got = dense_key(df, order, "k", num_partitions=parts)
        assert rows(got, "id", "k") == rows(expect, "id", "k"), parts


def test_dense_key_no_gaps_and_offset(spark):
    got = dense_key(_frame(spark, 97), ["id"], "k", offset=1000, num_partitions=5)
    ks = sorted(r.k for r in got.collect())
    assert ks == list(range(1001, 1098))


def test_dense_key_repeatable(spark):
    df = _frame(spark)
    a = rows(dense_key(df, ["b", "id"], "k", num_partitions=4), "id", "k")
    b = rows(dense_key(df, ["b", "id"], "k", num_partitions=7), "id", "k")
    assert a == b


def test_dense_key_empty(spark):
    empty = spark.createDataFrame([], "a int")
    assert dense_key(empty, ["a"], "k").count() == 0


def test_row_number_key_offset(spark):
    df = spark.createDataFrame([("x",), ("b",), ("m",)], "name string")
    assert rows(row_number_key(df, ["name"], "k", offset=1000)) == [("b", 1001), ("m", 1002), ("x", 1003)]


def test_continue_key_from_max(spark):
    existing = spark.createDataFrame([(1, "a"), (7, "b")], "id long, name string")
    new = spark.createDataFrame([("d",), ("c",)], "name string")
    assert max_key(existing, "id") == 7
    got = continue_key(new, existing, "id", ["name"], "id")
    assert rows(got, "id", "name") == [(8, "c"), (9, "d")]
    empty = spark.createDataFrame([], "id long, name string")
    assert rows(continue_key(new, empty, "id", ["name"], "id"), "id", "name") == [(1, "c"), (2, "d")]


def test_dense_key_splits_hot_leading_value(spark):
    # a third of the rows share the leading order value: the range partitions
    # must still be balanced (the hot value is cut by the next column)
    data = [(0 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(data, "a int, b int")
    got = dense_key(df, ["a", "b"], "k", num_partitions=6)
    ks = sorted(r.k for r in got.collect())
    assert ks == list(range(1, 3001))
    ranged = df.repartitionByRange(6, "a", "b").withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in ranged.groupBy("p").count().collect()]
    assert max(sizes) < 2 * (3000 / 6)
    hot_parts = ranged.where("a = 0").select("p").distinct().count()
    assert hot_parts >= 2


def test_dense_key_total_and_ties(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "a int")
    got = dense_key(df, ["a"], "k", num_partitions=3, total="n")
    assert rows(got, "a", "k", "n") == [(1, 2, 4), (1, 3, 4), (2, 4, 4), (None, 1, 4)]


def test_grouped_key_equals_dense_key(spark, tmp_path):
    """Equal rows, null keys and numbers, by windows and through stored ranges."""
    from starloom.operators.sequence import grouped_key
    plain = [(k, n, f"x{(k * n) % 5}") for k in (7, 3, 9000000000, 1) for n in (0, 1, 5)]
    odd = {"none": [], "odd": [(3, 5, "b"), (3, 5, "a"), (3, 5, "a"), (3, None, "a"), (None, 2, "b"), (None, 1, "z"), (None, 1, "z")]}
    for what, more in odd.items():
        df = spark.createDataFrame(plain + more, "k bigint, n int, s string")
        want = rows(dense_key(df, ["k", "n", "s"], "id"))
        for key_rows in (1 << 21, 3):
            got = grouped_key(df, ["k", "n", "s"], "id", "last", key_rows=key_rows)
            assert rows(got, *df.columns, "id") == want, (what, key_rows)
            last = {}
            for k, *_, i in want:
                last[k] = max(i, last.get(k, 0))
            assert sorted(r.id for r in got.collect() if r["last"]) == sorted(last.values()), (what, key_rows)
    assert grouped_key(spark.createDataFrame([], "k bigint, n int, s string"), ["k", "n", "s"], "id").count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_sends_line_items_once_by_order(spark, tmp_path):
    """Line items pass one exchange by part and one by order: numbering, the
    order header and the look-ups by election share it."""
    from starloom.plans import q_warehouse as W
    from starloom.plans.feeds import Tables
    item = "(id div 3) as l_orderkey, id % 20 as l_partkey, 1L as l_suppkey, cast(id % 3 + 1 as int) as l_linenumber, 2D as l_quantity, 1D as l_extendedprice, 0D as l_discount, 0D as l_tax, 'R' as l_returnflag, 'O' as l_linestatus, timestamp_ntz'2020-01-01 00:00:00' as l_shipdate"
    made = {"lineitem": (300, item), "orders": (100, "id as o_orderkey, id % 7 as o_custkey, timestamp_ntz'2020-01-01 00:00:00' as o_orderdate"),
            "customer": (7, "id as c_custkey, cast(id % 3 as int) as c_nationkey"), "nation": (3, "cast(id as int) as n_nationkey, 'N' || id as n_name, 0 as n_regionkey"),
            "region": (1, "0 as r_regionkey, 'r' as r_name"), "events": (2, "timestamp_ntz'2020-01-02 00:00:00' as ts"),
            "part": (20, "id as p_partkey, 'Brand#' || id % 5 as p_brand, 'T' || id as p_type, cast(id as int) as p_size")}
    for name, (n, columns) in made.items():
        spark.range(n).selectExpr(*columns.split(", ")).write.parquet(f"{tmp_path}/{name}.parquet")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(kept, ("-1", "false")):
        spark.conf.set(k, v)
    try:
        fact = W.build_fact(Tables(spark, str(tmp_path)))
        plan = _plan(fact)
        assert sorted(r.fact_id for r in fact.collect()) == list(range(1, 301))
        assert fact.where("result_type = 'official'").count() == 100
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    sent = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert sum(x.startswith("l_") for x in sent) == 2, sent
    assert not any(x.startswith("coalesce(") for x in sent), sent
