import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starloom.operators.dim_store import DimStore, DimStoreSink
from starloom.operators.similar import suggestions
from starloom.session import scratch_path
from starloom.sources.resume import TableSet, digest
from starloom.streaming.loaders import run_feed


def _names(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


@pytest.mark.parametrize("compact_after", [32, 1])
def test_dimension_grows_by_new_members(spark, compact_after):
    store = DimStore(spark, scratch_path(spark, "dim"), "name", compact_after=compact_after)
    assert store.read().count() == 0
    for n, part in enumerate([["b", "a", None, "b"], ["c", "a"], [], [None], ["e", "d", "c"]]):
        store.load(_names(spark, part), n)
    assert rows(store.read()) == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]
    store.load(_names(spark, ["z"]), 4)  # a committed batch again
    assert store.read().count() == 5


def test_old_members_are_not_rewritten(spark):
    store = DimStore(spark, scratch_path(spark, "dim"), "name")
    store.load(_names(spark, ["a", "b"]), 0)
    before = set(store.read().inputFiles())
    # what a failed batch left behind is written over and has taken no ids
    _names(spark, ["x"]).select(F.lit(77).cast("bigint").alias("id"), "name").write.parquet(f"{store.path}/data/batch=1")
    assert rows(store.read()) == [(1, "a"), (2, "b")]
    store.load(_names(spark, ["c", "a"]), 1)
    assert before < set(store.read().inputFiles()) and rows(store.read()) == [(1, "a"), (2, "b"), (3, "c")]


def test_stream_into_a_dimension(spark):
    source = scratch_path(spark, "dim-source")
    feed = _names(spark, [f"n{i % 17}" for i in range(100)])
    feed.repartition(3).write.parquet(source)
    store = DimStore(spark, scratch_path(spark, "dim"), "name")
    run_feed(spark, source, feed.schema, DimStoreSink(store), "d", max_files_per_trigger=1)
    got = store.read().collect()
    assert sorted(r.name for r in got) == sorted({f"n{i % 17}" for i in range(100)}) and sorted(r.id for r in got) == list(range(1, 18))


def test_load_goes_on_after_the_last_good_table(spark):
    made = []

    def table(name, rows_of):
        def make(read):
            made.append(name)
            return rows_of(read)
        return make

    def fails(read):
        raise OSError("gone")

    tables = {"a": table("a", lambda read: spark.range(5)), "b": table("b", lambda read: read("a").withColumn("x", F.col("id") * 2)), "c": table("c", lambda read: spark.range(3))}
    store = TableSet(spark, scratch_path(spark, "set"))
    with pytest.raises(OSError):
        store.load(1, tables | {"c": fails})
    assert store.paths() == {} and made == ["a", "b"]
    # contents that no longer have their digest are written again
    spark.range(4).write.mode("overwrite").parquet(f"{store.path}/tables/1/a")
    assert store.load(1, tables) == ["a", "c"] and made == ["a", "b", "a", "c"]
    assert sorted(store.paths()) == ["a", "b", "c"] and store.read("b").count() == 5
    assert store.load(1, tables) == []
    # the next version is not seen before it is whole
    with pytest.raises(OSError):
        store.load(2, {"a": table("a", lambda read: spark.range(9)), "c": fails})
    assert store.read("a").count() == 5
    store.load(2, {"a": table("a", lambda read: spark.range(9))})
    assert store.read("a").count() == 9 and list(store.paths()) == ["a"]


def test_digest(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    assert digest(a) == digest(a.select("v", "k").orderBy(F.desc("k"))) and digest(a) != digest(a.withColumn("v", F.lit("x"))) and digest(a.limit(0)) == (0, 0)


def _distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a):
        e = [i + 1]
        for j, y in enumerate(b):
            e.append(min(d[j] + (x != y), d[j + 1] + 1, e[j] + 1))
        d = e
    return d[-1]


@pytest.mark.parametrize("k,q", [(1, 2), (2, 2), (2, 3), (3, 2)])
def test_suggestions_equal_all_pairs(spark, k, q):
    rng = random.Random(k * 10 + q)
    known = ["".join(rng.choices("abé", k=rng.randrange(0, 9))) for _ in range(60)] + ["São Paulo", "Bahia", None]
    wrong = ["".join(rng.choices("abé", k=rng.randrange(0, 9))) for _ in range(40)] + ["Sao Paulo", "Bahai", "", None, "Bahai", "\U0001F600"]
    got = {r.name: (r.n_rows, r.suggestion, r.distance) for r in suggestions(_names(spark, wrong), _names(spark, known), "name", "name", k=k, q=q).collect()}
    want = {}
    for w in set(wrong) - {None}:
        best = min(((d, t.encode()) for t in set(known) - {None} if (d := _distance(w, t)) <= k), default=None)
        want[w] = (wrong.count(w), best[1].decode() if best else None, best[0] if best else -1)
    assert got == want
