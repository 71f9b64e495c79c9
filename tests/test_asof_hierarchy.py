import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starloom.operators.asof import as_of
from starloom.operators.hierarchy import Circle, closure, keyed_closure


def _plain_as_of(facts, versions):
    out = []
    for k, t, i in facts:
        found = [v for v in versions if k is not None and v[0] == k and t is not None and v[1] is not None and v[1] <= t]
        v = max(found, key=lambda v: (v[1], v[3])) if found else None
        out.append((k, t, i, *((v[4], v[3]) if v and (v[2] is None or t < v[2]) else (None, None))))
    return out


@pytest.mark.parametrize("key_rows", [1 << 21, 50, 1])
def test_as_of(spark, key_rows):
    """A hot key with a third of all rows, ties, gaps, keys without versions."""
    rng = random.Random(1)
    key = lambda: rng.choice([0, 0, 0, 0, 1, 2, 3, 4, None])
    facts = [(key(), rng.choice([None, *range(100)]), i) for i in range(400)] + [(9, 5, 1000)]
    versions = [(k, rng.choice([None, *range(0, 100, 3)]), rng.choice([None, 40, 90]), i, f"v{i}") for i, k in enumerate(key() for _ in range(120)) if k != 4]
    f = spark.createDataFrame(facts, "k int, t int, id int").repartition(5)
    v = spark.createDataFrame(versions, "k int, since int, until int, no int, name string").repartition(3)
    got = as_of(f, v, ["k"], "t", "since", ["name", "no"], until="until", turn="no", key_rows=key_rows)
    assert got.columns == ["k", "t", "id", "name", "no"]
    assert rows(got) == sorted(_plain_as_of(facts, versions), key=repr)
    assert as_of(f.limit(0), v, ["k"], "t", "since", ["name"], key_rows=key_rows).count() == 0
    assert as_of(f, v.limit(0), ["k"], "t", "since", ["name"], key_rows=key_rows).where("name is not null").count() == 0


def test_as_of_refuses_clashing_columns(spark):
    f = spark.createDataFrame([(1, 2, "x")], "k int, t int, name string")
    with pytest.raises(ValueError):
        as_of(f, spark.createDataFrame([(1, 2, "x")], "k int, since int, name string"), ["k"], "t", "since", ["name"])


def test_closure_of_ragged_trees(spark):
    rng = random.Random(2)
    parent = {("a", 0): None, ("b", 0): None}
    for h in "ab":
        for i in range(1, 60):
            parent[h, i] = i - 1 if i < 20 else rng.choice([None, *range(i)])  # one long branch, many short ones
    want = []
    for (h, i) in parent:
        at, depth = i, 0
        while at is not None:
            want.append((h, str(at), str(i), depth))
            at, depth = parent[h, at], depth + 1
    edges = [(h, str(i), None if p is None else str(p)) for (h, i), p in parent.items()]
    df = spark.createDataFrame(edges + edges[:9] + [("a", None, "5")], "h string, child string, parent string")
    assert rows(closure(df, ["h"])) == sorted(want, key=repr) and max(d for *_, d in want) >= 19
    keyed = keyed_closure(df, ["h"]).select("h", "descendant", "descendant_tk").distinct().orderBy("descendant_tk").collect()
    assert [(r.h, r.descendant, r.descendant_tk) for r in keyed] == [(h, m, i + 1) for i, (h, m) in enumerate(sorted((h, str(i)) for h, i in parent))]
    assert closure(df.limit(0), ["h"]).count() == 0


def test_closure_takes_the_shortest_way_and_refuses_circles(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (1, 4), (4, None)], "child int, parent int")
    assert rows(closure(df).where("descendant = 1")) == [(1, 1, 0), (2, 1, 1), (3, 1, 2), (4, 1, 1)]
    for circle in ([(1, 1)], [(1, 2), (2, 3), (3, 1)], [(i, (i + 1) % 9) for i in range(9)]):
        with pytest.raises(Circle):
            closure(spark.createDataFrame([*circle, (50, 51)], "child int, parent int"))
    assert closure(df.withColumn("child", F.lit(None).cast("int"))).count() == 0
