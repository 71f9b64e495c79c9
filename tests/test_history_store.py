import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starloom.operators.history_store import HistorySink, HistoryStore
from starloom.operators.scd2 import build_history
from starloom.session import scratch_path
from starloom.streaming.loaders import run_feed

T0 = dt.datetime(2024, 1, 1)


def _feed(spark, data):
    return spark.createDataFrame([(k, T0 + dt.timedelta(hours=h), i, v) for k, h, i, v in data], "territory string, ts timestamp_ntz, id int, votes int")


def _store(spark, feed, **more):
    return HistoryStore(spark, scratch_path(spark, "history"), feed.schema, "territory", "ts", ["id"], **more)


@pytest.mark.parametrize("compact_after", [16, 1])
def test_batches_in_any_order_equal_building_at_once(spark, compact_after):
    rng = random.Random(4)
    key = lambda: "hot" if rng.random() < .3 else rng.choice([None, *"abcdefghijklmnop"])
    data = [(key(), rng.randrange(30), i, rng.randrange(9)) for i in range(160)]  # times tie, batches overlap
    store = _store(spark, _feed(spark, data), buckets=5, compact_after=compact_after)
    cuts = [data[:50], [], data[50:60], data[60:61], data[61:130], data[130:]]
    for n, part in enumerate(cuts):
        store.merge(_feed(spark, part), n)
    want = build_history(_feed(spark, data), "territory", "ts", ["id"])
    assert rows(store.read(), *want.columns) == rows(want)
    assert store.read(state="open").count() == want.where("is_current").count()
    for n, part in enumerate(cuts):  # replayed batches change nothing
        store.merge(_feed(spark, part), n)
    assert store.batches() == list(range(6)) and rows(store.read(), *want.columns) == rows(want)


def test_only_touched_buckets_are_rewritten(spark):
    first = [(f"T{i % 40}", i, i, 0) for i in range(120)]
    store = _store(spark, _feed(spark, first), buckets=16)
    store.merge(_feed(spark, first), 0)
    before = set(store.read().inputFiles())
    store.merge(_feed(spark, [("T3", 500, 900, 1), ("T3", 501, 901, 1)]), 1)
    after, fresh = set(store.read().inputFiles()), [f for f in store.read().inputFiles() if "batch=1/" in f]
    bucket = _feed(spark, [("T3", 0, 0, 0)]).select(F.pmod(F.xxhash64("territory"), F.lit(16))).first()[0]
    assert fresh and all(f"/bucket={bucket}/" in f for f in fresh)
    # of the old files only the bucket's open ones are gone; closed versions stay where they are
    assert all(f"state=open/bucket={bucket}/" in f for f in before - after)
    assert {f for f in before if "state=closed" in f} <= after and len(before & after) > 20
    late = [("T3", 3, 950, 1)]
    store.merge(_feed(spark, late), 2)
    last = set(store.read().inputFiles())
    assert all(f"/bucket={bucket}/" in f for f in (after - last) | (last - after))
    want = build_history(_feed(spark, [*first, ("T3", 500, 900, 1), ("T3", 501, 901, 1), *late]), "territory", "ts", ["id"])
    assert rows(store.read(), *want.columns) == rows(want)


def test_a_batch_without_a_manifest_does_not_count(spark):
    store = _store(spark, _feed(spark, []), buckets=4)
    assert store.read().count() == 0 and store.batches() == []
    store.merge(_feed(spark, [("a", 1, 1, 1)]), 0)
    # what a failed batch leaves behind
    store.read().withColumn("state", F.lit("open")).withColumn("bucket", F.lit(0)).write.partitionBy("state", "bucket").parquet(f"{store.path}/data/batch=1")
    assert store.read().count() == 1
    store.merge(_feed(spark, [("a", 2, 2, 1), ("b", 1, 3, 1)]), 1)
    assert rows(store.read(), "territory", "version", "is_current") == [("a", 1, False), ("a", 2, True), ("b", 1, True)]


def test_stream_into_the_store(spark):
    data = [(f"T{i % 7}", i % 11, i, i) for i in range(60)]
    feed, source = _feed(spark, data), scratch_path(spark, "history-source")
    feed.repartition(3).write.parquet(source)
    store = _store(spark, feed, buckets=3)
    run_feed(spark, source, feed.schema, HistorySink(store), "h", max_files_per_trigger=1)
    assert len(store.batches()) == 3
    want = build_history(feed, "territory", "ts", ["id"])
    assert rows(store.read(), *want.columns) == rows(want)
