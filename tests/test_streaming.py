import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from starloom.operators.scd2 import build_history
from starloom.session import scratch_path
from starloom.streaming.loaders import DimSink, Scd2Sink, latest_snapshot, run_feed


def _write_batches(spark, base, frames):
    for i, f in enumerate(frames):
        f.coalesce(1).write.parquet(f"{base}/part{i}")


def test_scd2_stream_equals_batch_build(spark):
    t0 = dt.datetime(2024, 1, 1)
    data = [(f"T{i % 3}", t0 + dt.timedelta(hours=i), i) for i in range(30)]
    feed = spark.createDataFrame(data, "territory string, ts timestamp_ntz, id int")
    src = scratch_path(spark, "feed-src")
    _write_batches(spark, src, [feed.where(F.col("id") < 10), feed.where((F.col("id") >= 10) & (F.col("id") < 20)),
                                feed.where(F.col("id") >= 20)])
    target = scratch_path(spark, "feed-hist")
    run_feed(spark, src + "/*", feed.schema, Scd2Sink(target, "territory", "ts", ["id"]), "t-scd2",
             max_files_per_trigger=1)
    got = latest_snapshot(spark, target)
    want = build_history(feed, "territory", "ts", ["id"])
    cols = ["territory", "id", "version", "date_from", "date_to", "is_current"]
    assert rows(got, *cols) == rows(want, *cols)


def test_dim_stream_idempotent_ids(spark):
    names = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "name string")
    src = scratch_path(spark, "dim-src")
    _write_batches(spark, src, [names.where("name <> 'c'"), names])
    target = scratch_path(spark, "dim-target")
    run_feed(spark, src + "/*", names.schema, DimSink(target, "name"), "t-dim", max_files_per_trigger=1)
    assert rows(latest_snapshot(spark, target)) == [(1, "a"), (2, "b"), (3, "c")]


def test_second_run_goes_on_where_the_first_stopped(spark):
    names = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    src, target = scratch_path(spark, "again-src"), scratch_path(spark, "again-target")
    names.where("name <> 'c'").coalesce(1).write.parquet(f"{src}/part0")
    run_feed(spark, src + "/*", names.schema, DimSink(target, "name"), "t-again")
    assert rows(latest_snapshot(spark, target)) == [(1, "a"), (2, "b")]
    names.coalesce(1).write.parquet(f"{src}/part1")
    run_feed(spark, src + "/*", names.schema, DimSink(target, "name"), "t-again")
    assert rows(latest_snapshot(spark, target)) == [(1, "a"), (2, "b"), (3, "c")]


def test_nothing_committed_and_broken_manifest(spark):
    import pytest
    target = scratch_path(spark, "no-target")
    assert latest_snapshot(spark, target) is None
    spark.createDataFrame([("x",)], "other string").write.mode("overwrite").parquet(f"{target}/_manifest")
    with pytest.raises(Exception):
        latest_snapshot(spark, target)


def test_incremental_dim_stream_writes_its_batches_in_parallel(spark, tmp_path, monkeypatch):
    from conftest import SF_SMALL
    from starloom import session
    from starloom.plans.registry import load
    spark.read.parquet(f"{SF_SMALL}/part.parquet").repartition(4).write.parquet(str(tmp_path / "in/part.parquet"))
    monkeypatch.setattr(session, "scratch_path", lambda _, name: str(tmp_path / name))
    query = load()[0]["incremental_dim_stream"]
    got = rows(query(spark, str(tmp_path / "in")))
    for batch in ("first", "second"):
        assert len(list((tmp_path / "dim-source" / batch).glob("*.parquet"))) > 1
    assert [p.name for p in sorted((tmp_path / "dim-stream").glob("batch=*"))] == ["batch=0", "batch=1"]
    monkeypatch.undo()
    assert got == rows(query(spark, SF_SMALL))
