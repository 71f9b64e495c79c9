import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from starloom.session import scratch_path
from starloom.sources import catalog, files, sinks


def test_csv_round_trip_with_bom_and_dots(spark):
    df = spark.createDataFrame([(1, "São", 2.5)], "`pre.id` int, `territory.name` string, `pre.blankVotes` double")
    path = files.write_csv(df, scratch_path(spark, "t-csv"), bom=True)
    back = files.read_csv(spark, path)
    assert back.columns == ["pre.id", "territory.name", "pre.blankVotes"]     # BOM gone
    got = back.select(files.dotted("pre.blankVotes").cast("double").alias(files.snake("pre.blankVotes")))
    assert got.columns == ["pre_blank_votes"] and got.first()[0] == 2.5


def test_read_tables_optional(spark):
    t = files.read_tables(spark, SF_SMALL, ["region", "nope"], optional=["nope"])
    assert list(t) == ["region"]
    with pytest.raises(Exception):
        files.read_tables(spark, SF_SMALL, ["nope"])


def test_catalog_and_sinks(spark):
    t = files.read_tables(spark, SF_SMALL, ["region"])
    files.register_views(t)
    cols = rows(catalog.columns_frame(spark, ["region"]))
    assert cols == [("region", "r_name", 2), ("region", "r_regionkey", 1)]
    with pytest.raises(LookupError):
        catalog.require_table(spark, "no_such_table")
    base = scratch_path(spark, "t-load")
    paths = sinks.load_all(spark, {"a": t["region"], "b": t["region"].limit(2)}, base)
    got = sinks.written_digests(spark, paths, {n: spark.read.parquet(p).columns for n, p in paths.items()})
    assert rows(got, "table_name", "row_count") == [("a", 5), ("b", 2)]
    sinks.append_table(t["region"], paths["a"])
    assert spark.read.parquet(paths["a"]).count() == 10


def test_checkpoint_dir_from_session(spark):
    from starloom.session import checkpoint_dir
    d = checkpoint_dir(spark)
    assert d == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(d.rstrip("/"))
    assert not os.path.exists(scratch_path(spark, "x"))


def test_scale_conf():
    from starloom.session import scale_conf
    big = scale_conf(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    small = scale_conf(10 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_tables_frame(spark):
    t = files.read_tables(spark, SF_SMALL, ["nation"])
    files.register_views(t)
    names = {r.table_name for r in catalog.tables_frame(spark).collect()}
    assert "nation" in names
