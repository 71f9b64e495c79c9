"""Edge cases named in FIXTURES §5: missing feed column, unmatched lookup,
padded/accented names, bad timestamp text, empty input, key in both
sources, second identical run."""

import datetime as dt

from conftest import rows
from starloom.functions import clean_name, fold_accents, parse_date
from starloom.operators.columns import first_present, with_defaults
from starloom.operators.lookup import anti_new, replace_with_key
from starloom.operators.scd2 import build_history
from starloom.plans import dims


def test_missing_feed_column_defaults(spark):
    feed = spark.createDataFrame([(1, None), (2, 5)], "id int, pre_blank_votes int")
    out = with_defaults(feed, {"pre_blank_votes": 0, "pre_null_votes": 0, "historical_turnout": 0.0})
    assert rows(out) == [(1, 0, 0, 0.0), (2, 5, 0, 0.0)]
    assert first_present(feed, ["time", "pre_blank_votes"]) == "pre_blank_votes"


def test_unmatched_lookup_keeps_row_with_null_key(spark):
    facts = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, nation int")
    dim = spark.createDataFrame([(10, 7)], "n int, tk long")
    out = replace_with_key(facts, dim, "nation", "n", "tk", "nation_tk")
    assert rows(out) == [(1, 7), (2, None), (3, None)]


def test_anti_join_keeps_null_keys(spark):
    new = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    old = spark.createDataFrame([(2,), (None,)], "k int")
    assert rows(anti_new(new, old, ["k"])) == [(1,), (None,)]


def test_padded_accented_names_join(spark):
    names = spark.createDataFrame([("  São Paulo ",), ("BRASÍLIA",), ("Goiás",)], "raw string")
    ref = spark.createDataFrame([("Sao Paulo", 1), ("Brasilia", 2)], "name string, id int")
    left = names.withColumn("k", fold_accents(clean_name("raw")))
    right = ref.withColumn("k", fold_accents(clean_name("name"))).select("k", "id")
    got = rows(left.join(right, "k", "left").select("raw", "id"))
    assert got == [("  São Paulo ", 1), ("BRASÍLIA", 2), ("Goiás", None)]


def test_bad_timestamp_text_is_counted_not_raised(spark):
    df = spark.createDataFrame([("2024-02-30 10:00:00",), ("31/12/2024",), ("2024-12-31 23:59:59",)], "x string")
    assert [r.d for r in df.select(parse_date("x").alias("d")).collect()] == [None, None, dt.date(2024, 12, 31)]


def test_empty_inputs(spark):
    empty_feed = spark.createDataFrame([], "k string, ts timestamp_ntz, id int")
    assert build_history(empty_feed, "k", "ts", ["id"]).count() == 0
    empty_db = spark.createDataFrame([], "id int, name string, region string")
    assert dims.dim_country(empty_db).count() == 0
    assert dims.dim_date([spark.createDataFrame([], "time string")]).count() == 0


def test_second_identical_run_same_keys(spark):
    db = spark.createDataFrame([(i, f"c{i}", None) for i in range(30)], "id int, name string, region string")
    a = rows(dims.dim_country(db))
    b = rows(dims.dim_country(db.repartition(5)))
    assert a == b


def test_key_in_both_sources_database_wins(spark):
    db = spark.createDataFrame([(1, "alpha", "north")], "id int, name string, region string")
    csv = spark.createDataFrame([("Alpha",), ("beta",)], "name string")
    got = {r.country_name: r.country_id for r in dims.dim_country(db, csv).collect()}
    assert got == {"Alpha": 1, "Beta": None}
