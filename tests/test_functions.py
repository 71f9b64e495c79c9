import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from starloom.functions import (
    add_minutes, clean_name, fold_accents, hash_between, hash_pick, parse_date, parse_timestamp, py_strip,
    safe_percentage, spread_between, valid_hms,
)
from starloom.plans import constants as K
from starloom.plans.history import date_ranges


def test_text_cleanup(spark):
    df = spark.createDataFrame([("  são paulo \t",), ("dos-santos",), (None,)], "x string")
    got = df.select(clean_name("x").alias("c"), py_strip("x").alias("s"), fold_accents(F.trim("x")).alias("f")).collect()
    assert got[0].c == "São Paulo \t" and got[0].s == "são paulo" and got[0].f == "sao paulo \t"
    assert got[1].c == "Dos-santos"          # initcap splits at spaces only
    assert got[2].c is None and got[2].f is None


def test_tolerant_parse(spark):
    df = spark.createDataFrame([("2024-03-01 10:11:12",), ("2024-13-01 00:00:00",), ("garbage",), (None,)], "x string")
    got = df.select(parse_timestamp("x").alias("t"), parse_date("x").alias("d")).collect()
    assert got[0].t == dt.datetime(2024, 3, 1, 10, 11, 12) and got[0].d == dt.date(2024, 3, 1)
    assert all(r.t is None and r.d is None for r in got[1:])


def test_valid_hms(spark):
    df = spark.createDataFrame([("18:00:00",), ("7:5:9",), ("24:00:00",), ("12:60:00",), ("x",)], "x string")
    assert [r.v for r in df.select(valid_hms("x").alias("v")).collect()] == ["18:00:00", "07:05:09", None, None, None]


def test_turnout_zero_guard(spark):
    df = spark.createDataFrame([(50, 100), (5, 0), (None, 3)], "a int, b int")
    assert [r.p for r in df.select(safe_percentage("a", "b").alias("p")).collect()] == [50.0, None, None]


def test_spread_fixture(spark):
    # golden: n=1 -> 18:00; n=2 -> 18:00, 23:00; n=6 -> hourly
    d = dt.date(2024, 5, 5)
    def spread(n):
        df = spark.createDataFrame([(d, i + 1, n) for i in range(n)], "d date, rn int, n int")
        return [r.t.strftime("%H:%M") for r in df.select(spread_between("d", "rn", "n").alias("t")).orderBy("t").collect()]
    assert spread(1) == ["18:00"]
    assert spread(2) == ["18:00", "23:00"]
    assert spread(6) == ["18:00", "19:00", "20:00", "21:00", "22:00", "23:00"]


def test_date_ranges_fixture(spark):
    # golden: 3 rows from 2020-01-01 00:00 in 60-minute steps, last open-ended
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    got = rows(date_ranges(df, ["k"]), "k", "date_from", "date_to")
    h = lambda i: dt.datetime(2020, 1, 1) + dt.timedelta(hours=i)
    assert got == [(1, h(0), h(1)), (2, h(1), h(2)), (3, h(2), dt.datetime(9999, 12, 31, 23, 59, 59))]


def test_add_minutes_large_counts(spark):
    df = spark.createDataFrame([(0,), (1,), (3_000_000,)], "n long")
    t0 = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    got = [r.t for r in df.select(add_minutes(t0, "n", 60).alias("t")).collect()]
    assert got[0] == dt.datetime(2020, 1, 1) and got[1] == dt.datetime(2020, 1, 1, 1)
    assert got[2] == dt.datetime(2020, 1, 1) + dt.timedelta(hours=3_000_000)


def test_hash_pick_repeatable(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("k"))
    a = rows(df.select("k", hash_pick("k", "region|", K.REGIONS).alias("r"), hash_between("k", "y|", 1950, 2000).alias("y")))
    b = rows(df.repartition(7).select("k", hash_pick("k", "region|", K.REGIONS).alias("r"),
                                      hash_between("k", "y|", 1950, 2000).alias("y")))
    assert a == b
    assert {r[1] for r in a} == set(K.REGIONS)
    assert all(1950 <= r[2] <= 2000 for r in a)


def test_fold_accents_letters(spark):
    df = spark.createDataFrame([("Ærø Ñandú",), ("Łódź Šibenik Ťažký",), ("Œuvre straße",), (None,)], "x string")
    assert [r.f for r in df.select(fold_accents("x").alias("f")).collect()] == ["AEro Nandu", "Lodz Sibenik Tazky", "OEuvre strasse", None]


def test_spread_large_group(spark):
    d = dt.date(2024, 5, 5)
    df = spark.createDataFrame([(d, 3_000_000_000, 3_000_000_000)], "d date, rn long, n long")
    assert df.select(spread_between("d", "rn", "n").alias("t")).first().t == dt.datetime(2024, 5, 5, 23)


def test_date_ranges_that_do_not_fit_fail(spark):
    import pytest
    df = spark.range(3).select(F.col("id").alias("k"))
    with pytest.raises(Exception, match="do not fit"):
        date_ranges(df, ["k"], step_minutes=3_000_000_000).collect()
