from conftest import rows
from starloom.operators import profile, quality


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 1.0), (3, None, 1.0)], "k int, s string, x double")
    assert profile.shape(df).first() == (3, 3)
    assert rows(profile.null_counts(df)) == [("k", 0), ("s", 1), ("x", 1)]
    assert rows(profile.distinct_counts(df)) == [("k", 3), ("s", 1), ("x", 1)]
    assert rows(profile.value_counts(df, ["s", "x"])) == [("s", "a", 2), ("x", "1.0", 2)]
    assert [r.column_name for r in profile.schema_frame(spark, df).collect()] == ["k", "s", "x"]


def test_quality_rules(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, None), (5, 99)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (11,)], "pk int")
    assert rows(quality.not_null(child, ["id", "fk"]), "column_name", "violations") == [("fk", 1), ("id", 0)]
    assert rows(quality.duplicate_keys(child, ["fk"])) == [(10, 2)]
    assert rows(quality.orphans(child, parent, "fk", "pk")) == [(5, 99)]
    assert rows(quality.one_to_one(child, parent, "fk", "pk"), "rule", "violations") == [("fk_orphan", 1), ("fk_reused", 1)]
    names = spark.createDataFrame([("short",), ("much longer",)], "n string")
    assert quality.too_long(names, "n", 8).count() == 1


def test_parse_failures(spark):
    from starloom.functions import parse_timestamp
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("nope",), (None,)], "raw string")
    out = quality.parse_failures(df.withColumn("p", parse_timestamp("raw")), "raw", "p").first()
    assert (out.n_input, out.n_failed) == (2, 1)
