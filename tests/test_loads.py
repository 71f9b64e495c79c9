import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starloom.functions import collated, fold_accents, plain
from starloom.operators import profile, quality, rules
from starloom.operators.dedupe import spellings
from starloom.operators.lookup import collated_lookup
from starloom.session import scratch_path
from starloom.sources import infer


def _table(spark):
    rng = random.Random(7)
    data = [(i, rng.choice([None, 1, 1, 1, 2, 3, 40]), rng.choice([None, "a", "bb", "much too long"]), rng.choice(["2024-01-02", "x", None]), rng.randrange(200)) for i in range(300)]
    return spark.createDataFrame(data, "id int, parent int, name string, day string, slot int")


def test_rules_count_as_the_checks_do(spark):
    df, parents = _table(spark), spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parsed = F.try_to_timestamp("day", F.lit("yyyy-MM-dd"))
    declared = [rules.not_null("name"), rules.max_length("name", 5), rules.parses("day", parsed), rules.unique("slot"), *rules.one_to_one("parent", parents, "k")]
    got = rules.load_with_rules(df, declared, scratch_path(spark, "rules"))
    dup = {c: quality.duplicate_keys(df.where(F.col(c).isNotNull()), [c]).agg(F.sum("n_rows")).first()[0] for c in ("slot", "parent")}
    assert got.violations == {
        "not_null name": quality.not_null(df, ["name"]).first().violations, "max_length name": quality.too_long(df, "name", 5).count(),
        "parses day": quality.parse_failures(df.withColumn("p", parsed), "day", "p").first().n_failed,
        "unique slot": dup["slot"], "unique parent": dup["parent"], "foreign_key parent": quality.orphans(df, parents, "parent", "k").count()}
    kept, out = rules.part(df, got, True), rules.part(df, got, False)
    assert kept.count() + out.count() == got.rows == 300 and out.count() == got.failed
    assert rows(kept.unionByName(out.drop(rules.FAILED))) == rows(df)
    assert out.select(F.explode(rules.FAILED).alias("r")).groupBy("r").count().collect() and out.where(F.size(rules.FAILED) == 0).count() == 0
    told = {r.r: r["count"] for r in out.select(F.explode(rules.FAILED).alias("r")).groupBy("r").count().collect()}
    assert told == {k: v for k, v in got.violations.items() if v}


def test_rules_scan_the_input_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    df = _table(spark).mapInArrow(count, "id int, parent int, name string, day string, slot int")
    rules.load_with_rules(df, [rules.not_null("name"), rules.unique("slot"), rules.unique("id", "slot")], scratch_path(spark, "rules"))
    assert reads.value == 300


def test_rules_without_bad_rows_and_without_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    got = rules.load_with_rules(df, [rules.not_null("name"), rules.unique("id")], scratch_path(spark, "rules"))
    assert (got.rows, got.failed) == (2, 0) and rules.part(df, got, False).count() == 0 and rows(rules.part(df, got, True)) == rows(df)
    got = rules.load_with_rules(df.limit(0), [rules.unique("id")], scratch_path(spark, "rules"))
    assert (got.rows, got.failed) == (0, 0) and rules.part(df, got, True).count() == 0
    with pytest.raises(ValueError):
        rules.load_with_rules(df, [rules.not_null("id")] * 2, scratch_path(spark, "rules"))


def test_sketches_merge(spark):
    df = spark.range(30_000).select(F.col("id"), (F.col("id") % 977).alias("few"), F.lit(None).cast("string").alias("none"), (F.col("id") % 2 == 0).alias("flag"))
    parts = [profile.distinct_sketches(df.where(F.col("id") % 3 == k)) for k in range(3)]
    got = {r.column_name: r for r in profile.merged_distincts(parts[0].unionByName(parts[1]).unionByName(parts[2])).collect()}
    for name, exact in (("id", 30_000), ("few", 977), ("none", 0), ("flag", 2)):
        assert got[name].loads == 3 and got[name].low <= exact <= got[name].high
    assert got["id"].high - got["id"].low < 3500
    plan = profile.distinct_sketches(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_csv_types(spark):
    path = scratch_path(spark, "csv")
    lines = ["1,9999999999,1.5,2024-01-02,2024-01-02 03:04:05,true,a,,07", "-2,1,2,2024-02-30,2024-01-02,FALSE,1,,8", " 3 ,,1e3,2024-01-03,,true,,,", "4,5", "5,6,7,8,9,10,11,12,13,14"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    text = infer.read_text_columns(spark, path, list("abcdefghi"), header=False)
    got = {r.column_name: (r.data_type, r.n_values, r.n_null) for r in infer.column_types(text).collect()}
    assert got == {"a": ("int", 3, 0), "b": ("bigint", 2, 1), "c": ("double", 3, 0), "d": ("string", 3, 0), "e": ("timestamp_ntz", 2, 1), "f": ("boolean", 3, 0),
                   "g": ("string", 2, 1), "h": ("string", 0, 3), "i": ("int", 2, 1), "_corrupt_record": ("string", 2, 3)}
    assert sorted(r.line for r in infer.corrupt_rows(text).collect()) == sorted(lines[3:])
    table = infer.typed(text, infer.column_types(text))
    assert dict(table.dtypes)["e"] == "timestamp_ntz" and [r.a for r in table.orderBy("a").collect()] == [-2, 1, 3]
    assert table.where("b = 9999999999").first().e == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_collated_names(spark):
    feed = ["Việt Nam", "VIỆT NAM", "viet nam", "ΆΛΦΑ", "αλφα", "Ёлка", "ЕЛКА", "São Tomé", "none", None]
    dim = [(3, "Viet Nam"), (2, "VIỆT NAM"), (5, "Άλφα"), (6, "елка"), (7, "Sao Tome"), (8, None)]
    got = collated_lookup(spark.createDataFrame([(n,) for n in feed], "name string"), "name", spark.createDataFrame(dim, "id int, name string"), "name", "id", "key")
    assert {r.name: r.key for r in got.collect()} == dict(zip(feed, [2, 2, 2, 5, 5, 6, 6, 7, None, None])) and got.count() == len(feed)
    told = spellings(spark.createDataFrame([(n,) for n in feed + feed[:1]], "name string"), "name")
    assert sorted((r.n_rows, r.n_spellings) for r in told.collect()) == [(1, 1), (1, 1), (2, 2), (2, 2), (4, 3)]
    one = spark.createDataFrame([("É",)], "x string").select((collated("x") == "e").alias("same"), (plain(collated("x")) == "e").alias("bytes")).first()
    assert one.same and not one.bytes


def test_accents_of_all_scripts(spark):
    words = {"ǎ": "a", "ế": "e", "Ά": "Α", "ё": "е", "ẹ́": "e", "Łódź Øre Đà": "Lodz Ore Da", "ﬁn Straße Æ": "ﬁn Strasse AE", "日本 한글": "日本 한글", "": "", None: None}
    df = spark.createDataFrame([(w,) for w in words], "x string").select("x", fold_accents("x").alias("f"))
    assert {r.x: r.f for r in df.collect()} == words


def test_diagnostics(spark):
    df = spark.createDataFrame([(None, "a"), ("x", None), ("x", "b"), ("y", "b"), ("1", "b")], "t string, p string")
    got = quality.diagnostics(df, [("missing", F.col("t").isNull(), None), ("bad", F.col("t").isin("x", "y"), F.col("t")), ("place", F.col("p").isNull(), None)])
    assert rows(got) == sorted([("missing", None, 1), ("bad", "x", 2), ("bad", "y", 1), ("place", None, 1), ("rows read", None, 5), ("rows dropped", None, 4)], key=repr)
