"""Loads: rules with quarantine, mergeable distinct counts, types of a feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import parse_timestamp
from starloom.operators import profile, rules
from starloom.plans.feeds import Tables
from starloom.plans.registry import query
from starloom.session import scratch_path

_RULES_SQL = """
WITH x AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_clerk END AS clerk,
         CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y/%m/%d') ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS raw,
         o_orderkey - o_orderkey % 50 % 7 AS slot
  FROM (SELECT *, 'Clerk ' || (o_custkey % 1200) AS o_clerk FROM orders)),
f AS (
  SELECT *, clerk IS NULL AS b0, coalesce(length(clerk) > 9, FALSE) AS b1,
         raw IS NOT NULL AND try_strptime(raw, '%Y-%m-%d %H:%M:%S') IS NULL AS b2,
         count(*) OVER (PARTITION BY slot) > 1 AND slot IS NOT NULL AS b3,
         o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey % 8 <> 0 AND c.c_custkey = o_custkey) AS b4
  FROM x)
SELECT 'not_null clerk' AS rule, count(*) FILTER (WHERE b0) AS violations FROM f
UNION ALL SELECT 'max_length clerk', count(*) FILTER (WHERE b1) FROM f
UNION ALL SELECT 'parses raw', count(*) FILTER (WHERE b2) FROM f
UNION ALL SELECT 'unique slot', count(*) FILTER (WHERE b3) FROM f
UNION ALL SELECT 'foreign_key o_custkey', count(*) FILTER (WHERE b4) FROM f
UNION ALL SELECT 'rows read', count(*) FROM f
UNION ALL SELECT 'rows in quarantine', count(*) FILTER (WHERE b0 OR b1 OR b2 OR b3 OR b4) FROM f
UNION ALL SELECT 'rows loaded', count(*) FILTER (WHERE NOT (b0 OR b1 OR b2 OR b3 OR b4)) FROM f"""


@query("load_with_rules", _RULES_SQL)
def q_load_with_rules(spark, sf_dir):
    """The orders loaded under five rules: counts per rule, and the rows of
    both folders read back.  Missing clerks, other date forms, shared slots and
    customers that do not exist are made by a stated rule."""
    t = Tables(spark, sf_dir)
    key = F.col("o_orderkey")
    raw = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    clerk = F.when(key % 5 != 0, F.concat(F.lit("Clerk "), (F.col("o_custkey") % 1200).cast("string")))
    x = t.orders.select("o_orderkey", "o_custkey", clerk.alias("clerk"), raw.alias("raw"), (key - key % 50 % 7).alias("slot"))
    parents = t.customer.where(F.col("c_custkey") % 8 != 0)
    declared = [rules.not_null("clerk"), rules.max_length("clerk", 9), rules.parses("raw", parse_timestamp("raw")), rules.unique("slot"),
                rules.foreign_key("o_custkey", parents, "c_custkey")]
    got = rules.load_with_rules(x, declared, scratch_path(spark, "load-with-rules"))
    counts = [*got.violations.items(), ("rows read", got.rows)]
    told = spark.createDataFrame(counts, "rule string, violations bigint")
    for name, kept in (("rows in quarantine", False), ("rows loaded", True)):
        told = told.unionByName(rules.part(x, got, kept).agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations"))
    return told


@query("distinct_sketch_merge", """
WITH e AS (
  SELECT 'p_partkey' AS column_name, count(DISTINCT p_partkey) AS exact_count FROM part
  UNION ALL SELECT 'p_name', count(DISTINCT p_name) FROM part
  UNION ALL SELECT 'p_brand', count(DISTINCT p_brand) FROM part
  UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part
  UNION ALL SELECT 'p_size', count(DISTINCT p_size) FROM part
  UNION ALL SELECT 'p_retailprice', count(DISTINCT p_retailprice) FROM part)
SELECT column_name, CAST(3 AS BIGINT) AS loads, exact_count, TRUE AS within FROM e""")
def q_distinct_sketch_merge(spark, sf_dir):
    """Distinct values of each column of the parts from the sketches of three
    loads: whether the merged estimate lies within its stated bound."""
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    path = scratch_path(spark, "sketches")
    for k in range(3):  # stored per load; no load is read again
        profile.distinct_sketches(p.where(F.col("p_partkey") % 3 == k)).write.mode("append").parquet(path)
    merged = profile.merged_distincts(spark.read.parquet(path))
    exact = profile.distinct_counts(p).withColumnRenamed("distinct_count", "exact_count")
    return merged.join(exact, "column_name").select("column_name", "loads", "exact_count", F.col("exact_count").between(F.col("low"), F.col("high")).alias("within"))


@query("csv_infer", """
WITH o AS (SELECT *, o_orderkey % 10 = 3 AS gap FROM orders),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 100 <> 7) AS sound, count(*) FILTER (WHERE gap AND o_orderkey % 100 <> 7) AS gaps FROM o)
SELECT CAST(1 AS BIGINT) AS position, 'key' AS column_name, 'int' AS data_type, sound AS n_values, CAST(0 AS BIGINT) AS n_null FROM c
UNION ALL SELECT 2, 'big', 'bigint', sound, 0 FROM c
UNION ALL SELECT 3, 'price', 'double', sound, 0 FROM c
UNION ALL SELECT 4, 'day', 'date', sound - gaps, gaps FROM c
UNION ALL SELECT 5, 'time', 'timestamp_ntz', sound, 0 FROM c
UNION ALL SELECT 6, 'open', 'boolean', sound, 0 FROM c
UNION ALL SELECT 7, 'mixed', 'string', sound, 0 FROM c
UNION ALL SELECT 8, 'empty', 'string', 0, sound FROM c
UNION ALL SELECT 9, '_corrupt_record', 'string', n - sound, sound FROM c""")
def q_csv_infer(spark, sf_dir):
    """The orders written as a CSV feed with mixed columns and, by a stated
    rule, lines with a field too few or too many; its types, and the malformed
    lines counted."""
    from starloom.sources import infer
    o, key = Tables(spark, sf_dir).orders, F.col("o_orderkey")
    names = ["key", "big", "price", "day", "time", "open", "mixed", "empty"]
    fields = [key.cast("string"), (key + 5_000_000_000).cast("string"),
              F.when(key % 4 == 0, key.cast("string")).otherwise(F.concat(key.cast("string"), F.lit(".25"))),
              F.when(key % 10 == 3, F.lit("")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
              F.when(key % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
              F.when(key % 3 == 0, F.lit("true")).otherwise(F.lit("FALSE")),
              F.when(key % 50 == 0, F.lit("n/a")).otherwise(key.cast("string")), F.lit("")]
    line = F.concat_ws(",", *fields)
    line = F.when(key % 200 == 7, F.concat_ws(",", *fields[:5])).when(key % 200 == 107, F.concat(line, F.lit(",more"))).otherwise(line)
    path = scratch_path(spark, "feed-csv")
    o.select(line.alias("value")).write.text(path)
    text = infer.read_text_columns(spark, path, names, header=False)
    return infer.column_types(text)


def _star_sql() -> str:
    from starloom.plans.q_sources import _star_sql
    return _star_sql()


@query("star_resume", _star_sql())
def q_star_resume(spark, sf_dir):
    """The star loaded in two runs: the first ends with an error after three
    tables, the second goes on with the fourth; digests of the published
    tables."""
    from starloom.plans import facts
    from starloom.plans import q_warehouse as W
    from starloom.plans.q_sources import STAR_TEXT
    from starloom.sources import sinks
    from starloom.sources.resume import TableSet
    t = Tables(spark, sf_dir)

    def fact(read):
        rows = W.build_fact(t, *(read(n) for n in ("dim_country", "dim_date", "dim_party", "dim_election", "dim_election_history")))
        return facts.by_year(rows, read("dim_date"))

    def lost(read):
        raise ConnectionError("source went away")

    tables = {"dim_country": lambda read: W.build_dim_country(t), "dim_date": lambda read: W.build_dim_date(t), "dim_party": lambda read: W.build_dim_party(t),
              "dim_person": lambda read: W.build_dim_person(t, read("dim_country")), "dim_election": lambda read: W.build_dim_election(t, read("dim_date"), read("dim_country")),
              "dim_election_history": lambda read: W.build_dim_history(t), "fact_election_result": fact}
    star = TableSet(spark, scratch_path(spark, "star-resume"))
    try:
        star.load(1, tables | {"dim_person": lost})
    except ConnectionError:
        pass
    if star.paths():
        raise AssertionError("half a star is visible")
    again = star.load(1, tables, partition_by={"fact_election_result": ["year"]})
    if again != list(tables)[3:]:
        raise AssertionError(f"written again: {again}")
    return sinks.written_digests(spark, star.paths(), STAR_TEXT)


def _incremental_sql() -> str:
    from starloom.plans.q_warehouse import SQL_INCREMENTAL
    return SQL_INCREMENTAL


@query("incremental_dim_delta", _incremental_sql())
def q_incremental_dim_delta(spark, sf_dir):
    """The parts' names in two batches, the second added to the first as a
    file of new members."""
    from starloom.operators.dim_store import DimStore
    p = Tables(spark, sf_dir).part.select("p_partkey", F.concat("p_brand", F.lit(" "), "p_name").alias("name"))
    store = DimStore(spark, scratch_path(spark, "dim-delta"), "name")
    store.load(p.where(F.col("p_partkey") % 3 == 0), 0)
    store.load(p, 1)
    return store.read().select("id", "name")


@query("unmatched_suggestions", """
WITH k AS (SELECT DISTINCT p_brand || ' ' || p_name AS name FROM part),
w AS (SELECT CASE p_partkey % 5 WHEN 0 THEN substr(n, 1, 3) || substr(n, 5) WHEN 1 THEN substr(n, 1, 9) || 'x' || substr(n, 11) WHEN 2 THEN n || 'qq'
                  WHEN 3 THEN reverse(n) ELSE n END AS name
      FROM (SELECT p_partkey, p_brand || ' ' || p_name AS n FROM part)),
u AS (SELECT name, count(*) AS n_rows FROM w WHERE name NOT IN (SELECT name FROM k) GROUP BY name),
d AS (SELECT u.name, k.name AS suggestion, levenshtein(u.name, k.name) AS distance FROM u JOIN k ON levenshtein(u.name, k.name) <= 2),
b AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY distance, suggestion) AS rn FROM d)
SELECT u.name, n_rows, suggestion, CAST(coalesce(distance, -1) AS INTEGER) AS distance FROM u LEFT JOIN b ON b.name = u.name AND rn = 1""")
def q_unmatched_suggestions(spark, sf_dir):
    """Feed names that match no part (letters lost, changed or added by a
    stated rule) with the nearest known name."""
    from starloom.operators.lookup import anti_new
    from starloom.operators.similar import suggestions
    n, key = F.concat("p_brand", F.lit(" "), "p_name"), F.col("p_partkey") % 5
    p = Tables(spark, sf_dir).part.select(n.alias("known"), F.when(key == 0, F.concat(F.substring(n, 1, 3), F.substring(n, 5, 1 << 20)))
                                          .when(key == 1, F.concat(F.substring(n, 1, 9), F.lit("x"), F.substring(n, 11, 1 << 20)))
                                          .when(key == 2, F.concat(n, F.lit("qq"))).when(key == 3, F.reverse(n)).otherwise(n).alias("name"))
    known = p.select(F.col("known").alias("name")).distinct()
    return suggestions(anti_new(p.select("name"), known, ["name"]), known, "name", "name")
