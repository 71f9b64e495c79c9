"""Counting, profiling, dedupe, audit and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import parse_timestamp
from starloom.operators import profile, quality
from starloom.operators.dedupe import first_per_key
from starloom.operators.lookup import anti_new
from starloom.plans.feeds import Tables, nation_regions
from starloom.plans.registry import query


SQL_NATION_REGIONS = """nr AS (
  SELECT n.n_nationkey, n.n_name, CASE WHEN n.n_nationkey % 3 <> 0 THEN r.r_name END AS r_name
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""


@query("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def q_row_count(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem.agg(F.count(F.lit(1)).alias("n_rows"))


@query("table_shape", "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns FROM orders")
def q_table_shape(spark, sf_dir):
    return profile.shape(Tables(spark, sf_dir).orders)


@query("null_profile", f"""
WITH {SQL_NATION_REGIONS}
SELECT 'n_nationkey' AS column_name, count(*) FILTER (WHERE n_nationkey IS NULL) AS null_count FROM nr
UNION ALL SELECT 'n_name', count(*) FILTER (WHERE n_name IS NULL) FROM nr
UNION ALL SELECT 'r_name', count(*) FILTER (WHERE r_name IS NULL) FROM nr""")
def q_null_profile(spark, sf_dir):
    return profile.null_counts(nation_regions(Tables(spark, sf_dir)).drop("n_regionkey"))


@query("distinct_profile", """
SELECT 'p_partkey' AS column_name, count(DISTINCT p_partkey) AS distinct_count FROM part
UNION ALL SELECT 'p_name', count(DISTINCT p_name) FROM part
UNION ALL SELECT 'p_brand', count(DISTINCT p_brand) FROM part
UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part
UNION ALL SELECT 'p_size', count(DISTINCT p_size) FROM part
UNION ALL SELECT 'p_retailprice', count(DISTINCT p_retailprice) FROM part""")
def q_distinct_profile(spark, sf_dir):
    return profile.distinct_counts(Tables(spark, sf_dir).part)


@query("value_counts", """
SELECT 'p_brand' AS column_name, p_brand AS value, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand
UNION ALL
SELECT 'p_type' AS column_name, p_type AS value, count(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY p_type""")
def q_value_counts(spark, sf_dir):
    return profile.value_counts(Tables(spark, sf_dir).part, ["p_brand", "p_type"])


@query("schema_profile")
def q_schema_profile(spark, sf_dir):
    return profile.schema_frame(spark, Tables(spark, sf_dir).orders)


@query("max_id", "SELECT coalesce(max(o_orderkey), 0) AS max_id FROM orders")
def q_max_id(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.agg(F.coalesce(F.max("o_orderkey"), F.lit(0)).cast("bigint").alias("max_id"))


@query("distinct_values", "SELECT DISTINCT p_brand FROM part")
def q_distinct_values(spark, sf_dir):
    return Tables(spark, sf_dir).part.select("p_brand").distinct()


@query("dedupe_subset", """
SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part WHERE p_name IS NOT NULL) x
WHERE rn = 1
UNION ALL SELECT * FROM part WHERE p_name IS NULL""")
def q_dedupe_subset(spark, sf_dir):
    return first_per_key(Tables(spark, sf_dir).part, ["p_name"], ["p_partkey"])


@query("dedupe_full", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def q_dedupe_full(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem.select("l_returnflag", "l_linestatus").distinct()


@query("group_size", """
SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderstatus, count(*) AS n_orders
FROM orders GROUP BY 1, 2""")
def q_group_size(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return profile.counts_by(o.withColumn("order_date", F.col("o_orderdate").cast("date")),
                             ["order_date", "o_orderstatus"], "n_orders")


def _segment_region(t):
    geo = t.nation.join(t.region, t.nation["n_regionkey"] == t.region["r_regionkey"]).select("n_nationkey", "r_name")
    return t.customer.join(geo, t.customer["c_nationkey"] == geo["n_nationkey"], "left")


@query("category_counts", """
SELECT c.c_mktsegment, r.r_name, count(*) AS n
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2""")
def q_category_counts(spark, sf_dir):
    return profile.counts_by(_segment_region(Tables(spark, sf_dir)), ["c_mktsegment", "r_name"])


# The pivot's columns, one per region.
REGION_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("category_pivot", """
SELECT c.c_mktsegment,
       count(*) FILTER (WHERE r.r_name = 'AFRICA') AS "AFRICA",
       count(*) FILTER (WHERE r.r_name = 'AMERICA') AS "AMERICA",
       count(*) FILTER (WHERE r.r_name = 'ASIA') AS "ASIA",
       count(*) FILTER (WHERE r.r_name = 'EUROPE') AS "EUROPE",
       count(*) FILTER (WHERE r.r_name = 'MIDDLE EAST') AS "MIDDLE EAST",
       count(*) FILTER (WHERE r.r_name IS NULL OR r.r_name NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')) AS "OTHER"
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1""")
def q_category_pivot(spark, sf_dir):
    t = Tables(spark, sf_dir)
    names = [*REGION_NAMES, "OTHER"]
    known = F.when(F.col("r_name").isin(REGION_NAMES), F.col("r_name")).otherwise(F.lit("OTHER"))
    p = _segment_region(t).withColumn("r_name", known).groupBy("c_mktsegment").pivot("r_name", names).agg(F.count(F.lit(1)))
    return p.na.fill(0, subset=names)


@query("load_audit", """
WITH target AS (SELECT p_partkey, p_brand FROM part WHERE p_partkey % 4 <> 0),
batch AS (SELECT p_partkey, CASE WHEN p_size > 25 THEN p_brand || '*' ELSE p_brand END AS p_brand FROM part WHERE p_partkey % 3 <> 0)
SELECT CASE WHEN t.p_partkey IS NULL THEN 'insert' WHEN t.p_brand IS DISTINCT FROM b.p_brand THEN 'update' ELSE 'skip' END AS action,
       count(*) AS n
FROM batch b LEFT JOIN target t ON b.p_partkey = t.p_partkey GROUP BY 1""")
def q_load_audit(spark, sf_dir):
    """Loaded rows and batch are overlapping thirds and quarters of the keys."""
    p = Tables(spark, sf_dir).part
    target = p.where(F.col("p_partkey") % 4 != 0).select("p_partkey", F.col("p_brand").alias("_old"), F.lit(True).alias("_hit"))
    batch = p.where(F.col("p_partkey") % 3 != 0).select(
        "p_partkey", F.when(F.col("p_size") > 25, F.concat("p_brand", F.lit("*"))).otherwise(F.col("p_brand")).alias("p_brand"))
    j = batch.join(target, "p_partkey", "left")
    action = (F.when(F.col("_hit").isNull(), "insert")
              .when(~F.col("_old").eqNullSafe(F.col("p_brand")), "update").otherwise("skip"))
    return j.select(action.alias("action")).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("unmatched_keys", """
SELECT n.n_regionkey + 2 AS region_ref, count(*) AS n_rows
FROM nation n WHERE NOT EXISTS (SELECT 1 FROM region r WHERE r.r_regionkey = n.n_regionkey + 2)
GROUP BY 1""")
def q_unmatched_keys(spark, sf_dir):
    """References two beyond a nation's region: some have no region."""
    t = Tables(spark, sf_dir)
    refs = t.nation.select((F.col("n_regionkey") + 2).alias("region_ref"))
    miss = anti_new(refs, t.region.select(F.col("r_regionkey").alias("region_ref")), ["region_ref"])
    return miss.groupBy("region_ref").agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- quality rules
@query("check_not_null", """
WITH cr AS (
  SELECT c.c_custkey, c.c_name, CASE WHEN n.n_nationkey % 3 <> 0 THEN r.r_name END AS region
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
       LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT 'c_custkey' AS column_name, count(*) FILTER (WHERE c_custkey IS NULL) AS violations, 'not_null' AS rule FROM cr
UNION ALL SELECT 'c_name', count(*) FILTER (WHERE c_name IS NULL), 'not_null' FROM cr
UNION ALL SELECT 'region', count(*) FILTER (WHERE region IS NULL), 'not_null' FROM cr""")
def q_check_not_null(spark, sf_dir):
    t = Tables(spark, sf_dir)
    nr = nation_regions(t).select("n_nationkey", F.col("r_name").alias("region"))
    cr = t.customer.join(nr, t.customer["c_nationkey"] == nr["n_nationkey"], "left")
    return quality.not_null(cr, ["c_custkey", "c_name", "region"])


@query("check_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def q_check_unique(spark, sf_dir):
    return quality.duplicate_keys(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


@query("check_foreign_key", """
SELECT * FROM customer c WHERE c.c_nationkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey < 20 AND n.n_nationkey = c.c_nationkey)""")
def q_check_foreign_key(spark, sf_dir):
    """Nations below 20 stand for a parent table with gaps."""
    t = Tables(spark, sf_dir)
    return quality.orphans(t.customer, t.nation.where(F.col("n_nationkey") < 20), "c_nationkey", "n_nationkey")


@query("check_parse", """
WITH x AS (
  SELECT o_orderstatus,
         CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y/%m/%d') ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS raw
  FROM orders)
SELECT o_orderstatus, count(raw) AS n_input,
       count(*) FILTER (WHERE raw IS NOT NULL AND try_strptime(raw, '%Y-%m-%d %H:%M:%S') IS NULL) AS n_failed
FROM x GROUP BY 1""")
def q_check_parse(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    raw = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy/MM/dd")) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    x = o.select("o_orderstatus", raw.alias("raw")).withColumn("parsed", parse_timestamp("raw"))
    return quality.parse_failures(x, "raw", "parsed", ["o_orderstatus"])


@query("check_one_to_one", """
SELECT count(*) AS violations, 'fk_reused' AS rule FROM (
  SELECT s_nationkey FROM supplier WHERE s_nationkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1) d
UNION ALL
SELECT count(*) AS violations, 'fk_orphan' AS rule FROM supplier s
WHERE s.s_nationkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = s.s_nationkey)""")
def q_check_one_to_one(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return quality.one_to_one(t.supplier, t.nation, "s_nationkey", "n_nationkey")


@query("check_length", "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 8")
def q_check_length(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return quality.too_long(p, "p_name", 8).select("p_partkey", "p_name")
