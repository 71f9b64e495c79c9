"""Projection, filter, join, sort and union queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import clean_name, fold_accents
from starloom.operators.columns import first_present, with_defaults
from starloom.operators.dedupe import union_prefer
from starloom.operators.keys import dense_key
from starloom.operators.lookup import anti_new, join_dim, semi_exists
from starloom.plans.feeds import Tables, nation_regions
from starloom.plans.generate import month_grid
from starloom.plans.registry import query
from starloom.plans.sqlfrag import initcap_word


# ---------------------------------------------------------------- projections
@query("project_clean", f"""
SELECT CAST(c_custkey AS BIGINT) AS customer_id, {initcap_word('trim(c_name)')} AS name,
       CAST(c_nationkey AS BIGINT) AS nation_id, c_acctbal AS balance,
       {initcap_word('trim(c_mktsegment)')} AS segment
FROM customer""")
def q_project_clean(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select(F.col("c_custkey").cast("bigint").alias("customer_id"), clean_name("c_name").alias("name"),
                    F.col("c_nationkey").cast("bigint").alias("nation_id"),
                    F.col("c_acctbal").cast("double").alias("balance"), clean_name("c_mktsegment").alias("segment"))


@query("project_columns", """
SELECT l_orderkey AS election_id, l_partkey AS party_id, l_linenumber AS mandates, l_quantity AS votes,
       l_discount AS percentage, l_tax AS valid_votes_percentage, l_extendedprice AS total_amount
FROM lineitem""")
def q_project_columns(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select(F.col("l_orderkey").alias("election_id"), F.col("l_partkey").alias("party_id"),
                     F.col("l_linenumber").alias("mandates"), F.col("l_quantity").alias("votes"),
                     F.col("l_discount").alias("percentage"), F.col("l_tax").alias("valid_votes_percentage"),
                     F.col("l_extendedprice").alias("total_amount"))


@query("select_all", "SELECT * FROM region")
def q_select_all(spark, sf_dir):
    return Tables(spark, sf_dir).region


@query("with_columns", """
SELECT *, year(o_orderdate) AS order_year, o_orderstatus = 'O' AS is_open,
       CASE WHEN o_totalprice >= 200000 THEN 'high' ELSE 'low' END AS price_band
FROM orders""")
def q_with_columns(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.withColumns({
        "order_year": F.year("o_orderdate").cast("bigint"),
        "is_open": F.col("o_orderstatus") == "O",
        "price_band": F.when(F.col("o_totalprice") >= 200000, "high").otherwise("low"),
    })


@query("drop_columns", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def q_drop_columns(spark, sf_dir):
    return Tables(spark, sf_dir).part.drop("p_type", "p_size")


# ---------------------------------------------------------------- filters
@query("filter_gt", "SELECT * FROM orders WHERE o_orderkey > 10000")
def q_filter_gt(spark, sf_dir):
    return Tables(spark, sf_dir).orders.where(F.col("o_orderkey") > 10000)


@query("filter_eq", "SELECT * FROM nation WHERE n_name = 'NATION_3'")
def q_filter_eq(spark, sf_dir):
    return Tables(spark, sf_dir).nation.where(F.col("n_name") == "NATION_3")


@query("filter_and", "SELECT * FROM events WHERE user_id = 7 AND event_type = 'view'")
def q_filter_and(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.where((F.col("user_id") == 7) & (F.col("event_type") == "view"))


@query("filter_null", """
SELECT n.n_nationkey, n.n_name, n.n_regionkey
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE (CASE WHEN n.n_nationkey % 3 <> 0 THEN r.r_name END) IS NULL""")
def q_filter_null(spark, sf_dir):
    j = nation_regions(Tables(spark, sf_dir))
    return j.where(F.col("r_name").isNull()).select("n_nationkey", "n_name", "n_regionkey")


@query("dropna_subset", """
SELECT c.c_custkey, c.c_name, CASE WHEN n.n_nationkey % 3 <> 0 THEN r.r_name END AS region
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
     LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE (CASE WHEN n.n_nationkey % 3 <> 0 THEN r.r_name END) IS NOT NULL""")
def q_dropna_subset(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.customer.join(nation_regions(t), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return j.select("c_custkey", "c_name", F.col("r_name").alias("region")).dropna(how="any", subset=["region"])


@query("filter_not_in", """
SELECT * FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey < 5 AND n.n_nationkey = c.c_nationkey)""")
def q_filter_not_in(spark, sf_dir):
    """Nations below 5 stand for the rows already loaded."""
    t = Tables(spark, sf_dir)
    loaded = t.nation.where(F.col("n_nationkey") < 5).select(F.col("n_nationkey").alias("c_nationkey"))
    return anti_new(t.customer, loaded, ["c_nationkey"])


@query("filter_in_max", "SELECT * FROM orders WHERE o_orderkey IN (SELECT max(o_orderkey) FROM orders)")
def q_filter_in_max(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    m = o.agg(F.max("o_orderkey").alias("o_orderkey"))
    return o.join(m, "o_orderkey", "left_semi")


@query("pick_date_column", """
SELECT 'orders' AS source, o_orderdate AS time FROM orders
UNION ALL SELECT 'events' AS source, ts AS time FROM events""")
def q_pick_date_column(spark, sf_dir):
    t = Tables(spark, sf_dir)
    pref = ["time", "year", "o_orderdate", "ts"]
    out = None
    for name, df in (("orders", t.orders), ("events", t.events)):
        c = first_present(df, pref)
        part = df.select(F.lit(name).alias("source"), F.col(c).alias("time"))
        out = part if out is None else out.unionByName(part)
    return out


@query("default_missing_column", """
SELECT s_suppkey, s_name, s_nationkey, coalesce(s_acctbal, 0.0) AS s_acctbal,
       CAST(0 AS BIGINT) AS pre_blank_votes, CAST(0 AS BIGINT) AS pre_null_votes,
       CAST(0.0 AS DOUBLE) AS historical_turnout
FROM supplier""")
def q_default_missing_column(spark, sf_dir):
    s = Tables(spark, sf_dir).supplier
    return with_defaults(s, {"s_acctbal": 0.0, "pre_blank_votes": 0, "pre_null_votes": 0,
                             "historical_turnout": 0.0}) \
        .withColumn("pre_blank_votes", F.col("pre_blank_votes").cast("bigint")) \
        .withColumn("pre_null_votes", F.col("pre_null_votes").cast("bigint"))


# ---------------------------------------------------------------- joins
@query("left_lookup", """
SELECT n.n_regionkey AS regionkey, n.n_nationkey, n.n_name, r.r_name
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_left_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    n = t.nation.withColumnRenamed("n_regionkey", "regionkey")
    r = t.region.withColumnRenamed("r_regionkey", "regionkey")
    return join_dim(n, r, "regionkey", "left")


@query("replace_with_surrogate", """
WITH nd AS (SELECT row_number() OVER (ORDER BY n_name) AS nation_tk, n_nationkey FROM nation)
SELECT s.s_suppkey, s.s_name, nd.nation_tk FROM supplier s LEFT JOIN nd ON s.s_nationkey = nd.n_nationkey""")
def q_replace_with_surrogate(spark, sf_dir):
    from starloom.operators.lookup import replace_with_key
    t = Tables(spark, sf_dir)
    nd = dense_key(t.nation, ["n_name"], "nation_tk")
    return replace_with_key(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), nd,
                            "s_nationkey", "n_nationkey", "nation_tk", "nation_tk")


@query("fact_join", """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_quantity, o.o_orderdate, o.o_custkey, c.c_nationkey, n.n_name
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
     LEFT JOIN customer c ON o.o_custkey = c.c_custkey
     LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_fact_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    o = t.orders.select("o_orderkey", "o_orderdate", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    j = join_dim(li, o, li["l_orderkey"] == o["o_orderkey"], "left")
    j = join_dim(j, c, j["o_custkey"] == c["c_custkey"], "left")
    j = join_dim(j, t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"),
                 "left")
    return j.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "o_orderdate", "o_custkey",
                    "c_nationkey", "n_name")


@query("zip_by_row_number", """
SELECT n.rn, n.n_name, r.r_name
FROM (SELECT row_number() OVER (ORDER BY n_nationkey) AS rn, n_name FROM nation) n
JOIN (SELECT row_number() OVER (ORDER BY r_regionkey) AS rn, r_name FROM region) r ON n.rn = r.rn""")
def q_zip_by_row_number(spark, sf_dir):
    t = Tables(spark, sf_dir)
    n = dense_key(t.nation.select("n_nationkey", "n_name"), ["n_nationkey"], "rn")
    r = dense_key(t.region, ["r_regionkey"], "rn")
    return n.join(r, "rn", "inner").select("rn", "n_name", "r_name")


@query("cross_calendar", """
SELECT n.n_nationkey, m.month
FROM nation n, (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders) m""")
def q_cross_calendar(spark, sf_dir):
    t = Tables(spark, sf_dir)
    months = t.orders.select(F.trunc("o_orderdate", "month").alias("month"))
    return month_grid(months, "month", t.nation, "n_nationkey")


@query("semi_exists", """
SELECT * FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND year(o.o_orderdate) = 1998)""")
def q_semi_exists(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # the year as a range on the raw column, so the scan can skip row groups
    lo, hi = (F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz") for y in (1998, 1999))
    o = t.orders.where((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi)).select(
        F.col("o_custkey").alias("c_custkey"))
    return semi_exists(t.customer, o, ["c_custkey"])


@query("anti_new_rows", """
SELECT DISTINCT p_name, p_brand FROM part p
WHERE NOT EXISTS (SELECT 1 FROM part e WHERE e.p_partkey % 2 = 0 AND e.p_name = p.p_name AND e.p_brand = p.p_brand)""")
def q_anti_new_rows(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return anti_new(p.select("p_name", "p_brand").distinct(), p.where(F.col("p_partkey") % 2 == 0),
                    ["p_name", "p_brand"])


@query("map_lookup", """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, s.s_name
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey""")
def q_map_lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    s = t.supplier.select(F.col("s_suppkey"), F.col("s_name"))
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    return join_dim(li, s, li["l_suppkey"] == s["s_suppkey"], "left").drop("s_suppkey")


@query("accent_join", """
WITH a AS (SELECT n_nationkey, '  ' || translate(n_name, 'AEIO', 'ÁÊÍÕ') || ' ' AS display_name FROM nation)
SELECT a.n_nationkey, a.display_name, n.n_nationkey AS matched_key
FROM a LEFT JOIN nation n ON strip_accents(trim(a.display_name)) = n.n_name""")
def q_accent_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = t.nation.select("n_nationkey",
                        F.concat(F.lit("  "), F.translate("n_name", "AEIO", "ÁÊÍÕ"), F.lit(" ")).alias("display_name"))
    a = a.withColumn("_folded", fold_accents(F.trim("display_name")))
    n = t.nation.select(F.col("n_name").alias("_folded"), F.col("n_nationkey").alias("matched_key"))
    return join_dim(a, n, "_folded", "left").select("n_nationkey", "display_name", "matched_key")


@query("star_view", """
SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, o.o_orderdate, c.c_name, n.n_name, r.r_name
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
     JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_star_view(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    o = t.orders.select("o_orderkey", "o_orderdate", "o_custkey")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    geo = t.nation.join(t.region, t.nation["n_regionkey"] == t.region["r_regionkey"]).select(
        "n_nationkey", "n_name", "r_name")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(c, F.col("o_custkey") == c["c_custkey"])
    j = j.join(geo, F.col("c_nationkey") == geo["n_nationkey"])
    v = j.select("l_orderkey", "l_linenumber", "l_extendedprice", "o_orderdate", "c_name", "n_name", "r_name")
    v.createOrReplaceTempView("star_view")
    return v


# ---------------------------------------------------------------- sort / limit / union
@query("sort_asc", "SELECT * FROM supplier ORDER BY s_name")
def q_sort_asc(spark, sf_dir):
    return Tables(spark, sf_dir).supplier.orderBy("s_name")


@query("top_one", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def q_top_one(spark, sf_dir):
    return Tables(spark, sf_dir).orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(1)


@query("head_n", "SELECT * FROM customer ORDER BY c_custkey LIMIT 10")
def q_head_n(spark, sf_dir):
    return Tables(spark, sf_dir).customer.orderBy("c_custkey").limit(10)


@query("union_by_name", """
SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation_id, c_acctbal AS balance, 'customer' AS kind FROM customer
UNION ALL
SELECT s_suppkey AS id, s_name AS name, CAST(s_nationkey AS BIGINT) AS nation_id, s_acctbal AS balance, 'supplier' AS kind FROM supplier""")
def q_union_by_name(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t.customer.select(F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"),
                          F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_nationkey").cast("bigint").alias("nation_id"))
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                          F.col("s_nationkey").cast("bigint").alias("nation_id"),
                          F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"))
    return c.unionByName(s)


@query("union_missing_columns", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier""")
def q_union_missing_columns(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_mktsegment").alias("segment"))
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return c.unionByName(s, allowMissingColumns=True)


@query("union_dedupe", """
WITH u AS (
  SELECT p_partkey, p_name, 'db' AS source, 0 AS src_rank FROM part WHERE p_partkey % 3 <> 0
  UNION ALL SELECT p_partkey, upper(p_name) AS p_name, 'csv' AS source, 1 AS src_rank FROM part WHERE p_partkey % 3 <> 1)
SELECT p_partkey, p_name, source FROM (
  SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY src_rank) AS rn FROM u) x WHERE rn = 1""")
def q_union_dedupe(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    db = p.where(F.col("p_partkey") % 3 != 0).select("p_partkey", "p_name", F.lit("db").alias("source"))
    csv = p.where(F.col("p_partkey") % 3 != 1).select("p_partkey", F.upper("p_name").alias("p_name"),
                                                   F.lit("csv").alias("source"))
    return union_prefer([db, csv], ["p_partkey"])
