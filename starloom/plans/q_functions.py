"""Scalar-function queries (text, casts, time parsing and arithmetic, picks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import (
    add_minutes, at_time_of_day, clean_name, fold_accents, hash_between, hash_pick, parse_date,
    parse_timestamp, py_strip, safe_percentage, try_int, valid_hms,
)
from starloom.operators.scd2 import open_end
from starloom.operators.sequence import sequence_per_key
from starloom.plans import constants as K
from starloom.plans.feeds import Tables
from starloom.plans.registry import query
from starloom.plans.sqlfrag import between, initcap_word, pick

PAD = "'  ' || n_name || ' ' || chr(9)"


@query("str_trim", f"""
SELECT n_nationkey, {PAD} AS padded, trim({PAD}, ' ') AS blank_trimmed,
       regexp_replace({PAD}, '^\\s+|\\s+$', '', 'g') AS stripped
FROM nation""")
def q_str_trim(spark, sf_dir):
    n = Tables(spark, sf_dir).nation
    padded = F.concat(F.lit("  "), F.col("n_name"), F.lit(" \t"))
    return n.select("n_nationkey", padded.alias("padded"), F.trim(padded).alias("blank_trimmed"),
                    py_strip(padded).alias("stripped"))


@query("str_initcap", f"SELECT DISTINCT c_mktsegment, {initcap_word('trim(c_mktsegment)')} AS segment FROM customer")
def q_str_initcap(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_mktsegment", clean_name("c_mktsegment").alias("segment")).distinct()


@query("casts", """
SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_text,
       CAST(o_orderdate AS DATE) AS order_date, TRY_CAST(o_orderpriority AS INTEGER) AS priority_bad,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority
FROM orders""")
def q_casts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select(F.col("o_orderkey").cast("int").alias("order_id"),
                    F.col("o_custkey").cast("string").alias("customer_text"),
                    F.col("o_orderdate").cast("date").alias("order_date"),
                    try_int("o_orderpriority").alias("priority_bad"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"))


@query("parse_timestamp", """
SELECT o_orderkey, strptime(strftime(o_orderdate, '%d.%m.%Y %H:%M'), '%d.%m.%Y %H:%M') AS parsed FROM orders""")
def q_parse_timestamp(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    txt = F.date_format("o_orderdate", "dd.MM.yyyy HH:mm")
    return o.select("o_orderkey", parse_timestamp(txt, "dd.MM.yyyy HH:mm").alias("parsed"))


@query("parse_date_tolerant", """
SELECT o_orderkey,
       CAST(try_strptime(CASE WHEN o_orderstatus = 'P' THEN 'not a date'
                              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END, '%Y-%m-%d %H:%M:%S') AS DATE) AS parsed_date
FROM orders""")
def q_parse_date_tolerant(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    txt = F.when(F.col("o_orderstatus") == "P", F.lit("not a date")) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return o.select("o_orderkey", parse_date(txt).alias("parsed_date"))


@query("fold_accents", """
SELECT n_nationkey, translate(n_name, 'AEIO', 'ÁÊÍÕ') AS accented,
       strip_accents(translate(n_name, 'AEIO', 'ÁÊÍÕ')) AS folded
FROM nation""")
def q_fold_accents(spark, sf_dir):
    n = Tables(spark, sf_dir).nation
    acc = F.translate("n_name", "AEIO", "ÁÊÍÕ")
    return n.select("n_nationkey", acc.alias("accented"), fold_accents(acc).alias("folded"))


@query("date_parts", """
SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day FROM orders""")
def q_date_parts(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("year"),
                    F.month("o_orderdate").cast("bigint").alias("month"),
                    F.dayofmonth("o_orderdate").cast("bigint").alias("day"))


@query("weekday_name", "SELECT o_orderkey, dayname(o_orderdate) AS weekday FROM orders")
def q_weekday_name(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", F.date_format("o_orderdate", "EEEE").alias("weekday"))


@query("date_text", """
SELECT event_id, CAST(ts AS DATE) AS event_date, strftime(ts, '%Y-%m-%d') AS event_date_text FROM events""")
def q_date_text(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.select("event_id", F.col("ts").cast("date").alias("event_date"),
                    F.date_format("ts", "yyyy-MM-dd").alias("event_date_text"))


@query("date_plus_time", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) + INTERVAL 18 HOUR AS opens_at,
       CAST(o_orderdate AS DATE) + INTERVAL 23 HOUR AS closes_at
FROM orders""")
def q_date_plus_time(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.select("o_orderkey", at_time_of_day("o_orderdate", 18).alias("opens_at"),
                    at_time_of_day("o_orderdate", 23).alias("closes_at"))


@query("add_minutes", """
SELECT n_nationkey, TIMESTAMP '2020-01-01 00:00:00' + to_minutes(CAST(n_nationkey * 60 AS BIGINT)) AS slot_ts
FROM nation""")
def q_add_minutes(spark, sf_dir):
    n = Tables(spark, sf_dir).nation
    t0 = F.lit(K.RANGE_START).cast("timestamp_ntz")
    return n.select("n_nationkey", add_minutes(t0, F.col("n_nationkey"), 60).alias("slot_ts"))


SQL_TIME_TEXT = ("CASE WHEN event_type = 'error' THEN strftime(ts, '%H:%M') || ':75' "
                 "ELSE concat_ws(':', hour(ts), minute(ts), second(ts)) END")


@query("validate_time", f"""
SELECT event_id, {SQL_TIME_TEXT} AS time_text,
       CASE WHEN regexp_full_match({SQL_TIME_TEXT}, '([01]?\\d|2[0-3]):[0-5]?\\d:[0-5]?\\d')
            THEN regexp_replace(regexp_replace({SQL_TIME_TEXT}, '(^|:)(\\d)(:|$)', '\\10\\2\\3', 'g'), '(^|:)(\\d)(:|$)', '\\10\\2\\3', 'g') END AS valid_time
FROM events""")
def q_validate_time(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    txt = F.when(F.col("event_type") == "error", F.concat(F.date_format("ts", "HH:mm"), F.lit(":75"))) \
        .otherwise(F.concat_ws(":", F.hour("ts"), F.minute("ts"), F.second("ts")))
    return e.select("event_id", txt.alias("time_text"), valid_hms(txt).alias("valid_time"))


@query("safe_percentage", """
SELECT l_orderkey,
       count(*) FILTER (WHERE l_returnflag = 'R') / nullif(count(*) FILTER (WHERE l_returnflag = 'A'), 0) * 100 AS pct
FROM lineitem GROUP BY 1""")
def q_safe_percentage(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    g = li.groupBy("l_orderkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("_r"),
                                     F.count_if(F.col("l_returnflag") == "A").alias("_a"))
    return g.select("l_orderkey", safe_percentage("_r", "_a").alias("pct"))


@query("fill_open_end", """
SELECT event_id, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id),
                          TIMESTAMP '9999-12-31 23:59:59') AS date_to
FROM events""")
def q_fill_open_end(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts")
    s = sequence_per_key(e, ["user_id"], ["ts", "event_id"], next_cols=["ts"])
    return s.select("event_id", F.coalesce(F.col("next_ts"), open_end()).alias("date_to"))


@query("case_when", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'fast'
                        WHEN o_orderpriority = '3-MEDIUM' THEN 'normal' ELSE 'slow' END AS speed
FROM orders""")
def q_case_when(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    p = F.col("o_orderpriority")
    return o.select("o_orderkey", F.when(p.isin("1-URGENT", "2-HIGH"), "fast")
                    .when(p == "3-MEDIUM", "normal").otherwise("slow").alias("speed"))


@query("array_pick", f"""
SELECT n_nationkey, (['Center', 'East', 'South', 'North', 'West'])[n_nationkey % 5 + 1] AS region FROM nation""")
def q_array_pick(spark, sf_dir):
    n = Tables(spark, sf_dir).nation
    arr = F.array(*[F.lit(r) for r in K.REGIONS])
    return n.select("n_nationkey", F.element_at(arr, (F.col("n_nationkey") % 5 + 1).cast("int")).alias("region"))


@query("hash_pick", f"""
SELECT s_suppkey, {pick('s_name', 'region|', K.REGIONS)} AS region,
       {between('s_suppkey', 'year|', *K.BIRTH_YEARS)} AS birth_year
FROM supplier""")
def q_hash_pick(spark, sf_dir):
    s = Tables(spark, sf_dir).supplier
    return s.select("s_suppkey", hash_pick("s_name", "region|", K.REGIONS).alias("region"),
                    hash_between("s_suppkey", "year|", *K.BIRTH_YEARS).alias("birth_year"))
