"""Warehouse queries: dimensions, keys, SCD2, fact, normalisation, generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.plans import constants as K
from starloom.plans import dims, facts
from starloom.plans.feeds import (
    FEED_MEASURES, LINEITEM_ORDER, Tables, country_source, election_source, party_feed_names,
    party_source, wide_feed,
)
from starloom.plans.registry import query
from starloom.plans.sqlfrag import between, initcap_word, pick, values

# ------------------------------------------------------------------ SQL CTEs
LI_COLS = ", ".join(LINEITEM_ORDER)
LI_ORDER_DESC = ", ".join(f"{c} DESC" for c in LINEITEM_ORDER)

SQL_DIM_COUNTRY = f"""
dim_country AS (
  SELECT row_number() OVER (ORDER BY region, country_name) AS country_tk, country_id, country_name, region
  FROM (
    SELECT country_id, country_name,
           coalesce(region, {pick('country_name', 'region|', K.REGIONS)}) AS region
    FROM (
      SELECT CAST(n.n_nationkey AS BIGINT) AS country_id,
             {initcap_word('trim(n.n_name)')} AS country_name,
             {initcap_word('trim(r.r_name)')} AS region
      FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey 
    ) s
  ) f
)"""

SQL_DIM_DATE = """
dim_date AS (
  SELECT row_number() OVER (ORDER BY full_date) AS date_tk, full_date,
         year(full_date) AS year, month(full_date) AS month, day(full_date) AS day,
         dayname(full_date) AS weekday
  FROM (SELECT CAST(o_orderdate AS DATE) AS full_date FROM orders
        UNION SELECT CAST(ts AS DATE) FROM events) d
)"""

SQL_DIM_PARTY = f"""
orientation AS (SELECT * FROM {values(K.PARTY_ORIENTATION, ['party_id', 'orientation'])}),
party_db AS (
  SELECT min(CAST(split_part(p_brand, '#', 2) AS INTEGER)) AS party_id, trim(p_brand) AS name FROM part
  WHERE p_brand IS NOT NULL GROUP BY trim(p_brand)
),
party_csv AS (
  SELECT CAST((SELECT greatest(1000, max(party_id)) FROM party_db) + row_number() OVER (ORDER BY name) AS INTEGER) AS party_id,
         name, 'unknown' AS orientation
  FROM (SELECT DISTINCT trim(p_type) AS name FROM part WHERE p_type IS NOT NULL) x
  WHERE name NOT IN (SELECT name FROM party_db)
),
party_all AS (
  SELECT d.party_id, d.name, o.orientation FROM party_db d LEFT JOIN orientation o ON d.party_id = o.party_id
  UNION ALL SELECT party_id, name, orientation FROM party_csv
),
dim_party AS (
  SELECT row_number() OVER (ORDER BY party_id, name) AS party_tk, party_id, name, orientation
  FROM party_all
)"""

SQL_DIM_ELECTION = """
dim_election AS (
  SELECT row_number() OVER (ORDER BY e.election_id, e.election_date, e.country_id) AS election_tk, e.election_id, d.date_tk, c.country_tk
  FROM (
    SELECT DISTINCT CAST(o.o_orderkey AS BIGINT) AS election_id, CAST(o.o_orderdate AS DATE) AS election_date,
           CAST(cu.c_nationkey AS BIGINT) AS country_id
    FROM orders o JOIN customer cu ON o.o_custkey = cu.c_custkey
    WHERE o.o_orderkey IS NOT NULL AND o.o_orderdate IS NOT NULL AND cu.c_nationkey IS NOT NULL
  ) e
  LEFT JOIN dim_date d ON e.election_date = d.full_date
  LEFT JOIN dim_country c ON e.country_id = c.country_id
)"""

SQL_FEED = f"""
feed AS (
  SELECT l.l_orderkey AS election_id, o.o_orderdate AS time, n.n_name AS territory_name, p.p_brand AS party,
         l.l_linenumber + p.p_size AS total_mandates, p.p_size AS available_mandates,
         p.p_size * 2 AS num_parishes, p.p_size AS num_parishes_approved,
         CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END / nullif(CAST(l.l_quantity AS BIGINT), 0) * 100 AS blank_votes_percentage,
         CASE WHEN l.l_returnflag = 'A' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END / nullif(CAST(l.l_quantity AS BIGINT), 0) * 100 AS null_votes_percentage,
         CAST(l.l_quantity AS BIGINT) / nullif(CAST(l.l_quantity AS BIGINT) * 2, 0) * 100 AS voters_percentage,
         l.l_linenumber AS mandates, CAST(l.l_quantity AS BIGINT) AS votes,
         l.l_discount * 100 AS percentage, l.l_tax * 100 AS valid_votes_percentage,
         l.l_linenumber AS final_mandates,
         CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END AS blank_votes,
         CASE WHEN l.l_returnflag = 'A' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END AS null_votes,
         CAST(l.l_quantity AS BIGINT) * 2 AS subscribed_voters, CAST(l.l_quantity AS BIGINT) AS total_voters,
         CASE WHEN l.l_linestatus = 'O' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END AS pre_blank_votes,
         CAST(0 AS BIGINT) AS pre_null_votes,
         CAST(l.l_quantity AS BIGINT) / nullif(CAST(l.l_quantity AS BIGINT) * 2, 0) * 100 AS historical_turnout,
         {', '.join('l.' + c for c in LINEITEM_ORDER)}
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
       LEFT JOIN customer c ON o.o_custkey = c.c_custkey
       LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
       LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

MEASURE_SQL = ", ".join(f"f.{m}" for m in FEED_MEASURES)


# ------------------------------------------------------------------ builders
def build_dim_country(t: Tables):
    return dims.dim_country(country_source(t))


def build_dim_date(t: Tables):
    return dims.dim_date([t.orders, t.events], preference=("time", "year", "o_orderdate", "ts"))


def build_dim_party(t: Tables):
    return dims.dim_party(party_source(t), party_feed_names(t))


def build_dim_election(t: Tables, dim_date_df=None, dim_country_df=None):
    return dims.dim_election(election_source(t),
                             dim_date_df if dim_date_df is not None else build_dim_date(t),
                             dim_country_df if dim_country_df is not None else build_dim_country(t))


def build_fact(t: Tables, dim_country_df=None, dim_date_df=None, dim_party_df=None, dim_election_df=None, dim_history_df=None):
    # a dimension's dense key has stored it: each is built once and read again
    dc = dim_country_df if dim_country_df is not None else build_dim_country(t)
    dd = dim_date_df if dim_date_df is not None else build_dim_date(t)
    dp = dim_party_df if dim_party_df is not None else build_dim_party(t)
    de = dim_election_df if dim_election_df is not None else build_dim_election(t, dd, dc)
    dh = dim_history_df if dim_history_df is not None else build_dim_history(t)
    return facts.fact_election_result(wide_feed(t, "fact_id", "is_last"), de, dc, dd, dp, dh, FEED_MEASURES, "is_last")


# ------------------------------------------------------------------ D1-D5, D9
@query("dim_country", f"WITH {SQL_DIM_COUNTRY} SELECT * FROM dim_country")
def q_dim_country(spark, sf_dir):
    return build_dim_country(Tables(spark, sf_dir))


@query("dim_date", f"WITH {SQL_DIM_DATE} SELECT * FROM dim_date")
def q_dim_date(spark, sf_dir):
    return build_dim_date(Tables(spark, sf_dir))


@query("dim_party", f"WITH {SQL_DIM_PARTY} SELECT * FROM dim_party")
def q_dim_party(spark, sf_dir):
    return build_dim_party(Tables(spark, sf_dir))


@query("dim_election", f"WITH {SQL_DIM_COUNTRY}, {SQL_DIM_DATE}, {SQL_DIM_ELECTION} SELECT * FROM dim_election")
def q_dim_election(spark, sf_dir):
    return build_dim_election(Tables(spark, sf_dir))


SQL_FACT = f"""
fact AS (
  SELECT f.fact_id, e.election_tk, dc.country_tk, dd.date_tk, dp.party_tk, eh.election_history_tk, {MEASURE_SQL},
         CASE WHEN f.fact_id = max(f.fact_id) OVER (PARTITION BY f.election_id) THEN 'official' ELSE 'preliminary' END AS result_type
  FROM (SELECT *, row_number() OVER (ORDER BY {LI_COLS}) AS fact_id FROM feed) f
  LEFT JOIN (SELECT election_id, min(election_tk) AS election_tk FROM dim_election GROUP BY 1) e ON f.election_id = e.election_id
  LEFT JOIN (SELECT election_id, min(election_history_tk) AS election_history_tk FROM dim_election_history GROUP BY 1) eh
         ON f.election_id = eh.election_id
  LEFT JOIN dim_country dc ON {initcap_word('trim(f.territory_name)')} = dc.country_name
  LEFT JOIN dim_date dd ON CAST(f.time AS DATE) = dd.full_date
  LEFT JOIN dim_party dp ON f.party = dp.name
)"""



# ------------------------------------------------------------------ more SQL CTEs
SQL_DIM_PERSON = """
dim_person AS (
  SELECT row_number() OVER (ORDER BY p.person_id, p.first_name, p.last_name) AS person_tk,
         p.person_id, p.first_name, p.last_name, p.birth_year, p.title, CAST(c.country_tk AS BIGINT) AS party_id
  FROM (SELECT CAST(s_suppkey AS INTEGER) AS person_id, trim(split_part(s_name, '#', 1)) AS first_name,
               trim(split_part(s_name, '#', 2)) AS last_name, CAST(1950 + s_nationkey AS INTEGER) AS birth_year,
               CASE WHEN s_acctbal >= 0 THEN 'Dr.' END AS title, CAST(s_nationkey AS INTEGER) AS party_id
        FROM supplier) p
  LEFT JOIN dim_country c ON p.party_id = c.country_id
)"""

SQL_HISTORY_SRC = """
hsrc AS (
  SELECT CAST(l_orderkey AS BIGINT) AS election_id,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS INTEGER) AS pre_blank_votes,
         CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS INTEGER) AS pre_null_votes,
         count(*) FILTER (WHERE l_linestatus = 'F') / nullif(count(*), 0) * 100 AS historical_turnout
  FROM lineitem GROUP BY 1
)"""

SQL_DIM_HISTORY = """
dim_election_history AS (
  SELECT election_history_tk, election_id, pre_blank_votes, pre_null_votes, historical_turnout,
         TIMESTAMP '2020-01-01 00:00:00' + to_minutes((election_history_tk - 1) * 60) AS date_from,
         CASE WHEN election_history_tk = count(*) OVER () THEN TIMESTAMP '9999-12-31 23:59:59'
              ELSE TIMESTAMP '2020-01-01 00:00:00' + to_minutes(election_history_tk * 60) END AS date_to
  FROM (SELECT row_number() OVER (ORDER BY election_id, pre_blank_votes, pre_null_votes, historical_turnout)
               AS election_history_tk, * FROM (SELECT DISTINCT * FROM hsrc) d) k
)"""

SQL_STAR = ", ".join([SQL_DIM_COUNTRY, SQL_DIM_DATE, SQL_DIM_PARTY, SQL_DIM_PERSON, SQL_DIM_ELECTION, SQL_HISTORY_SRC, SQL_DIM_HISTORY, SQL_FEED, SQL_FACT])


@query("fact_table", f"WITH {SQL_STAR} SELECT * FROM fact")
def q_fact_table(spark, sf_dir):
    return build_fact(Tables(spark, sf_dir))


SQL_SCD2 = """
SELECT user_id, event_id, event_type, value, row_number() OVER w AS version, ts AS date_from,
       coalesce(lead(ts) OVER w, TIMESTAMP '9999-12-31 23:59:59') AS date_to, lead(ts) OVER w IS NULL AS is_current
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""

SQL_NUMBERED_FEED = f"""
nfeed AS (SELECT row_number() OVER (ORDER BY {LI_COLS}) AS election_id, * EXCLUDE (election_id) FROM feed)"""

SQL_NORM_COUNTRY = f"""
ncountry AS (SELECT row_number() OVER (ORDER BY name) AS id, name
             FROM (SELECT DISTINCT {initcap_word('trim(territory_name)')} AS name FROM feed) x)"""
SQL_NORM_PARTY = """
nparty AS (SELECT row_number() OVER (ORDER BY name) AS id, name FROM (SELECT DISTINCT trim(party) AS name FROM feed) x)"""

ELECTION_MEASURES = ["blank_votes", "null_votes", "subscribed_voters", "total_voters"]
RESULT_MEASURES = ["mandates", "percentage", "valid_votes_percentage", "votes", "final_mandates"]


def build_history_source(t: Tables):
    from starloom.functions import safe_percentage
    g = t.lineitem.groupBy("l_orderkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("_r"), F.count_if(F.col("l_returnflag") == "A").alias("_a"),
        F.count_if(F.col("l_linestatus") == "F").alias("_f"), F.count(F.lit(1)).alias("_n"))
    return g.select(F.col("l_orderkey").alias("election_id"), F.col("_r").alias("pre_blank_votes"),
                    F.col("_a").alias("pre_null_votes"), safe_percentage("_f", "_n").alias("historical_turnout"))


def build_dim_person(t: Tables, dim_country_df=None):
    from starloom.plans.feeds import person_source
    dc = dim_country_df if dim_country_df is not None else build_dim_country(t)
    return dims.dim_person(person_source(t), dc, "country_id", "country_tk")


def build_dim_history(t: Tables):
    from starloom.plans.history import dim_election_history
    return dim_election_history(build_history_source(t))


def _events(t: Tables):
    return t.events.select("user_id", "event_id", "ts", "event_type", "value")


SCD2_COLS = ["user_id", "event_id", "event_type", "value", "version", "date_from", "date_to", "is_current"]


# ------------------------------------------------------------------ W1-W8
@query("surrogate_key", "SELECT row_number() OVER (ORDER BY n_name) AS nation_tk, n_nationkey, n_name FROM nation")
def q_surrogate_key(spark, sf_dir):
    from starloom.operators.keys import dense_key
    n = Tables(spark, sf_dir).nation.select("n_nationkey", "n_name")
    return dense_key(n, ["n_name"], "nation_tk")


@query("surrogate_key_large", f"SELECT row_number() OVER (ORDER BY {LI_COLS}) AS line_tk, * FROM lineitem")
def q_surrogate_key_large(spark, sf_dir):
    from starloom.operators.keys import dense_key
    return dense_key(Tables(spark, sf_dir).lineitem, LINEITEM_ORDER, "line_tk")


@query("first_per_key", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders
  WHERE o_custkey IS NOT NULL) x WHERE rn = 1
UNION ALL SELECT * FROM orders WHERE o_custkey IS NULL""")
def q_first_per_key(spark, sf_dir):
    from starloom.operators.dedupe import first_per_key
    return first_per_key(Tables(spark, sf_dir).orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("lead_interval", """
SELECT event_id, user_id, ts AS date_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS date_to
FROM events""")
def q_lead_interval(spark, sf_dir):
    from starloom.operators.sequence import sequence_per_key
    e = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts")
    s = sequence_per_key(e, ["user_id"], ["ts", "event_id"], next_cols=["ts"])
    return s.select("event_id", "user_id", F.col("ts").alias("date_from"), F.col("next_ts").alias("date_to"))


@query("offset_key", """
SELECT row_number() OVER (ORDER BY p_brand) + 1000 AS party_id, p_brand AS name FROM (SELECT DISTINCT p_brand FROM part) x""")
def q_offset_key(spark, sf_dir):
    from starloom.operators.keys import dense_key
    b = Tables(spark, sf_dir).part.select(F.col("p_brand").alias("name")).distinct()
    return dense_key(b, ["name"], "party_id", offset=1000)


@query("continue_key", """
WITH e AS (SELECT row_number() OVER (ORDER BY name) AS id, name
           FROM (SELECT DISTINCT p_brand || ' ' || p_name AS name FROM part WHERE p_partkey % 3 = 0) x
           WHERE name IS NOT NULL),
n AS (SELECT DISTINCT p_brand || ' ' || p_name AS name FROM part WHERE p_partkey % 3 <> 0)
SELECT (SELECT coalesce(max(id), 0) FROM e) + row_number() OVER (ORDER BY name) AS id, name
FROM n WHERE name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM e WHERE e.name = n.name)""")
def q_continue_key(spark, sf_dir):
    from starloom.operators.keys import continue_key, dense_key
    from starloom.operators.lookup import anti_new
    p = Tables(spark, sf_dir).part.select("p_partkey", F.concat("p_brand", F.lit(" "), "p_name").alias("name"))
    p = p.where(F.col("name").isNotNull())
    existing = dense_key(p.where(F.col("p_partkey") % 3 == 0).select("name").distinct(), ["name"], "id")
    fresh = p.where(F.col("p_partkey") % 3 != 0).select("name").distinct()
    return continue_key(anti_new(fresh, existing, ["name"]), existing, "id", ["name"], "id").select("id", "name")


@query("spread_timestamps", """
SELECT o_orderkey,
       CAST(o_orderdate AS DATE) + INTERVAL 18 HOUR
       + to_microseconds(CAST(18000000000 * (rn - 1) // greatest(n - 1, 1) AS BIGINT)) AS slot_ts
FROM (SELECT o_orderkey, o_orderdate,
             row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey) AS rn,
             count(*) OVER (PARTITION BY CAST(o_orderdate AS DATE)) AS n
      FROM orders) x""")
def q_spread_timestamps(spark, sf_dir):
    from starloom.plans.generate import spread_in_group
    o = Tables(spark, sf_dir).orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return spread_in_group(o, ["order_date"], ["o_orderkey"], "order_date").select("o_orderkey", "slot_ts")


@query("latest_version", """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
  WHERE user_id IS NOT NULL) x WHERE rn = 1""")
def q_latest_version(spark, sf_dir):
    from starloom.operators.dedupe import last_per_key
    return last_per_key(_events(Tables(spark, sf_dir)), ["user_id"], ["ts", "event_id"])


@query("result_type", """
SELECT event_id, user_id,
       CASE WHEN lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL THEN 'official' ELSE 'preliminary' END AS result_type
FROM events""")
def q_result_type(spark, sf_dir):
    from starloom.operators.sequence import flag_last
    e = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts")
    s = flag_last(e, ["user_id"], ["ts", "event_id"], "_is_last")
    return s.select("event_id", "user_id", F.when(F.col("_is_last"), K.RESULT_OFFICIAL)
                    .otherwise(K.RESULT_PRELIMINARY).alias("result_type"))


# ------------------------------------------------------------------ D4, D6-D8
@query("dim_person", f"WITH {SQL_DIM_COUNTRY}, {SQL_DIM_PERSON} SELECT * FROM dim_person")
def q_dim_person(spark, sf_dir):
    return build_dim_person(Tables(spark, sf_dir))


@query("date_ranges", """
SELECT o_orderkey, TIMESTAMP '2020-01-01 00:00:00' + to_minutes((rn - 1) * 60) AS date_from,
       CASE WHEN rn = n THEN TIMESTAMP '9999-12-31 23:59:59' ELSE TIMESTAMP '2020-01-01 00:00:00' + to_minutes(rn * 60) END AS date_to
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders) x""")
def q_date_ranges(spark, sf_dir):
    from starloom.plans.history import date_ranges
    o = Tables(spark, sf_dir).orders.select("o_orderkey")
    return date_ranges(o, ["o_orderkey"])


@query("dim_election_history", f"WITH {SQL_HISTORY_SRC}, {SQL_DIM_HISTORY} SELECT * FROM dim_election_history")
def q_dim_election_history(spark, sf_dir):
    return build_dim_history(Tables(spark, sf_dir))


@query("scd2_history", SQL_SCD2)
def q_scd2_history(spark, sf_dir):
    from starloom.operators.scd2 import build_history
    h = build_history(_events(Tables(spark, sf_dir)), "user_id", "ts", ["event_id"])
    return h.select(*SCD2_COLS)


@query("scd2_merge", SQL_SCD2)
def q_scd2_merge(spark, sf_dir):
    from starloom.operators.scd2 import build_history, merge_history
    e = _events(Tables(spark, sf_dir))
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    old = build_history(e.where(F.col("ts") < cut), "user_id", "ts", ["event_id"])
    new = merge_history(old, e.where(F.col("ts") >= cut), "user_id", "ts", ["event_id"])
    return new.select(*SCD2_COLS)


SQL_TRACKED = """
SELECT user_id, event_id, event_type, value, row_number() OVER w AS version, hour AS date_from,
       coalesce(lead(hour) OVER w, TIMESTAMP '9999-12-31 23:59:59') AS date_to, lead(event_id) OVER w IS NULL AS is_current
FROM (SELECT * FROM (SELECT user_id, event_id, event_type, value, date_trunc('hour', ts) AS hour,
                            lag(event_type) OVER (PARTITION BY user_id ORDER BY date_trunc('hour', ts), event_id) AS before,
                            row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('hour', ts), event_id) AS rn FROM events) x
      WHERE rn = 1 OR before IS DISTINCT FROM event_type) y
WINDOW w AS (PARTITION BY user_id ORDER BY hour, event_id)"""


@query("scd2_track", SQL_TRACKED)
def q_scd2_track(spark, sf_dir):
    """History of each user's event type: repeated values are no versions,
    and times cut to the hour make many rows tie."""
    from starloom.operators.scd2 import build_history
    e = _events(Tables(spark, sf_dir)).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return build_history(e, "user_id", "ts", ["event_id"], track=["event_type"]).select(*SCD2_COLS)


@query("scd2_late", SQL_SCD2)
def q_scd2_late(spark, sf_dir):
    """Three batches out of order: the first third of the month comes last."""
    from starloom.operators.scd2 import build_history, merge_history
    e = _events(Tables(spark, sf_dir))
    third = F.dayofmonth("ts") % 3
    history = build_history(e.where(third == 1), "user_id", "ts", ["event_id"])
    for k in (2, 0):
        history = merge_history(history, e.where(third == k), "user_id", "ts", ["event_id"])
    return history.select(*SCD2_COLS)


@query("scd2_load_time", """
WITH o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY load, date_from, ts, event_id) AS version,
                  lead(date_from) OVER (PARTITION BY user_id ORDER BY load, date_from, ts, event_id) AS upto
           FROM (SELECT user_id, event_id, event_type, value, ts, CASE WHEN event_id % 2 = 0 THEN ts ELSE TIMESTAMP '2030-01-01 00:00:00' END AS date_from,
                        CAST(event_id % 2 AS INTEGER) AS load FROM events) x)
SELECT user_id, event_id, event_type, value, version, date_from, coalesce(upto, TIMESTAMP '9999-12-31 23:59:59') AS date_to,
       upto IS NULL AS is_current FROM o""")
def q_scd2_load_time(spark, sf_dir):
    """Load-time stamping: the second batch opens at its load time and closes
    what was current then."""
    from starloom.operators.scd2 import build_history, merge_history
    e = _events(Tables(spark, sf_dir))
    old = build_history(e.where(F.col("event_id") % 2 == 0), "user_id", "ts", ["event_id"])
    new = merge_history(old, e.where(F.col("event_id") % 2 != 0), "user_id", "ts", ["event_id"], load_ts="2030-01-01 00:00:00")
    return new.select(*SCD2_COLS)


@query("dim_election_two_sources", f"WITH {SQL_DIM_COUNTRY}, {SQL_DIM_DATE}, {SQL_DIM_ELECTION} SELECT * FROM dim_election")
def q_dim_election_two_sources(spark, sf_dir):
    """The election dimension from two overlapping slices of the orders."""
    t = Tables(spark, sf_dir)
    e = election_source(t)
    return dims.dim_election(e.where(F.col("election_id") % 3 != 0), build_dim_date(t), build_dim_country(t),
                             csv=e.where(F.col("election_id") % 3 != 1))


# ------------------------------------------------------------------ D10 normalise
SQL_CLEAN_TERRITORY = initcap_word('trim(f.territory_name)')


def numbered_feed(t: Tables):
    """The feed with one election per row, numbered in line-item order."""
    f = wide_feed(t, "_line")
    return f.withColumn("election_id", F.col("_line")).drop("_line")


@query("normalize_country", f"WITH {SQL_FEED}, {SQL_NORM_COUNTRY} SELECT * FROM ncountry")
def q_normalize_country(spark, sf_dir):
    from starloom.plans.normalize import countries
    return countries(wide_feed(Tables(spark, sf_dir)))


@query("normalize_party", f"WITH {SQL_FEED}, {SQL_NORM_PARTY} SELECT * FROM nparty")
def q_normalize_party(spark, sf_dir):
    from starloom.plans.normalize import parties
    return parties(wide_feed(Tables(spark, sf_dir)))


@query("normalize_election", f"""
WITH {SQL_FEED}, {SQL_NUMBERED_FEED}, {SQL_NORM_COUNTRY}
SELECT f.election_id AS id, f.time AS year, {', '.join('f.' + m for m in ELECTION_MEASURES)}, c.id AS country_id
FROM nfeed f LEFT JOIN ncountry c ON {initcap_word('trim(f.territory_name)')} = c.name""")
def q_normalize_election(spark, sf_dir):
    from starloom.plans.normalize import countries, elections
    numbered = numbered_feed(Tables(spark, sf_dir))
    return elections(numbered, countries(numbered), ELECTION_MEASURES)


@query("normalize_result", f"""
WITH {SQL_FEED}, {SQL_NUMBERED_FEED}, {SQL_NORM_PARTY}
SELECT f.election_id AS id, f.election_id, p.id AS party_id, {', '.join('f.' + m for m in RESULT_MEASURES)}
FROM nfeed f LEFT JOIN nparty p ON trim(f.party) = p.name""")
def q_normalize_result(spark, sf_dir):
    from starloom.plans.normalize import parties, results
    numbered = numbered_feed(Tables(spark, sf_dir))
    return results(numbered, parties(numbered), RESULT_MEASURES)


@query("normalize_history", f"""
WITH {SQL_FEED}, {SQL_NUMBERED_FEED}
SELECT election_id AS id, election_id, pre_blank_votes, pre_null_votes, historical_turnout FROM nfeed""")
def q_normalize_history(spark, sf_dir):
    from starloom.plans.normalize import histories
    return histories(numbered_feed(Tables(spark, sf_dir)))


# ------------------------------------------------------------------ D11-D16
SQL_INCREMENTAL = """
WITH p AS (SELECT p_partkey, p_brand || ' ' || p_name AS name FROM part),
e AS (SELECT row_number() OVER (ORDER BY name) AS id, name
      FROM (SELECT DISTINCT name FROM p WHERE p_partkey % 3 = 0 AND name IS NOT NULL) x),
n AS (SELECT DISTINCT name FROM p WHERE name IS NOT NULL AND name NOT IN (SELECT name FROM e))
SELECT id, name FROM e
UNION ALL
SELECT (SELECT coalesce(max(id), 0) FROM e) + row_number() OVER (ORDER BY name) AS id, name FROM n"""


@query("incremental_dim_load", SQL_INCREMENTAL)
def q_incremental_dim_load(spark, sf_dir):
    from starloom.plans.generate import incremental_load
    p = Tables(spark, sf_dir).part.select("p_partkey", F.concat("p_brand", F.lit(" "), "p_name").alias("name"))
    first = incremental_load(None, p.where(F.col("p_partkey") % 3 == 0), "name")
    return incremental_load(first, p, "name")


@query("impute_from_pool", f"""
SELECT n.n_nationkey, n.n_name, coalesce(CASE WHEN n.n_nationkey % 3 <> 0 THEN r.r_name END, {pick('n.n_name', 'region|', K.REGIONS)}) AS region
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_impute_from_pool(spark, sf_dir):
    from starloom.plans.feeds import nation_regions
    from starloom.plans.generate import impute_from_pool
    j = nation_regions(Tables(spark, sf_dir)).select("n_nationkey", "n_name", F.col("r_name").alias("region"))
    return impute_from_pool(j, "region", "n_name", K.REGIONS, "region|")


SQL_SLOTS = """
slots AS (
  SELECT full_date, unnest(generate_series(full_date + INTERVAL 18 HOUR, full_date + INTERVAL 22 HOUR, INTERVAL 1 HOUR)) AS slot_ts
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date FROM orders) d)"""


def _order_dates(t: Tables):
    return t.orders.select(F.col("o_orderdate").cast("date").alias("full_date")).distinct()


@query("hour_slots", f"WITH {SQL_SLOTS} SELECT full_date, CAST(slot_ts AS TIMESTAMP) AS slot_ts FROM slots")
def q_hour_slots(spark, sf_dir):
    from starloom.plans.generate import hour_slots
    return hour_slots(_order_dates(Tables(spark, sf_dir)), "full_date")


@query("last_slot", f"WITH {SQL_SLOTS} SELECT full_date, CAST(max(slot_ts) AS TIMESTAMP) AS last_slot_ts FROM slots GROUP BY 1")
def q_last_slot(spark, sf_dir):
    from starloom.plans.generate import hour_slots, last_slot
    return last_slot(hour_slots(_order_dates(Tables(spark, sf_dir)), "full_date"))


@query("generate_members", f"""
SELECT row_number() OVER (ORDER BY s_suppkey) AS person_id,
       CASE WHEN g = 'M' THEN {pick('s_suppkey', 'first|', K.MALE_NAMES)} ELSE {pick('s_suppkey', 'first|', K.FEMALE_NAMES)} END AS first_name,
       {pick('s_suppkey', 'last|', K.LAST_NAMES)} AS last_name,
       {between('s_suppkey', 'year|', *K.BIRTH_YEARS)} AS birth_year,
       CASE WHEN g = 'M' THEN {pick('s_suppkey', 'title|', K.TITLES_MALE)} ELSE {pick('s_suppkey', 'title|', K.TITLES_FEMALE)} END AS title,
       g AS gender, s_suppkey AS party_id
FROM (SELECT s_suppkey, {pick('s_suppkey', 'gender|', ['M', 'F'])} AS g FROM supplier) s""")
def q_generate_members(spark, sf_dir):
    from starloom.plans.generate import generate_members
    return generate_members(Tables(spark, sf_dir).supplier.select("s_suppkey"), "s_suppkey", ["s_suppkey"])


@query("election_grid", """
SELECT row_number() OVER (ORDER BY m.month, n.n_nationkey) AS election_id, m.month, CAST(n.n_nationkey AS BIGINT) AS country_id
FROM nation n, (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders) m""")
def q_election_grid(spark, sf_dir):
    from starloom.operators.keys import dense_key
    from starloom.plans.generate import month_grid
    t = Tables(spark, sf_dir)
    months = t.orders.select(F.trunc("o_orderdate", "month").alias("month"))
    grid = month_grid(months, "month", t.nation.select(F.col("n_nationkey").cast("bigint").alias("country_id")),
                      "country_id")
    return dense_key(grid, ["month", "country_id"], "election_id").select("election_id", "month", "country_id")


@query("hierarchy_paths", """
SELECT s.s_suppkey, s.s_name, n.n_name, r.r_name
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_hierarchy_paths(spark, sf_dir):
    t = Tables(spark, sf_dir)
    geo = t.nation.join(t.region, t.nation["n_regionkey"] == t.region["r_regionkey"], "left") \
        .select("n_nationkey", "n_name", "r_name")
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    return s.join(geo, s["s_nationkey"] == geo["n_nationkey"], "left") \
        .select("s_suppkey", "s_name", "n_name", "r_name")


@query("scd2_stream", SQL_SCD2)
def q_scd2_stream(spark, sf_dir):
    """The events consumed as a stream of several files, one per micro-batch,
    whose times overlap; each is merged into the bucketed SCD2 history
    (foreachBatch)."""
    from starloom.operators.history_store import HistorySink, HistoryStore
    from starloom.session import scratch_path
    from starloom.streaming.loaders import run_feed
    events = Tables(spark, sf_dir).events
    source = scratch_path(spark, "scd2-source")
    events.repartition(3).write.parquet(source)
    store = HistoryStore(spark, scratch_path(spark, "scd2-stream"), events.schema, "user_id", "ts", ["event_id"], buckets=8)
    run_feed(spark, source, events.schema, HistorySink(store), "scd2", max_files_per_trigger=1)
    return store.read().select(*SCD2_COLS)


@query("join_on_calendar_date", f"""
WITH {SQL_DIM_DATE}
SELECT e.event_id, e.ts, d.date_tk, d.full_date
FROM events e LEFT JOIN dim_date d ON CAST(e.ts AS DATE) = d.full_date""")
def q_join_on_calendar_date(spark, sf_dir):
    from starloom.operators.lookup import join_dim
    t = Tables(spark, sf_dir)
    e = t.events.select("event_id", "ts").withColumn("full_date", F.col("ts").cast("date"))
    return join_dim(e, build_dim_date(t).select("full_date", "date_tk"), "full_date", "left") \
        .select("event_id", "ts", "date_tk", "full_date")


def _name_key(c):
    """Match key for territory names: blanks stripped, accents folded and
    case ignored — the same on both sides of the look-up."""
    from starloom.functions import fold_accents, py_strip
    return F.lower(fold_accents(py_strip(c)))


@query("election_feed_load", f"""
WITH {SQL_DIM_COUNTRY}, {SQL_DIM_DATE}, {SQL_DIM_ELECTION},
f AS (
  SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS d, n.n_name AS territory
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
m AS (
  SELECT f.o_orderkey, f.d, dd.date_tk, dc.country_id
  FROM f LEFT JOIN dim_date dd ON f.d = dd.full_date
       LEFT JOIN dim_country dc
         ON lower(strip_accents(regexp_replace(f.territory, '^\\s+|\\s+$', '', 'g')))
          = lower(strip_accents(regexp_replace(dc.country_name, '^\\s+|\\s+$', '', 'g')))
  WHERE dd.date_tk IS NOT NULL AND dc.country_id IS NOT NULL),
s AS (
  SELECT *, row_number() OVER (PARTITION BY date_tk, country_id ORDER BY o_orderkey) AS rn,
         count(*) OVER (PARTITION BY date_tk, country_id) AS n
  FROM m)
SELECT (SELECT coalesce(max(election_tk), 0) FROM dim_election) + row_number() OVER (ORDER BY o_orderkey) AS election_tk,
       o_orderkey AS source_id, date_tk, country_id,
       d + INTERVAL 18 HOUR + to_microseconds(CAST(18000000000 * (rn - 1) // greatest(n - 1, 1) AS BIGINT)) AS slot_ts
FROM s""")
def q_election_feed_load(spark, sf_dir):
    """The feed-side election load: map each feed row's date and territory
    to the calendar and country keys (names folded on both sides), drop
    unmapped rows, spread the rows of each (date, country) over election
    night, and number them after the election dimension's current maximum."""
    from starloom.operators.keys import continue_key
    from starloom.plans.generate import spread_in_group
    from starloom.operators.lookup import join_dim
    t = Tables(spark, sf_dir)
    dd, dc = build_dim_date(t), build_dim_country(t)
    n = t.nation.select("n_nationkey", "n_name")
    c = t.customer.select("c_custkey", "c_nationkey")
    feed = (t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
            .join(c, F.col("o_custkey") == c["c_custkey"])
            .join(n, F.col("c_nationkey") == n["n_nationkey"])
            .select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), F.col("n_name").alias("territory")))
    feed = feed.withColumn("_nk", _name_key("territory"))
    date_map = dd.select(F.col("full_date").alias("d"), "date_tk")
    country_map = dc.select(_name_key("country_name").alias("_nk"), "country_id")
    m = join_dim(feed, date_map, "d", "left")
    m = join_dim(m, country_map, "_nk", "left")
    m = m.dropna(subset=["date_tk", "country_id"]).select("o_orderkey", "d", "date_tk", "country_id")
    spread = spread_in_group(m, ["date_tk", "country_id"], ["o_orderkey"], "d")
    keyed = continue_key(spread, build_dim_election(t, dd, dc), "election_tk", ["o_orderkey"], "election_tk")
    return keyed.select("election_tk", F.col("o_orderkey").alias("source_id"), "date_tk", "country_id", "slot_ts")


@query("member_category_counts", f"""
WITH g AS (SELECT s_suppkey, {pick('s_suppkey', 'gender|', ['M', 'F'])} AS gender FROM supplier)
SELECT gender,
       CASE WHEN gender = 'M' THEN {pick('s_suppkey', 'title|', K.TITLES_MALE)}
            ELSE {pick('s_suppkey', 'title|', K.TITLES_FEMALE)} END AS title,
       count(*) AS n
FROM g GROUP BY 1, 2""")
def q_member_category_counts(spark, sf_dir):
    """The report's gender × title frequencies over the generated people."""
    from starloom.operators.profile import counts_by
    from starloom.plans.generate import generate_members
    m = generate_members(Tables(spark, sf_dir).supplier.select("s_suppkey"), "s_suppkey", ["s_suppkey"])
    return counts_by(m, ["gender", "title"])


@query("incremental_dim_stream", SQL_INCREMENTAL)
def q_incremental_dim_stream(spark, sf_dir):
    """The parts consumed as a stream of two batches of files, one per
    micro-batch; each adds its unseen names to the dimension with ids after the current maximum."""
    from starloom.session import scratch_path
    from starloom.streaming.loaders import DimSink, latest_snapshot, run_feed
    p = Tables(spark, sf_dir).part.select("p_partkey", F.concat("p_brand", F.lit(" "), "p_name").alias("name"))
    source, target = scratch_path(spark, "dim-source"), scratch_path(spark, "dim-stream")
    p.where(F.col("p_partkey") % 3 == 0).write.parquet(f"{source}/first")
    run_feed(spark, f"{source}/*", p.schema, DimSink(target, "name"), "dim")
    p.where(F.col("p_partkey") % 3 != 0).write.parquet(f"{source}/second")
    run_feed(spark, f"{source}/*", p.schema, DimSink(target, "name"), "dim")  # goes on after the first batch
    return latest_snapshot(spark, target).select("id", "name")
