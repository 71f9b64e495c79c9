"""History, hierarchies and names: bucketed merge, as-of look-up, closure,
collated names, diagnostics of the feed load."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.plans import constants as K
from starloom.plans.feeds import Tables
from starloom.plans.q_warehouse import SCD2_COLS, SQL_SCD2, SQL_TRACKED, _events
from starloom.plans.registry import query
from starloom.plans.sqlfrag import values


@query("scd2_merge_bucketed", SQL_SCD2)
def q_scd2_merge_bucketed(spark, sf_dir):
    """The events in three batches merged into a bucketed history: up to the
    middle of the month, after it, and late rows of the whole month (every
    50th event)."""
    from starloom.operators.history_store import HistoryStore
    from starloom.session import scratch_path
    e = _events(Tables(spark, sf_dir))
    cut, late = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"), F.col("event_id") % 50 == 0
    store = HistoryStore(spark, scratch_path(spark, "scd2-buckets"), e.schema, "user_id", "ts", ["event_id"], buckets=8)
    for n, part in enumerate([~late & (F.col("ts") < cut), ~late & (F.col("ts") >= cut), late]):
        store.merge(e.where(part), n)
    return store.read().select(*SCD2_COLS)


@query("fact_history_as_of", f"""
WITH h AS ({SQL_TRACKED}),
k AS (SELECT *, row_number() OVER (ORDER BY user_id, version) AS history_tk FROM h),
f AS (SELECT event_id, user_id, ts - INTERVAL 6 HOUR AS seen_at, value FROM events)
SELECT f.event_id, f.user_id, f.seen_at, f.value, coalesce(k.history_tk, 0) AS history_tk, coalesce(k.version, 0) AS version, k.event_type AS state
FROM f LEFT JOIN k ON f.user_id = k.user_id AND f.seen_at >= k.date_from AND f.seen_at < k.date_to""")
def q_fact_history_as_of(spark, sf_dir):
    """Every snapshot row with the history key that was valid for its
    territory six hours before; rows before the first version have key 0."""
    from starloom.operators.asof import as_of
    from starloom.operators.keys import dense_key
    from starloom.operators.scd2 import build_history
    e = _events(Tables(spark, sf_dir))
    history = build_history(e.withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz")), "user_id", "ts", ["event_id"], track=["event_type"])
    history = dense_key(history.select("user_id", "version", "date_from", "date_to", F.col("event_type").alias("state")), ["user_id", "version"], "history_tk")
    seen = (F.col("ts") - F.expr("INTERVAL 6 HOURS")).cast("timestamp_ntz")
    facts = e.select("event_id", "user_id", seen.alias("seen_at"), "value")
    found = as_of(facts, history, ["user_id"], "seen_at", "date_from", ["history_tk", "version", "state"], until="date_to", turn="version")
    return found.fillna(0, ["history_tk", "version"])


@query("hierarchy_closure", f"""
WITH RECURSIVE o AS (SELECT * FROM {values(K.PARTY_ORIENTATION, ['party_id', 'orientation'])}),
b AS (SELECT DISTINCT p_brand AS brand, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS id FROM part WHERE p_brand IS NOT NULL),
d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL),
e AS (
  SELECT DISTINCT * FROM (
    SELECT 'geography' AS hierarchy, 'region ' || r_name AS child, NULL AS parent FROM region
    UNION ALL SELECT 'geography', 'country ' || n_name, 'region ' || r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'geography', 'supplier ' || s_name, 'country ' || n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
    UNION ALL SELECT 'politics', 'party ' || brand, 'orientation ' || orientation FROM b LEFT JOIN o ON b.id = o.party_id
    UNION ALL SELECT 'politics', 'person ' || s_name, 'party ' || brand FROM supplier LEFT JOIN b ON s_nationkey = b.id
    UNION ALL SELECT 'calendar', 'date ' || strftime(d, '%Y-%m-%d'), 'month ' || strftime(d, '%Y-%m') FROM d
    UNION ALL SELECT 'calendar', 'month ' || strftime(d, '%Y-%m'), 'year ' || strftime(d, '%Y') FROM d) x),
m AS (SELECT hierarchy, child AS member FROM e UNION SELECT hierarchy, parent FROM e WHERE parent IS NOT NULL),
c AS (
  SELECT hierarchy, member AS ancestor, member AS descendant, CAST(0 AS BIGINT) AS depth FROM m
  UNION ALL SELECT c.hierarchy, e.parent, c.descendant, c.depth + 1 FROM c JOIN e ON e.hierarchy = c.hierarchy AND e.child = c.ancestor
  WHERE e.parent IS NOT NULL),
k AS (SELECT *, row_number() OVER (ORDER BY hierarchy, member) AS tk FROM m)
SELECT c.hierarchy, c.ancestor, c.descendant, c.depth, a.tk AS ancestor_tk, x.tk AS descendant_tk
FROM c JOIN k a ON a.hierarchy = c.hierarchy AND a.member = c.ancestor JOIN k x ON x.hierarchy = c.hierarchy AND x.member = c.descendant""")
def q_hierarchy_closure(spark, sf_dir):
    """Ancestors of every member of the three declared hierarchies, with keys:
    region → country → supplier, orientation → party → person, year → month →
    date.  Parties without an orientation and people without a party are roots."""
    from starloom.operators.hierarchy import keyed_closure
    from starloom.plans.feeds import hierarchy_edges
    return keyed_closure(hierarchy_edges(Tables(spark, sf_dir)), ["hierarchy"])


_SPELT = """CASE c_custkey % 5
  WHEN 0 THEN replace(replace(n_name, 'A', 'ắ'), 'E', 'ế')
  WHEN 1 THEN replace(replace(lower(n_name), 'a', 'a' || chr(769)), 'i', 'I' || chr(776))
  WHEN 2 THEN upper(n_name) ELSE replace(n_name, 'O', 'Ǒ') END || CASE c_custkey % 3 WHEN 0 THEN ' ΆΛΦΑ' WHEN 1 THEN ' ёлка' ELSE '' END"""


@query("collated_join", f"""
WITH f AS (SELECT c_custkey, {_SPELT} AS territory FROM customer JOIN nation ON c_nationkey = n_nationkey),
d AS (SELECT n_nationkey * 3 + k AS country_id, n_name || [' Άλφα', ' Елка', ''][k + 1] AS name FROM nation, range(3) r(k)),
u AS (SELECT strip_accents(lower(name)) AS folded, min(country_id) AS country_id FROM d GROUP BY 1),
g AS (SELECT strip_accents(lower(territory)) AS folded, min(encode(territory)) AS territory, count(*) AS n_rows, count(DISTINCT territory) AS n_spellings FROM f GROUP BY 1)
SELECT decode(territory) AS territory, CAST(n_rows AS BIGINT) AS n_rows, n_spellings, country_id FROM g LEFT JOIN u USING (folded)""")
def q_collated_join(spark, sf_dir):
    """Territories of the feed in many spellings (Vietnamese, Greek, Cyrillic,
    composed and decomposed letters, upper and lower case), one row each, with
    the key of the country of that name."""
    from starloom.operators.dedupe import spellings
    from starloom.operators.lookup import collated_lookup
    t = Tables(spark, sf_dir)
    spelt = _SPELT.replace("chr(769)", "'́'").replace("chr(776)", "'̈'")
    feed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.expr(spelt).alias("territory"))
    tails = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(x).alias("tail")) for k, x in enumerate([" Άλφα", " Елка", ""])]))
    dim = t.nation.select("n_nationkey", "n_name", tails.alias("x")).select(
        (F.col("n_nationkey") * 3 + F.col("x.k")).alias("id"), F.concat("n_name", "x.tail").alias("name"))
    return collated_lookup(spellings(feed, "territory"), "territory", dim, "name", "id", "country_id")


@query("election_feed_diagnostics", """
WITH f AS (
  SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'day ' || (o_orderkey % 7) ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS time,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN n_nationkey % 9 = 4 THEN n_name || ' (new)' ELSE n_name END AS territory
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
m AS (SELECT f.*, try_cast(time AS TIMESTAMP) AS t, n.n_name AS found FROM f LEFT JOIN nation n ON lower(strip_accents(trim(territory))) = lower(n.n_name)),
r AS (
  SELECT 'time missing' AS reason, NULL AS value FROM m WHERE time IS NULL
  UNION ALL SELECT 'time not parsed', time FROM m WHERE time IS NOT NULL AND t IS NULL
  UNION ALL SELECT 'territory missing', NULL FROM m WHERE territory IS NULL
  UNION ALL SELECT 'territory unknown', territory FROM m WHERE territory IS NOT NULL AND found IS NULL)
SELECT reason, value, count(*) AS n FROM r GROUP BY ALL
UNION ALL SELECT 'rows read', NULL, count(*) FROM m
UNION ALL SELECT 'rows dropped', NULL, count(*) FROM m WHERE t IS NULL OR found IS NULL""")
def q_election_feed_diagnostics(spark, sf_dir):
    """What the feed-side load drops and why: a count for every unparsed date
    and unmapped name, rows read and dropped.  Bad dates and names are made by
    a stated rule."""
    from starloom.operators.lookup import collated_lookup
    from starloom.operators.quality import diagnostics
    from starloom.functions import parse_timestamp
    t = Tables(spark, sf_dir)
    key = F.col("o_orderkey")
    rows = (t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
                    .join(t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    feed = rows.select(
        F.when(key % 11 == 0, F.concat(F.lit("day "), (key % 7).cast("string"))).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("time"),
        F.when(key % 13 == 0, F.lit(None)).when(F.col("n_nationkey") % 9 == 4, F.concat("n_name", F.lit(" (new)"))).otherwise(F.col("n_name")).alias("territory"))
    feed = collated_lookup(feed.withColumn("t", parse_timestamp("time")), "territory", t.nation, "n_name", "n_nationkey", "country_id")
    time, place = F.col("time"), F.col("territory")
    return diagnostics(feed, [("time missing", time.isNull(), None), ("time not parsed", time.isNotNull() & F.col("t").isNull(), time),
                              ("territory missing", place.isNull(), None), ("territory unknown", place.isNotNull() & F.col("country_id").isNull(), place)])
