"""Adapters: the supplied tables seen through the warehouse's domain.

| warehouse            | source tables                                    |
|----------------------|--------------------------------------------------|
| country (name,region)| nation ⟕ region                                   |
| party (id, name)     | part.p_brand ``Brand#N`` → (N, brand); feed names = p_type |
| person               | supplier, party FK = nation                       |
| election             | orders (date) + customer's nation                 |
| wide feed row        | lineitem ⟕ orders ⟕ customer ⟕ nation ⟕ part      |
| snapshots per key    | events: user_id = territory, ts = time            |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import safe_percentage
from starloom.operators.lookup import has_repeats
from starloom.sources.files import read_table

LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

FEED_MEASURES = ["total_mandates", "available_mandates", "num_parishes", "num_parishes_approved",
                 "blank_votes", "blank_votes_percentage", "null_votes", "null_votes_percentage",
                 "voters_percentage", "subscribed_voters", "total_voters", "mandates", "votes",
                 "percentage", "valid_votes_percentage", "final_mandates"]


class Tables:
    """Lazy access to the parquet tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._cache = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]


def nation_regions(t: Tables) -> DataFrame:
    """Every nation with its region's name, which is null by a stated rule
    (for queries about missing values): where n_nationkey is a multiple of 3."""
    known = F.when(F.col("n_nationkey") % 3 != 0, F.col("r_name")).alias("r_name")
    return (t.nation.join(t.region, t.nation["n_regionkey"] == t.region["r_regionkey"], "left")
            .select("n_nationkey", "n_name", "n_regionkey", known))


def country_source(t: Tables) -> DataFrame:
    """(id, name, region)."""
    r = t.region
    return (t.nation.join(r, t.nation["n_regionkey"] == r["r_regionkey"], "left")
            .select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
                    F.col("r_name").alias("region")))


def party_source(t: Tables) -> DataFrame:
    """(id, name) from the distinct part brands."""
    return (t.part.select(F.col("p_brand").alias("name")).distinct()
            .withColumn("id", F.substring_index("name", "#", -1).cast("int")))


def party_feed_names(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_type").alias("Party"))


def person_source(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("id"),
        F.substring_index("s_name", "#", 1).alias("first_name"),
        F.substring_index("s_name", "#", -1).alias("last_name"),
        (F.lit(1950) + F.col("s_nationkey")).alias("birth_year"),
        F.when(F.col("s_acctbal") >= 0, F.lit("Dr.")).alias("title"),
        F.col("s_nationkey").alias("party_id"))


def election_source(t: Tables) -> DataFrame:
    """(election_id, year as text, country_id)."""
    c = t.customer.select("c_custkey", "c_nationkey")
    return (t.orders.join(c, t.orders["o_custkey"] == c["c_custkey"], "left")
            .select(F.col("o_orderkey").alias("election_id"),
                    F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("year"),
                    F.col("c_nationkey").alias("country_id")))


def wide_feed(t: Tables, number: str | None = None, is_last: str | None = None) -> DataFrame:
    """One row per line item: time, territory, party and the measures, all by
    left joins.  ``number`` names a dense key of the line items over
    ``LINEITEM_ORDER``, ``is_last`` a flag for each order's last number.

    Line items pass two exchanges: they meet the part, then everything that is
    known by order: their number, the order header (enriched before, by
    order-sized joins) and, since the feed leaves hash-partitioned by
    ``election_id``, the next look-ups.  Where parts share a key, line items
    are numbered before they meet them, at the cost of one more exchange."""
    from starloom.operators.sequence import grouped_key
    n = t.nation.select("n_nationkey", "n_name")
    c = t.customer.select("c_custkey", "c_nationkey")
    o = (t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
         .join(c, F.col("o_custkey") == c["c_custkey"], "left")
         .join(n, F.col("c_nationkey") == n["n_nationkey"], "left")
         .select("o_orderkey", "o_orderdate", "n_name"))
    p = t.part.select("p_partkey", "p_brand", "p_size")
    li = t.lineitem.select(*LINEITEM_ORDER)

    def with_part(rows: DataFrame) -> DataFrame:
        return rows.join(p, F.col("l_partkey") == F.col("p_partkey"), "left")

    if not number:
        j = with_part(li)
    elif has_repeats(p, "p_partkey"):
        j = with_part(grouped_key(li, LINEITEM_ORDER, number, is_last))
    else:
        j = grouped_key(with_part(li), LINEITEM_ORDER, number, is_last, source=li)
    j = j.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    votes = F.col("l_quantity").cast("bigint")
    blank = F.when(F.col("l_returnflag") == "R", votes).otherwise(F.lit(0).cast("bigint"))
    void = F.when(F.col("l_returnflag") == "A", votes).otherwise(F.lit(0).cast("bigint"))
    return j.select(
        *([number] if number else []), *([is_last] if is_last else []),
        F.col("l_orderkey").alias("election_id"), F.col("o_orderdate").alias("time"),
        F.col("n_name").alias("territory_name"), F.col("p_brand").alias("party"),
        (F.col("l_linenumber") + F.col("p_size")).alias("total_mandates"), F.col("p_size").alias("available_mandates"),
        (F.col("p_size") * 2).alias("num_parishes"), F.col("p_size").alias("num_parishes_approved"),
        F.col("l_linenumber").alias("mandates"), votes.alias("votes"),
        (F.col("l_discount") * 100).alias("percentage"),
        (F.col("l_tax") * 100).alias("valid_votes_percentage"),
        F.col("l_linenumber").alias("final_mandates"),
        blank.alias("blank_votes"), safe_percentage(blank, votes).alias("blank_votes_percentage"),
        void.alias("null_votes"), safe_percentage(void, votes).alias("null_votes_percentage"),
        safe_percentage(votes, votes * 2).alias("voters_percentage"),
        (votes * 2).alias("subscribed_voters"), votes.alias("total_voters"),
        F.when(F.col("l_linestatus") == "O", votes).otherwise(F.lit(0).cast("bigint")).alias("pre_blank_votes"),
        F.lit(0).cast("bigint").alias("pre_null_votes"),
        safe_percentage(votes, votes * 2).alias("historical_turnout"))


def hierarchy_edges(t: Tables) -> DataFrame:
    """(hierarchy, child, parent) of the declared hierarchies."""
    from starloom.plans.dims import orientation_frame

    def edges(rows: DataFrame, name: str, level: str, child, above: str, parent) -> DataFrame:
        return rows.select(F.lit(name).alias("hierarchy"), F.concat(F.lit(f"{level} "), child).alias("child"),
                           F.concat(F.lit(f"{above} "), parent).alias("parent"))

    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    brands = t.part.select("p_brand").where(F.col("p_brand").isNotNull()).distinct().withColumn("party_id", F.substring_index("p_brand", "#", -1).cast("int"))
    parties = brands.join(orientation_frame(t.nation.sparkSession), "party_id", "left")
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("d")).where(F.col("d").isNotNull()).distinct()
    day, month, year = (F.date_format("d", p) for p in ("yyyy-MM-dd", "yyyy-MM", "yyyy"))
    parts = [
        edges(t.region, "geography", "region", F.col("r_name"), "world", F.lit(None).cast("string")),
        edges(nations, "geography", "country", F.col("n_name"), "region", F.col("r_name")),
        edges(t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "left"), "geography", "supplier", F.col("s_name"), "country", F.col("n_name")),
        edges(parties, "politics", "party", F.col("p_brand"), "orientation", F.col("orientation")),
        edges(t.supplier.join(brands, F.col("s_nationkey") == F.col("party_id"), "left"), "politics", "person", F.col("s_name"), "party", F.col("p_brand")),
        edges(days, "calendar", "date", day, "month", month), edges(days, "calendar", "month", month, "year", year)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
