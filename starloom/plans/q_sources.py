"""Source and sink queries: CSV feeds, table dicts, literal look-ups, catalog,
write-and-read-back loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators.lookup import join_dim
from starloom.plans import constants as K
from starloom.plans.dims import orientation_frame
from starloom.plans.feeds import Tables
from starloom.plans.registry import query
from starloom.plans.sqlfrag import values
from starloom.session import scratch_path
from starloom.sources import catalog, files, sinks


@query("csv_scan", "SELECT * FROM nation")
def q_csv_scan(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = files.write_csv(t.nation, scratch_path(spark, "nation-csv"))
    return files.read_csv(spark, path, schema=t.nation.schema)


@query("csv_scan_limit", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 2000")
def q_csv_scan_limit(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = files.write_csv(t.orders, scratch_path(spark, "orders-csv"))
    return files.read_csv_head(spark, path, 2000, ["o_orderkey"], schema=t.orders.schema)


@query("csv_scan_bom", "SELECT * FROM region")
def q_csv_scan_bom(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = files.write_csv(t.region, scratch_path(spark, "region-bom-csv"), bom=True)
    raw = files.read_csv(spark, path)  # header names as written, BOM dropped by the reader
    return raw.select(F.col("r_regionkey").cast("int").alias("r_regionkey"), F.col("r_name"))


@query("csv_dotted_columns", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS pre_blank_votes FROM customer""")
def q_csv_dotted_columns(spark, sf_dir):
    t = Tables(spark, sf_dir)
    feed = t.customer.select(F.col("c_custkey").alias("customer.id"), F.col("c_name").alias("customer.name"),
                             F.col("c_acctbal").alias("pre.blankVotes"))
    path = files.write_csv(feed, scratch_path(spark, "customer-dotted-csv"))
    raw = files.read_csv(spark, path)
    return raw.select(files.dotted("customer.id").cast("bigint").alias("customer_id"),
                      files.dotted("customer.name").alias("customer_name"),
                      files.dotted("pre.blankVotes").cast("double").alias(files.snake("pre.blankVotes")))


@query("extract_all", """
SELECT 'region' AS table_name, count(*) AS row_count FROM region
UNION ALL SELECT 'nation', count(*) FROM nation
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'supplier', count(*) FROM supplier""")
def q_extract_all(spark, sf_dir):
    srcs = files.read_tables(spark, sf_dir, ["region", "nation", "customer", "supplier", "person"],
                             optional=["person"])
    out = None
    for name, df in srcs.items():
        c = df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
        out = c if out is None else out.unionByName(c)
    return out


@query("inline_lookup", f"""
SELECT p.p_partkey, CAST(split_part(p.p_brand, '#', 2) AS INTEGER) AS party_id, o.orientation
FROM part p LEFT JOIN {values(K.PARTY_ORIENTATION, ['o_party_id', 'orientation'], 'o')}
     ON CAST(split_part(p.p_brand, '#', 2) AS INTEGER) = o.o_party_id""")
def q_inline_lookup(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select(
        "p_partkey", F.substring_index("p_brand", "#", -1).cast("int").alias("party_id"))
    return join_dim(p, orientation_frame(spark), "party_id", "left")


@query("catalog_columns", """
SELECT 'region' AS table_name, column_name, row_number() OVER () AS position FROM (DESCRIBE region)
UNION ALL SELECT 'nation', column_name, row_number() OVER () FROM (DESCRIBE nation)
UNION ALL SELECT 'supplier', column_name, row_number() OVER () FROM (DESCRIBE supplier)""")
def q_catalog_columns(spark, sf_dir):
    srcs = files.read_tables(spark, sf_dir, ["region", "nation", "supplier"])
    files.register_views(srcs)
    return catalog.columns_frame(spark, list(srcs))


@query("read_back", "SELECT * FROM region")
def q_read_back(spark, sf_dir):
    path = sinks.write_table(Tables(spark, sf_dir).region, scratch_path(spark, "region"))
    return spark.read.parquet(path)


@query("append_load", "SELECT * FROM region UNION ALL SELECT * FROM region")
def q_append_load(spark, sf_dir):
    r = Tables(spark, sf_dir).region
    path = scratch_path(spark, "region-append")
    sinks.append_table(r, path)
    sinks.append_table(r, path)
    return spark.read.parquet(path)


#: Columns of each written table whose text is the same in every engine.
STAR_TEXT = {
    "dim_country": ["country_tk", "country_id", "country_name", "region"],
    "dim_date": ["date_tk", "full_date", "year", "month", "day", "weekday"],
    "dim_party": ["party_tk", "party_id", "name", "orientation"],
    "dim_person": ["person_tk", "person_id", "first_name", "last_name", "birth_year", "title", "party_id"],
    "dim_election": ["election_tk", "election_id", "date_tk", "country_tk"],
    "dim_election_history": ["election_history_tk", "election_id", "pre_blank_votes", "pre_null_votes"],
    "fact_election_result": ["fact_id", "election_tk", "country_tk", "date_tk", "party_tk", "election_history_tk", "total_mandates",
                             "available_mandates", "num_parishes", "num_parishes_approved", "blank_votes", "null_votes",
                             "subscribed_voters", "total_voters", "mandates", "votes", "final_mandates", "result_type"],
}
NORMALISED_TEXT = {
    "country": ["id", "name"], "party": ["id", "name"],
    "election": ["id", "blank_votes", "null_votes", "subscribed_voters", "total_voters", "country_id"],
    "result": ["id", "election_id", "party_id", "mandates", "votes", "final_mandates"],
    "election_history": ["id", "election_id", "pre_blank_votes", "pre_null_votes"],
}


def _digest_sql(tables: dict[str, tuple[str, list[str]]]) -> str:
    """Per table: rows, and the sum of a hash of every row's text."""
    def one(name, source, cols):
        text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
        return (f"SELECT '{name}' AS table_name, count(*) AS row_count, "
                f"CAST(coalesce(sum(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)), 0) AS BIGINT) AS contents FROM {source}")
    return " UNION ALL ".join(one(n, src, cols) for n, (src, cols) in tables.items())


def _star_sql() -> str:
    from starloom.plans import q_warehouse as W
    return f"WITH {W.SQL_STAR} " + _digest_sql({n: ("fact" if n.startswith("fact") else n, c) for n, c in STAR_TEXT.items()})


def _normalised_sql() -> str:
    from starloom.plans import q_warehouse as W
    source = {"country": "ncountry", "party": "nparty",
              "election": f"(SELECT f.election_id AS id, f.*, c.id AS country_id FROM nfeed f LEFT JOIN ncountry c ON {W.SQL_CLEAN_TERRITORY} = c.name)",
              "result": "(SELECT f.election_id AS id, f.*, p.id AS party_id FROM nfeed f LEFT JOIN nparty p ON trim(f.party) = p.name)",
              "election_history": "(SELECT f.election_id AS id, f.* FROM nfeed f)"}
    return (f"WITH {W.SQL_FEED}, {W.SQL_NUMBERED_FEED}, {W.SQL_NORM_COUNTRY}, {W.SQL_NORM_PARTY} "
            + _digest_sql({n: (source[n], c) for n, c in NORMALISED_TEXT.items()}))


def star_build(spark, sf_dir: str, base: str | None = None) -> dict[str, str]:
    """Extract → six dimensions → fact → write, dimensions first.  Dimensions
    are stored by their keys, so the fact reads them without building them
    again."""
    from starloom.plans import facts
    from starloom.plans import q_warehouse as W
    t = Tables(spark, sf_dir)
    dc, dd, dp, dh = W.build_dim_country(t), W.build_dim_date(t), W.build_dim_party(t), W.build_dim_history(t)
    de = W.build_dim_election(t, dd, dc)
    # the fact is laid out on disk by election year, so later reads prune by year
    fact = facts.by_year(W.build_fact(t, dc, dd, dp, de, dh), dd)
    outputs = {"dim_country": dc, "dim_date": dd, "dim_party": dp, "dim_person": W.build_dim_person(t, dc),
               "dim_election": de, "dim_election_history": dh,
               "fact_election_result": fact}
    return sinks.load_all(spark, outputs, base or scratch_path(spark, "star"), partition_by={"fact_election_result": ["year"]})


@query("star_build", _star_sql())
def q_star_build(spark, sf_dir):
    return sinks.written_digests(spark, star_build(spark, sf_dir), STAR_TEXT)


@query("star_pipeline", _star_sql())
def q_star_pipeline(spark, sf_dir):
    """The whole extract-transform-load run; the same job as ``star_build``."""
    return q_star_build(spark, sf_dir)


@query("load_star", _normalised_sql())
def q_load_star(spark, sf_dir):
    from starloom.plans import normalize as N
    from starloom.plans import q_warehouse as W
    base = scratch_path(spark, "normalised")
    # the joined, numbered feed is written once; every table reads its columns
    feed = spark.read.parquet(sinks.write_table(W.numbered_feed(Tables(spark, sf_dir)), f"{base}/feed"))
    country, party = N.countries(feed), N.parties(feed)
    outputs = {"country": country, "party": party,
               "election": N.elections(feed, country, W.ELECTION_MEASURES),
               "result": N.results(feed, party, W.RESULT_MEASURES),
               "election_history": N.histories(feed)}
    return sinks.written_digests(spark, sinks.load_all(spark, outputs, base), NORMALISED_TEXT)


def _calendar_sql() -> str:
    from starloom.plans import q_warehouse as W
    return f"WITH {W.SQL_DIM_DATE} SELECT * FROM dim_date"


@query("create_tables", _calendar_sql())
def q_create_tables(spark, sf_dir):
    """Declared star tables created in the catalog, old ones dropped first,
    then the calendar dimension inserted and read back by name."""
    from starloom.plans import q_warehouse as W
    from starloom.plans.schemas import STAR_SCHEMAS
    base = scratch_path(spark, "declared")
    for name, schema in STAR_SCHEMAS.items():
        sinks.create_table(spark, f"star_{name}", schema, f"{base}/{name}")
    W.build_dim_date(Tables(spark, sf_dir)).write.insertInto("star_dim_date")
    return spark.table("star_dim_date")
