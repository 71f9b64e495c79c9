"""Fact table: look up the dimension keys of every feed row, keep the
measures, mark the last row of each election as the official result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import clean_name
from starloom.operators.lookup import join_dim, unique_lookup
from starloom.plans import constants as K

#: Fact ids of a block (2^22): what one file of a year holds at most.
BLOCK_BITS = 22


def fact_election_result(feed: DataFrame, dim_election_df: DataFrame, dim_country_df: DataFrame,
                         dim_date_df: DataFrame, dim_party_df: DataFrame, dim_history_df: DataFrame,
                         measures: Sequence[str], is_last: str | None = None) -> DataFrame:
    """``feed``: (fact_id, election_id, time, territory_name, party,
    measures…), numbered along (election, …, time) by a dense key.

    Every look-up has one row per natural key, and all joins are left joins,
    so the fact has exactly the feed's rows.  The election look-ups come
    first: they share the feed's partitioning by election id.  The row with
    an election's largest ``fact_id`` is its official result: ``is_last`` names
    the feed's flag for it; without, it is found by one more join."""
    f = feed.withColumn("country_name", clean_name("territory_name")).withColumn("full_date", F.col("time").cast("date"))
    if is_last is None:
        last = feed.groupBy(F.col("election_id").alias("_lid")).agg(F.max("fact_id").alias("_last"))
        f = join_dim(f, last, F.col("election_id").eqNullSafe(F.col("_lid")))
    j = join_dim(f, unique_lookup(dim_election_df, "election_id", "election_tk"), "election_id")
    j = join_dim(j, unique_lookup(dim_history_df, "election_id", "election_history_tk"), "election_id")
    j = join_dim(j, unique_lookup(dim_country_df, "country_name", "country_tk"), "country_name")
    j = join_dim(j, unique_lookup(dim_date_df, "full_date", "date_tk"), "full_date")
    j = join_dim(j, unique_lookup(dim_party_df, "name", "party_tk", "party"), "party")
    official = F.when(F.col(is_last) if is_last else F.col("fact_id") == F.col("_last"), F.lit(K.RESULT_OFFICIAL)).otherwise(F.lit(K.RESULT_PRELIMINARY))
    return j.select("fact_id", "election_tk", "country_tk", "date_tk", "party_tk", "election_history_tk",
                    *measures, official.alias("result_type"))


def by_year(fact: DataFrame, dim_date_df: DataFrame) -> DataFrame:
    """``fact`` with its ``year``, dealt to tasks by year and block of fact ids:
    each year gets files of bounded size, each of few blocks.  No range is
    sampled: that would run all look-ups twice."""
    rows = join_dim(fact, dim_date_df.select("date_tk", "year"), "date_tk")
    return rows.repartition("year", F.shiftright("fact_id", BLOCK_BITS))
