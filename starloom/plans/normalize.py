"""Normalise a wide feed (one row per time × territory × party) into linked
tables with generated ids: country, party, election, result, history.

Set-based: each entity is a distinct projection numbered with a dense key and
joined back by natural key; one election per feed row (as the row-wise
loader does), whose key the result and history rows reuse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import clean_name
from starloom.operators.keys import dense_key
from starloom.operators.lookup import join_dim


def countries(feed: DataFrame) -> DataFrame:
    names = feed.select(clean_name("territory_name").alias("name")).where(F.col("name").isNotNull()).distinct()
    return dense_key(names, ["name"], "id").select("id", "name")


def parties(feed: DataFrame) -> DataFrame:
    names = feed.select(F.trim("party").alias("name")).where(F.col("name").isNotNull()).distinct()
    return dense_key(names, ["name"], "id").select("id", "name")


def elections(numbered: DataFrame, country: DataFrame, measures: Sequence[str]) -> DataFrame:
    c = country.select(F.col("name").alias("_cn"), F.col("id").alias("country_id"))
    j = join_dim(numbered.withColumn("_cn", clean_name("territory_name")), c, "_cn", "left")
    return j.select(F.col("election_id").alias("id"), F.col("time").alias("year"), *measures, "country_id")


def results(numbered: DataFrame, party: DataFrame, measures: Sequence[str]) -> DataFrame:
    p = party.select(F.col("name").alias("_pn"), F.col("id").alias("party_id"))
    j = join_dim(numbered.withColumn("_pn", F.trim("party")), p, "_pn", "left")
    return j.select(F.col("election_id").alias("id"), "election_id", "party_id", *measures)


def histories(numbered: DataFrame) -> DataFrame:
    return numbered.select(F.col("election_id").alias("id"), "election_id",
                           "pre_blank_votes", "pre_null_votes", "historical_turnout")
