"""Dimension builders.  Inputs use the warehouse's own column names; the
adapters in ``starloom.plans.feeds`` map source tables onto them.

Every dimension publishes ``<name>_tk`` (dense surrogate key) next to its
natural key, so facts look keys up by natural key.  Source columns are cleaned
by declared specs: output column → (source column, type, text rule)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import hash_pick, parse_date
from starloom.operators.columns import clean, first_present
from starloom.operators.dedupe import first_per_key, union_prefer
from starloom.operators.keys import dense_key, max_key
from starloom.operators.lookup import anti_new, join_dim, unique_lookup
from starloom.plans import constants as K

COUNTRY = {"country_id": ("id", "bigint"), "country_name": ("name", "string", "name"), "region": ("region", "string", "name")}
PARTY = {"party_id": ("id", "int"), "name": ("name", "string", "trim")}
PERSON = {"person_id": ("id", "int"), "first_name": ("first_name", "string", "trim"), "last_name": ("last_name", "string", "trim"),
          "birth_year": ("birth_year", "int"), "title": ("title", "string", "trim"), "party_id": ("party_id", "int")}


# ---------------------------------------------------------------- country
def dim_country(db: DataFrame, csv: DataFrame | None = None, loaded: DataFrame | None = None,
                pool: Sequence[str] = K.REGIONS) -> DataFrame:
    """``db``: (id, name, region?) ; ``csv``: (name).  Clean names, union
    (database rows win), skip ids already loaded, one row per name and per
    non-null id, fill missing regions from ``pool``, key by (region, name)."""
    frames = [clean(db, COUNTRY)]
    if csv is not None:
        frames.append(clean(csv.select("name"), COUNTRY))
    u = union_prefer(frames, ["country_name"], ["country_id"])
    u = u.where(F.col("country_name").isNotNull())
    if loaded is not None:
        u = anti_new(u, loaded.select(F.col("country_id")), ["country_id"])
    u = first_per_key(u, ["country_id"], ["country_name"], keep_null_keys=True)
    u = u.withColumn("region", F.coalesce("region", hash_pick("country_name", "region|", pool)))
    return dense_key(u, ["region", "country_name"], "country_tk").select("country_tk", *COUNTRY)


# ---------------------------------------------------------------- date
def calendar_dates(sources: Sequence[DataFrame], preference: Sequence[str] = ("time", "year"),
                   fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Distinct calendar dates of all sources (text is parsed tolerantly)."""
    out = None
    for s in sources:
        c = first_present(s, preference)
        d = parse_date(F.col(c), fmt) if dict(s.dtypes)[c] == "string" else F.col(c).cast("date")
        part = s.select(d.alias("full_date")).where(F.col("full_date").isNotNull()).distinct()
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def dim_date(sources: Sequence[DataFrame], preference: Sequence[str] = ("time", "year")) -> DataFrame:
    """date_tk, full_date, year, month, day, weekday."""
    d = calendar_dates(sources, preference)
    d = (d.withColumn("year", F.year("full_date").cast("bigint"))
          .withColumn("month", F.month("full_date").cast("bigint"))
          .withColumn("day", F.dayofmonth("full_date").cast("bigint"))
          .withColumn("weekday", F.date_format("full_date", "EEEE")))
    return dense_key(d, ["full_date"], "date_tk").select("date_tk", "full_date", "year", "month", "day", "weekday")


# ---------------------------------------------------------------- party
def orientation_frame(spark: SparkSession) -> DataFrame:
    """The literal list as a ``VALUES`` relation: its size is known to the
    planner, so a join with it needs no exchange and no hint."""
    rows = ", ".join(f"({party}, '{orientation}')" for party, orientation in K.PARTY_ORIENTATION)
    return spark.sql(f"SELECT party_id, orientation FROM VALUES {rows} AS t(party_id, orientation)")


def dim_party(db: DataFrame, csv: DataFrame | None = None, orientation: DataFrame | None = None,
              csv_offset: int = 1000) -> DataFrame:
    """One row per party name.  A name of ``db`` (id, name) keeps its smallest
    id and takes its orientation from the list; a name only ``csv`` (Party)
    has gets the next id after ``csv_offset`` or the largest database id,
    whichever is larger, in order of name, and orientation 'unknown'."""
    orientation = orientation if orientation is not None else orientation_frame(db.sparkSession)
    known = clean(db, PARTY).where(F.col("party_id").isNotNull())
    parties = join_dim(first_per_key(known, ["name"], ["party_id"], keep_null_keys=False), orientation, "party_id")
    if csv is not None:
        names = clean(csv, {"name": ("Party", "string", "trim")}).dropna().distinct()
        start = max(csv_offset, max_key(known, "party_id"))
        added = dense_key(anti_new(names, known, ["name"]), ["name"], "party_id", offset=start)
        parties = parties.unionByName(added.select(F.col("party_id").cast("int"), "name", F.lit("unknown").alias("orientation")))
    return dense_key(parties, ["party_id", "name"], "party_tk").select("party_tk", "party_id", "name", "orientation")


# ---------------------------------------------------------------- person
def dim_person(db: DataFrame, dim_parent: DataFrame, parent_id: str, parent_tk: str,
               csv: DataFrame | None = None,
               required: Sequence[str] = ("person_id", "first_name", "last_name", "birth_year")) -> DataFrame:
    """``db``/``csv``: (id, first_name, last_name, birth_year, title, party_id).
    Rows missing a ``required`` column are dropped (title is nullable); the
    database row wins for an id in both; ``party_id`` becomes the parent
    dimension's surrogate key."""
    frames = [clean(x, PERSON).dropna(subset=list(required)) for x in (db, csv) if x is not None]
    u = union_prefer(frames, ["person_id"], ["first_name", "last_name"])
    parent = unique_lookup(dim_parent, parent_id, parent_tk, "_pid").withColumnRenamed(parent_tk, "_ptk")
    j = join_dim(u, parent, u["party_id"] == parent["_pid"], "left")
    j = j.withColumn("party_id", F.col("_ptk").cast("bigint")).select(*PERSON)
    return dense_key(j, ["person_id", "first_name", "last_name"], "person_tk").select("person_tk", *PERSON)


# ---------------------------------------------------------------- election
def dim_election(db: DataFrame, dim_date_df: DataFrame, dim_country_df: DataFrame,
                 csv: DataFrame | None = None, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """``db``/``csv``: (election_id, year (text or timestamp), country_id).
    Rows lacking one of the three, or whose date does not parse, are left out;
    one row per (election id, date, country) of both sources; calendar key by
    date, country key by id."""
    cols = ["election_id", "election_date", "country_id"]

    def dated(df):
        y = F.col("year")
        d = parse_date(F.trim(y), fmt) if dict(df.dtypes)["year"] == "string" else y.cast("date")
        return df.select(F.col("election_id").cast("bigint").alias("election_id"), d.alias("election_date"),
                         F.col("country_id").cast("bigint").alias("country_id")).dropna(subset=cols)

    e = dated(db) if csv is None else dated(db).unionByName(dated(csv))
    e = e.dropDuplicates(cols)
    e = join_dim(e, unique_lookup(dim_date_df, "full_date", "date_tk", "election_date"), "election_date", "left")
    e = join_dim(e, unique_lookup(dim_country_df, "country_id", "country_tk"), "country_id", "left")
    return dense_key(e, cols, "election_tk").select("election_tk", "election_id", "date_tk", "country_tk")
