"""Generated members, imputation from pools, time slots, grids and
incremental loads.  Every "random" value is a repeatable hash pick."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import at_time_of_day, hash_between, hash_pick, spread_between
from starloom.operators.keys import continue_key, dense_key
from starloom.operators.lookup import anti_new, semi_exists
from starloom.operators.sequence import sequence_per_key
from starloom.plans import constants as K


def impute_from_pool(df: DataFrame, col: str, key: str, pool: Sequence[str], salt: str) -> DataFrame:
    """Fill nulls of ``col`` with a pool value picked by ``key`` (the
    set-based form of ``UPDATE … SET col = ? WHERE col IS NULL``)."""
    return df.withColumn(col, F.coalesce(F.col(col), hash_pick(key, salt, pool)))


def generate_members(parents: DataFrame, parent_key: str, id_order: Sequence[str]) -> DataFrame:
    """One generated person per parent row: gender, first name and title
    from the gender's pools, last name, birth year in range."""
    g = hash_pick(parent_key, "gender|", ["M", "F"])
    male = F.col("gender") == F.lit("M")
    out = (parents.withColumn("gender", g)
           .withColumn("first_name", F.when(male, hash_pick(parent_key, "first|", K.MALE_NAMES))
                       .otherwise(hash_pick(parent_key, "first|", K.FEMALE_NAMES)))
           .withColumn("last_name", hash_pick(parent_key, "last|", K.LAST_NAMES))
           .withColumn("birth_year", hash_between(parent_key, "year|", *K.BIRTH_YEARS))
           .withColumn("title", F.when(male, hash_pick(parent_key, "title|", K.TITLES_MALE))
                       .otherwise(hash_pick(parent_key, "title|", K.TITLES_FEMALE)))
           .withColumn("party_id", F.col(parent_key).cast("bigint")))
    keyed = dense_key(out, id_order, "person_id")
    return keyed.select("person_id", "first_name", "last_name", "birth_year", "title", "gender", "party_id")


def hour_slots(dates: DataFrame, date_col: str, first_hour: int = K.SLOT_HOURS[0],
               last_hour: int = K.SLOT_HOURS[1]) -> DataFrame:
    """One row per (date, hourly slot between the two hours)."""
    seq = F.sequence(at_time_of_day(date_col, first_hour), at_time_of_day(date_col, last_hour),
                     F.expr("INTERVAL 1 HOUR"))
    return dates.select(F.col(date_col).alias("full_date"), F.explode(seq).alias("slot_ts"))


def last_slot(slots: DataFrame) -> DataFrame:
    return slots.groupBy("full_date").agg(F.max("slot_ts").alias("last_slot_ts"))


def spread_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str], date_col: str,
                    out: str = "slot_ts") -> DataFrame:
    """Spread the members of each group evenly over the election night."""
    seq = sequence_per_key(df, group, order, rn="_sp_rn", size="_sp_n")
    return seq.withColumn(out, spread_between(date_col, "_sp_rn", "_sp_n", *K.SPREAD_HOURS)) \
              .drop("_sp_rn", "_sp_n")


def month_grid(facts_months: DataFrame, month_col: str, members: DataFrame, member_key: str) -> DataFrame:
    """Calendar-by-member grid: every member gets the month spine between the
    first and last month of ``facts_months`` (a generator per member row, no
    join of two tables), then months absent from the data are dropped by a
    semi join.  Output size is members × months."""
    span = facts_months.agg(F.min(month_col).alias("_m0"), F.max(month_col).alias("_m1")).first()
    if span["_m0"] is None:
        return members.select(member_key).withColumn(month_col, F.lit(None).cast("date")).limit(0)
    spine = F.sequence(F.lit(span["_m0"]), F.lit(span["_m1"]), F.expr("INTERVAL 1 MONTH"))
    grid = members.select(member_key, F.explode(spine).alias(month_col))
    return semi_exists(grid, facts_months.select(month_col).distinct(), [month_col])


def incremental_load(target: DataFrame | None, batch: DataFrame, natural: str, id_col: str = "id") -> DataFrame:
    """Distinct natural keys of ``batch`` not yet in ``target`` get ids after
    the current maximum; the new target is old ∪ new.  A rerun adds nothing."""
    names = batch.select(natural).where(F.col(natural).isNotNull()).distinct()
    if target is None:
        return dense_key(names, [natural], id_col).select(id_col, natural)
    new = anti_new(names, target.select(natural), [natural])
    added = continue_key(new, target, id_col, [natural], id_col).select(id_col, natural)
    return target.select(id_col, natural).unionByName(added)
