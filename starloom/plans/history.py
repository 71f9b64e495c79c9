"""Election-history dimension: generated validity ranges and SCD2 history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import add_minutes
from starloom.operators.dedupe import union_prefer
from starloom.operators.keys import dense_key
from starloom.operators.scd2 import OPEN_END, open_end
from starloom.plans import constants as K


def date_ranges(df: DataFrame, order: Sequence[str], start: str = K.RANGE_START,
                step_minutes: int = K.RANGE_STEP_MINUTES, key: str | None = None) -> DataFrame:
    """The i-th row in ``order`` is valid from ``start + (i-1)·step`` to the
    next row's start; the last row is open-ended.  ``key`` keeps the number as
    a column.  More rows than steps fit before the open end fail with an
    error: choose a smaller step."""
    num, total = key or "_rng_rn", "_rng_total"
    keyed = dense_key(df, order, num, total=total)
    first = dt.datetime.fromisoformat(start)
    room = int((dt.datetime.fromisoformat(OPEN_END) - first).total_seconds() // 60 // step_minutes)
    checked = F.when(F.col(total) > room, F.raise_error(F.lit(f"more than {room} ranges of {step_minutes} minutes do not fit before {OPEN_END}"))
                     .cast("bigint")).otherwise(F.col(num))
    t0 = F.lit(start).cast("timestamp_ntz")
    out = (keyed.withColumn("date_from", add_minutes(t0, checked - 1, step_minutes))
                .withColumn("date_to", F.when(F.col(num) == F.col(total), open_end())
                                       .otherwise(add_minutes(t0, F.least(F.col(num), F.lit(room).cast("bigint")), step_minutes))))
    return out.drop(total) if key else out.drop(total, num)


def dim_election_history(db: DataFrame, csv: DataFrame | None = None) -> DataFrame:
    """(election_id, pre_blank_votes, pre_null_votes, historical_turnout) from
    one or two sources → one row per election (database wins), dense key by
    election id, validity ranges in the same order."""
    cols = ["election_id", "pre_blank_votes", "pre_null_votes", "historical_turnout"]
    a = db.select(*cols).dropna(subset=["election_id"]).distinct()
    u = a
    if csv is not None:
        b = csv.select(*cols).dropna(subset=["election_id"]).distinct()
        u = union_prefer([a, b], ["election_id"], cols[1:])
    u = (u.withColumn("election_id", F.col("election_id").cast("bigint"))
          .withColumn("pre_blank_votes", F.col("pre_blank_votes").cast("int"))
          .withColumn("pre_null_votes", F.col("pre_null_votes").cast("int"))
          .withColumn("historical_turnout", F.col("historical_turnout").cast("double")))
    return date_ranges(u, cols, key="election_history_tk").select("election_history_tk", *cols, "date_from", "date_to")
