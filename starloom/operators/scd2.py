"""Slowly changing dimension, type 2.

``build_history``: versions are numbered in event-time order; a version is
valid from its own time until the next version's time, the last one is
open-ended and current.

``merge_history``: apply a batch to a history snapshot.  Keys without a batch
row keep their versions; the others are rebuilt from their versions and the
batch together, so a late row takes its place in time and merging batch by
batch, in any order, equals building at once.  Parquet has no in-place UPDATE:
the result is a new snapshot to be written to a new folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.sequence import sequence_per_key

# Fixed value: the end of an open validity interval.
OPEN_END = "9999-12-31 23:59:59"
ADDED = ["version", "date_from", "date_to", "is_current"]


def open_end() -> F.Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def changes(feed: DataFrame, key: str, order: Sequence[str], track: Sequence[str],
            num_partitions: int | None = None) -> DataFrame:
    """Rows of ``feed`` that are the first of their key or differ from the row
    before it in a tracked column (null-safe)."""
    seq = sequence_per_key(feed, [key], order, prev_cols=track, is_first="_first", num_partitions=num_partitions)
    changed = F.col("_first")
    for c in track:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"prev_{c}"))
    return seq.where(changed).select(*feed.columns)


def build_history(feed: DataFrame, key: str, ts: str, tiebreak: Sequence[str] = (),
                  track: Sequence[str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """Versioned history of ``feed``: adds ``version`` (bigint, 1..),
    ``date_from`` (= ``ts``), ``date_to`` (next version's time, or
    ``OPEN_END``) and ``is_current``.

    ``track``: when given, a row that repeats the row before it (order: ``ts``,
    ``tiebreak``) in the tracked columns is no new version; when None every
    row is a version, as in the row-by-row loader."""
    order = [ts, *tiebreak]
    rows = changes(feed, key, order, track, num_partitions) if track else feed
    seq = sequence_per_key(rows, [key], order, next_cols=[ts], rn="version", is_last="is_current",
                           num_partitions=num_partitions)
    return (seq.withColumn("date_from", F.col(ts)).withColumn("date_to", F.coalesce(F.col(f"next_{ts}"), open_end()))
               .select(*feed.columns, *ADDED))


def merge_history(history: DataFrame, batch: DataFrame, key: str, ts: str,
                  tiebreak: Sequence[str] = (), num_partitions: int | None = None,
                  load_ts=None) -> DataFrame:
    """New snapshot of ``history`` (columns of ``build_history``) with the feed
    rows of ``batch``: one join, of the history with the batch's keys.

    Versions open and close at event time.  ``load_ts`` (a timestamp text, a
    Column such as ``current_timestamp()``, or None) switches to load-time
    stamping as the row-by-row loader does: the batch's versions follow the
    ones loaded before, open at ``load_ts``, and close the current one then."""
    feed = [c for c in history.columns if c not in ADDED]
    keys = batch.select(F.col(key).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    marked = history.join(keys, history[key].eqNullSafe(keys["_k"]), "left")
    untouched = marked.where(F.col("_hit").isNull()).select(*history.columns)
    old = marked.where(F.col("_hit").isNotNull())
    if load_ts is None:
        rows = old.select(*feed).unionByName(batch.select(*feed))
        rebuilt = build_history(rows, key, ts, tiebreak, num_partitions=num_partitions)
    else:
        stamp = (load_ts if isinstance(load_ts, F.Column) else F.lit(load_ts)).cast("timestamp_ntz")
        rows = (old.select(*feed, "date_from", F.lit(0).alias("_load"))
                   .unionByName(batch.select(*feed, stamp.alias("date_from"), F.lit(1).alias("_load"))))
        seq = sequence_per_key(rows, [key], ["_load", "date_from", ts, *tiebreak], next_cols=["date_from"], rn="version",
                               is_last="is_current", num_partitions=num_partitions)
        rebuilt = seq.withColumn("date_to", F.coalesce("next_date_from", open_end()))
    return untouched.unionByName(rebuilt.select(*history.columns))
