"""Per-key sequences (number in the key, neighbours, last-row flag) that stay
balanced when one key holds a large share of the rows.

A ``Window.partitionBy(key)`` is one exchange, but sends every row of a key to
one task.  Keys with more rows than a task should hold are counted first (a
pre-aggregated count per key); all others go through such windows.  The rows of
the large keys are stored in ranges of ``(key, order…)``, which cut a key across
many ranges.  Windows run inside a range; what a key has in other ranges comes
from tables with one row per range: its head and tail row, and first and last
position of the keys that cross a border.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.keys import PART, PLACE, numbered, ranged
from starloom.session import scratch_path

#: Rows of one key that a task may hold.
KEY_ROWS = 1 << 21


def large_keys(df: DataFrame, keys: Sequence[str], key_rows: int, counted: str | None = None) -> DataFrame | None:
    """Keys with more than ``key_rows`` rows, stored; None if there are none.
    ``counted``: ``df`` has one row for each key, with its rows in that column."""
    counts = df.withColumnRenamed(counted, "_sq_n") if counted else df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_sq_n"))
    if (counts.agg(F.max("_sq_n")).first()[0] or 0) <= key_rows:
        return None
    large = counts.where(F.col("_sq_n") > key_rows).select(*[F.col(k).alias(f"_sq_k{i}") for i, k in enumerate(keys)])
    path = scratch_path(df.sparkSession, "large-keys")
    large.write.parquet(path)
    return df.sparkSession.read.schema(large.schema).parquet(path)


def sequence_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                     next_cols: Sequence[str] = (), prev_cols: Sequence[str] = (), rn: str | None = None,
                     size: str | None = None, is_last: str | None = None, is_first: str | None = None,
                     num_partitions: int | None = None, key_rows: int = KEY_ROWS) -> DataFrame:
    """Add, each only when asked: ``rn`` (1-based number inside the key, in
    ``order``), the group ``size``, ``is_first`` and ``is_last`` flags,
    ``next_<c>`` / ``prev_<c>`` for ``next_cols`` / ``prev_cols`` (null at the
    key's end / start).  Null keys are one key.  Rows that tie in ``order``
    have the order of a hash of the row; equal rows are interchangeable."""
    keys = list(keys)
    hashable = [f.name for f in df.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    order = [*order, "_sq_tie"]
    added = [*[f"next_{c}" for c in next_cols], *[f"prev_{c}" for c in prev_cols], *[c for c in (rn, size, is_last, is_first) if c]]
    rows = df.withColumn("_sq_tie", F.xxhash64(*[F.col(f"`{c}`") for c in hashable]))
    asked = (keys, order, list(next_cols), list(prev_cols), rn, size, is_last, is_first, num_partitions)
    large = large_keys(df, keys, key_rows)
    if large is None:
        return _in_windows(rows, *asked).select(*df.columns, *added)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_sq_k{i}"))
    small = _in_windows(rows.join(large, same, "left_anti"), *asked).select(*df.columns, *added)
    return small.unionByName(_in_ranges(rows.join(large, same, "left_semi"), *asked).select(*df.columns, *added))


def _in_windows(df: DataFrame, keys: list[str], order: list[str], next_cols: list[str], prev_cols: list[str], rn: str | None,
                size: str | None, is_last: str | None, is_first: str | None, num_partitions: int | None) -> DataFrame:
    """One exchange by key, one sort; each key in one task."""
    if num_partitions:
        df = df.repartition(num_partitions, *keys)
    place = Window.partitionBy(*keys).orderBy(*order)
    columns: dict[str, Column] = {f"next_{c}": F.lead(c).over(place) for c in next_cols}
    columns |= {f"prev_{c}": F.lag(c).over(place) for c in prev_cols}
    if rn:
        columns[rn] = F.row_number().over(place).cast("bigint")
    if is_first:
        columns[is_first] = F.row_number().over(place) == 1
    if is_last:
        columns[is_last] = F.lead(F.lit(1)).over(place).isNull()
    if size:
        columns[size] = F.count(F.lit(1)).over(Window.partitionBy(*keys)).cast("bigint")
    return df.select("*", *[c.alias(name) for name, c in columns.items()])


def _in_ranges(df: DataFrame, keys: list[str], order: list[str], next_cols: list[str], prev_cols: list[str], rn: str | None,
               size: str | None, is_last: str | None, is_first: str | None, num_partitions: int | None) -> DataFrame:
    """Two exchanges, by range and of stored ranges; keys cut across tasks."""
    stored = numbered(ranged(df, [*keys, *order], num_partitions), "_sq_pos")
    carried = list(dict.fromkeys([*keys, *next_cols, *prev_cols]))
    row = F.struct(*[F.col(c).alias(c) for c in carried])
    inside = Window.partitionBy(PART).orderBy(PLACE)
    edges = stored.groupBy(PART).agg(F.min_by(row, F.col(PLACE)).alias("head"), F.max_by(row, F.col(PLACE)).alias("tail"))
    by_range = Window.orderBy(PART)
    edges = edges.select(PART, F.col("head").alias("_sq_head"), F.col("tail").alias("_sq_tail"),
                         F.lag("tail").over(by_range).alias("_sq_before"), F.lead("head").over(by_range).alias("_sq_after"))
    # edges: as many rows as ranges, that is at most spark.sql.shuffle.partitions
    out = (stored.withColumn("_sq_prev", F.lag(row).over(inside)).withColumn("_sq_next", F.lead(row).over(inside))
                 .join(F.broadcast(edges.select(PART, "_sq_before", "_sq_after")), PART)
                 .withColumn("_sq_prev", F.coalesce("_sq_prev", "_sq_before"))
                 .withColumn("_sq_next", F.coalesce("_sq_next", "_sq_after")))

    def same(other: str):
        out = F.col(other).isNotNull()
        for k in keys:
            out = out & F.col(k).eqNullSafe(F.col(other)[k])
        return out

    for c in next_cols:
        out = out.withColumn(f"next_{c}", F.when(same("_sq_next"), F.col("_sq_next")[c]))
    for c in prev_cols:
        out = out.withColumn(f"prev_{c}", F.when(same("_sq_prev"), F.col("_sq_prev")[c]))
    if is_last:
        out = out.withColumn(is_last, ~same("_sq_next"))
    if is_first:
        out = out.withColumn(is_first, ~same("_sq_prev"))
    if rn or size:
        of_key = Window.partitionBy(PART, *keys)
        out = out.withColumn("_sq_lo", F.min("_sq_pos").over(of_key)).withColumn("_sq_hi", F.max("_sq_pos").over(of_key))
        crossing = edges.where(F.struct(*[F.col("_sq_head")[k] for k in keys]).eqNullSafe(F.struct(*[F.col("_sq_before")[k] for k in keys])))
        crossing = crossing.select(*[F.col("_sq_head")[k].alias(f"_sq_k{i}") for i, k in enumerate(keys)]).distinct()
        cond = F.lit(True)
        for i, k in enumerate(keys):
            cond = cond & F.col(k).eqNullSafe(F.col(f"_sq_k{i}"))
        # at most one key per border
        whole = (stored.select(*keys, "_sq_pos").join(F.broadcast(crossing), cond)
                       .groupBy(*[f"_sq_k{i}" for i in range(len(keys))])
                       .agg(F.min("_sq_pos").alias("_sq_first"), F.max("_sq_pos").alias("_sq_last")))
        out = out.join(F.broadcast(whole), cond, "left")
        first, last = F.coalesce("_sq_first", "_sq_lo"), F.coalesce("_sq_last", "_sq_hi")
        if rn:
            out = out.withColumn(rn, (F.col("_sq_pos") - first + 1).cast("bigint"))
        if size:
            out = out.withColumn(size, (last - first + 1).cast("bigint"))
    return out


def group_starts(df: DataFrame, key: str) -> DataFrame:
    """(_gk, _gk_before, _gk_n) for every value of ``key``, null too: rows with
    smaller values and its own rows.  Counts are stored in ranges; what lies in
    earlier ranges comes from a table with one row per range."""
    stored = ranged(df.groupBy(F.col(key).alias("_gk")).agg(F.count(F.lit(1)).alias("_gk_n")), ["_gk"])
    sizes = stored.groupBy(PART).agg(F.sum("_gk_n").alias("_n"))
    earlier = sizes.select(PART, (F.sum("_n").over(Window.orderBy(PART)) - F.col("_n")).alias("_gk_earlier"))
    inside = F.sum("_gk_n").over(Window.partitionBy(PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_gk_n")
    # as many rows as ranges, that is at most spark.sql.shuffle.partitions
    starts = stored.withColumn("_gk_inside", inside).join(F.broadcast(earlier), PART)
    return starts.select("_gk", (F.col("_gk_earlier") + F.col("_gk_inside")).alias("_gk_before"), "_gk_n")


def grouped_key(df: DataFrame, order: Sequence[str], name: str, is_last: str | None = None,
                source: DataFrame | None = None, key_rows: int = KEY_ROWS) -> DataFrame:
    """The numbers of ``dense_key`` over a total ``order`` whose first column
    has many values: rows with smaller values plus the place among the rows of
    its own.  Rows pass one exchange, by that column, which later joins by it
    share; only rows of values with more than ``key_rows`` rows go through
    stored ranges.  ``is_last`` names a flag for the last row of each value,
    ``source`` a frame that has as many rows of each value and is cheaper to
    count.  Runs the jobs that count now."""
    first, rest = order[0], list(order[1:])
    starts = group_starts(df if source is None else source, first)
    large = large_keys(starts.select(F.col("_gk").alias(first), "_gk_n"), [first], key_rows, "_gk_n")
    place = F.row_number().over(Window.partitionBy(first).orderBy(*rest)).cast("bigint")
    if large is None:
        out = df.withColumn("_gk_place", place)
    else:
        same = F.col(first).eqNullSafe(F.col("_sq_k0"))
        out = df.join(large, same, "left_anti").withColumn("_gk_place", place).unionByName(
            sequence_per_key(df.join(large, same, "left_semi"), [first], rest, rn="_gk_place", key_rows=key_rows))
    # null finds no row: it comes before all values
    out = out.join(starts, F.col(first) == F.col("_gk"), "left")
    number = F.coalesce("_gk_before", F.lit(0).cast("bigint")) + F.col("_gk_place")
    if not is_last:
        return out.select(number.alias(name), *df.columns)
    nulls = starts.where(F.col("_gk").isNull()).agg(F.sum("_gk_n")).first()[0] or 0
    last = F.col("_gk_place") == F.coalesce("_gk_n", F.lit(nulls).cast("bigint"))
    return out.select(number.alias(name), *df.columns, last.alias(is_last))


def flag_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``name`` is true on the last row of every key in ``order``.  The maximum
    of ``struct(order…)`` per key comes from an aggregation (partial on the map
    side, so a hot key is reduced before the shuffle) and is joined back.
    ``order`` must be a total order inside the key: end it with a unique id."""
    keys = list(keys)
    tup = F.struct(*[F.col(c) for c in order])
    last = df.groupBy(*keys).agg(F.max(tup).alias("_fl_max"))
    last = last.select(*[F.col(k).alias(f"_fl_k{i}") for i, k in enumerate(keys)], "_fl_max")
    cond = [df[k].eqNullSafe(last[f"_fl_k{i}"]) for i, k in enumerate(keys)]
    out = df.join(last, cond, "left")
    return out.withColumn(name, F.coalesce(tup.eqNullSafe(F.col("_fl_max")), F.lit(False))) \
              .drop("_fl_max", *[f"_fl_k{i}" for i in range(len(keys))])
