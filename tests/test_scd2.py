import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from starloom.operators.scd2 import OPEN_END, build_history, merge_history

T0 = dt.datetime(2024, 1, 1)
END = dt.datetime.strptime(OPEN_END, "%Y-%m-%d %H:%M:%S")


def _feed(spark, data):
    return spark.createDataFrame(data, "territory string, ts timestamp_ntz, id int, votes int")


def _h(i):
    return T0 + dt.timedelta(hours=i)


def test_build_history_versions_and_intervals(spark):
    feed = _feed(spark, [("A", _h(0), 1, 10), ("A", _h(2), 2, 12), ("A", _h(1), 3, 11), ("B", _h(5), 4, 7)])
    h = build_history(feed, "territory", "ts", ["id"])
    got = rows(h, "territory", "version", "date_from", "date_to", "is_current")
    assert got == [("A", 1, _h(0), _h(1), False), ("A", 2, _h(1), _h(2), False), ("A", 3, _h(2), END, True),
                   ("B", 1, _h(5), END, True)]


def test_history_one_current_no_overlap(spark):
    data = [(f"T{i % 4}", _h(i), i, i) for i in range(40)]
    h = build_history(_feed(spark, data), "territory", "ts", ["id"])
    cur = h.groupBy("territory").agg(F.count_if("is_current").alias("c")).collect()
    assert all(r.c == 1 for r in cur)
    by = {}
    for r in h.collect():
        by.setdefault(r.territory, []).append((r.date_from, r.date_to))
    for spans in by.values():
        spans.sort()
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_change_detection(spark):
    feed = _feed(spark, [("A", _h(0), 1, 10), ("A", _h(1), 2, 10), ("A", _h(2), 3, 11), ("A", _h(3), 4, None),
                         ("A", _h(4), 5, None)])
    h = build_history(feed, "territory", "ts", ["id"], track=["votes"])
    assert rows(h, "version", "votes", "date_from") == [(1, 10, _h(0)), (2, 11, _h(2)), (3, None, _h(3))]


def test_merge_batchwise_equals_build(spark):
    data = [(f"T{i % 5}", _h(i), i, i % 3) for i in range(60)]
    feed = _feed(spark, data)
    full = build_history(feed, "territory", "ts", ["id"])
    cut1, cut2 = _h(20), _h(41)
    h = build_history(feed.where(F.col("ts") < cut1), "territory", "ts", ["id"])
    h = merge_history(h, feed.where((F.col("ts") >= cut1) & (F.col("ts") < cut2)), "territory", "ts", ["id"])
    h = merge_history(h, feed.where(F.col("ts") >= cut2), "territory", "ts", ["id"])
    cols = ["territory", "id", "version", "date_from", "date_to", "is_current"]
    assert rows(h, *cols) == rows(full, *cols)


def test_merge_new_key_and_untouched_key(spark):
    old = build_history(_feed(spark, [("A", _h(0), 1, 1), ("B", _h(0), 2, 1)]), "territory", "ts", ["id"])
    new = merge_history(old, _feed(spark, [("A", _h(3), 3, 2), ("C", _h(4), 4, 5)]), "territory", "ts", ["id"])
    got = rows(new, "territory", "version", "date_to", "is_current")
    assert got == [("A", 1, _h(3), False), ("A", 2, END, True), ("B", 1, END, True), ("C", 1, END, True)]


def test_merge_empty_batch_is_identity(spark):
    old = build_history(_feed(spark, [("A", _h(0), 1, 1), ("A", _h(1), 2, 1)]), "territory", "ts", ["id"])
    new = merge_history(old, _feed(spark, []), "territory", "ts", ["id"])
    assert rows(new) == rows(old.select(*new.columns))


def test_merge_with_load_time(spark):
    old = build_history(_feed(spark, [("A", _h(0), 1, 1)]), "territory", "ts", ["id"])
    new = merge_history(old, _feed(spark, [("A", _h(5), 2, 2), ("B", _h(6), 3, 3)]), "territory", "ts", ["id"],
                        load_ts="2030-01-01 12:00:00")
    at = dt.datetime(2030, 1, 1, 12)
    assert rows(new, "territory", "version", "date_from", "date_to", "is_current") == [
        ("A", 1, _h(0), at, False), ("A", 2, at, END, True), ("B", 1, at, END, True)]


def test_change_detection_with_equal_times(spark):
    feed = _feed(spark, [("A", _h(0), 1, 1), ("A", _h(1), 2, 1), ("A", _h(1), 3, 2), ("B", _h(1), 4, 2), ("B", _h(1), 5, 2)])
    h = build_history(feed, "territory", "ts", ["id"], track=["votes"])
    assert rows(h, "territory", "id", "version", "votes") == [("A", 1, 1, 1), ("A", 3, 2, 2), ("B", 4, 1, 2)]


def test_merge_late_rows_equal_full_build(spark):
    data = [(f"T{i % 3}", _h((7 * i) % 40), i, i) for i in range(40)]
    feed = _feed(spark, data)
    h = build_history(feed.where("id >= 30"), "territory", "ts", ["id"])
    for lo, hi in ((10, 20), (0, 10), (20, 30)):
        h = merge_history(h, feed.where(f"id >= {lo} AND id < {hi}"), "territory", "ts", ["id"])
    cols = ["territory", "id", "version", "date_from", "date_to", "is_current"]
    assert rows(h, *cols) == rows(build_history(feed, "territory", "ts", ["id"]), *cols)
    assert h.where("date_to < date_from").count() == 0
