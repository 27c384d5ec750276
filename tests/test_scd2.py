"""SCD2 behaviour."""

import datetime as dt

from pyspark.sql import functions as F

from reelhouse.operators.scd2 import scd2_merge
from reelhouse.plans.tables import TableStore

T1 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
T2 = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
T3 = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
SRC = "movie_id int, total_ratings bigint, avg_rating double, quality_tier string, title string"
COLS = ["total_ratings", "avg_rating", "quality_tier"]


def src(spark, data):
    return spark.createDataFrame(data, SRC)


def by_key(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.movie_id, []).append(r)
    for v in out.values():
        v.sort(key=lambda r: r.valid_from)
    return out


def test_first_load_unchanged_changed_new_gone(spark):
    h1 = scd2_merge(None, src(spark, [(1, 10, 3.0, "Average", "a"), (2, 5, 2.0, "Below", "b"),
                                      (3, 1, 1.0, "Poor", "c")]), "movie_id", COLS, T1)
    assert h1.filter("is_current").count() == 3
    s2 = src(spark, [(1, 10, 3.0, "Average", "renamed"), (2, 6, 2.0, "Below", "b"),
                     (4, 1, 5.0, "Excellent", "d")])
    h2 = by_key(scd2_merge(h1, s2, "movie_id", COLS, T2))
    # unchanged: one version, untracked column change ignored
    assert len(h2[1]) == 1 and h2[1][0].title == "a" and h2[1][0].is_current
    # changed: closed at T2, new version from T2
    old, new = h2[2]
    assert (old.is_current, new.is_current) == (False, True)
    assert old.valid_to == new.valid_from == T2.replace(tzinfo=None)
    assert new.total_ratings == 6 and new.valid_to is None
    # gone from the source: stays current
    assert len(h2[3]) == 1 and h2[3][0].is_current
    # new key
    assert len(h2[4]) == 1 and h2[4][0].valid_from == T2.replace(tzinfo=None)


def test_null_to_value_counts_as_change_and_rerun_is_noop(spark):
    h1 = scd2_merge(None, src(spark, [(1, 10, None, "Average", "a")]), "movie_id", COLS, T1)
    s2 = src(spark, [(1, 10, 3.0, "Average", "a")])
    h2 = scd2_merge(h1, s2, "movie_id", COLS, T2)
    assert h2.count() == 2
    h3 = scd2_merge(h2, s2, "movie_id", COLS, T3)
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(map(tuple, h3.collect()), key=key) == sorted(map(tuple, h2.collect()), key=key)


def test_store_snapshot_reports(spark, scratch):
    store = TableStore(spark, scratch)
    s1 = src(spark, [(1, 10, 3.0, "Average", "a"), (2, 5, 2.0, "Below", "b")])
    r1 = store.snapshot("snap_mart_movie_analytics", s1, "movie_id", COLS, T1)
    assert (r1.row_count, r1.extra["current_row_count"]) == (2, 2)
    s2 = src(spark, [(1, 11, 3.0, "Average", "a"), (2, 5, 2.0, "Below", "b")])
    r2 = store.snapshot("snap_mart_movie_analytics", s2, "movie_id", COLS, T2)
    assert (r2.row_count, r2.extra["current_row_count"]) == (3, 2)
    r3 = store.snapshot("snap_mart_movie_analytics", s2, "movie_id", COLS, T3)
    assert (r3.row_count, r3.extra["current_row_count"]) == (3, 2)
    assert store.read("snap_mart_movie_analytics").filter(~F.col("is_current")).count() == 1


def test_source_gains_a_column(spark):
    h1 = scd2_merge(None, src(spark, [(1, 10, 3.0, "Average", "a"), (2, 5, 2.0, "Below", "b")]),
                    "movie_id", COLS, T1)
    s2 = spark.createDataFrame([(1, 10, 3.0, "Average", "a", 7), (2, 6, 2.0, "Below", "b", 8)],
                               SRC + ", extra int")
    h2 = by_key(scd2_merge(h1, s2, "movie_id", COLS, T2))
    # unchanged row keeps its stored version (extra stays NULL); the changed
    # key's new version carries the new column
    assert len(h2[1]) == 1 and h2[1][0].extra is None
    old, new = h2[2]
    assert old.extra is None and new.extra == 8 and new.is_current
