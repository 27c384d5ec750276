"""Upsert behaviour."""

import datetime as dt

import pytest

from reelhouse.operators.upsert import multi_matched_keys, upsert
from reelhouse.plans.tables import TableStore

SCHEMA = "user_id int, movie_id int, rating double, created_at timestamp, year int"


def ts(y, s=0):
    return dt.datetime(y, 3, 1, 0, 0, s)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_update_insert_keep(spark):
    target = frame(spark, [(1, 1, 3.0, ts(2000), 2000), (2, 1, 4.0, ts(2000), 2000)])
    updates = frame(spark, [(1, 1, 3.5, ts(2000), 2000), (3, 1, 1.0, ts(2001), 2001)])
    got = rows(upsert(target, updates))
    assert got == sorted([(1, 1, 3.5, ts(2000), 2000), (2, 1, 4.0, ts(2000), 2000),
                          (3, 1, 1.0, ts(2001), 2001)])


def test_null_keys_never_match(spark):
    target = frame(spark, [(None, 1, 3.0, ts(2000), 2000)])
    updates = frame(spark, [(None, 1, 5.0, ts(2000), 2000)])
    assert len(rows(upsert(target, updates))) == 2


def test_duplicate_target_keys_all_updated(spark):
    target = frame(spark, [(1, 1, 3.0, ts(2000), 2000), (1, 1, 2.0, ts(2000), 2000)])
    updates = frame(spark, [(1, 1, 5.0, ts(2000), 2000)])
    assert [r[2] for r in rows(upsert(target, updates))] == [5.0, 5.0]


def test_unmatched_duplicate_updates_both_inserted(spark):
    target = frame(spark, [(9, 9, 3.0, ts(2000), 2000)])
    updates = frame(spark, [(1, 1, 5.0, ts(2000), 2000), (1, 1, 4.0, ts(2000), 2000)])
    assert len(rows(upsert(target, updates))) == 3
    assert multi_matched_keys(target, updates).count() == 0


def test_multi_match_detected(spark):
    target = frame(spark, [(1, 1, 3.0, ts(2000), 2000)])
    updates = frame(spark, [(1, 1, 5.0, ts(2000), 2000), (1, 1, 4.0, ts(2000), 2000)])
    assert multi_matched_keys(target, updates).count() == 1


def test_schema_evolution_keeps_target_only_column(spark):
    target = frame(spark, [(1, 1, 3.0, ts(2000), 2000, "a"), (2, 2, 3.0, ts(2000), 2000, "b")],
                   SCHEMA + ", note string")
    updates = frame(spark, [(1, 1, 4.0, ts(2000), 2000, 7)], SCHEMA + ", extra int")
    got = {r.user_id: r for r in upsert(target, updates).collect()}
    assert got[1].note == "a" and got[1].rating == 4.0 and got[1].extra == 7
    assert got[2].note == "b" and got[2].extra is None


def test_rerun_is_idempotent(spark):
    target = frame(spark, [(1, 1, 3.0, ts(2000), 2000)])
    updates = frame(spark, [(1, 1, 3.5, ts(2000), 2000), (2, 2, 1.0, ts(2001), 2001)])
    once = upsert(target, updates)
    assert rows(upsert(once, updates)) == rows(once)


def test_store_merge_rewrites_only_affected_partitions(spark, scratch):
    store = TableStore(spark, scratch)
    first = frame(spark, [(1, 1, 3.0, ts(1999), 1999), (2, 1, 4.0, ts(2000), 2000)])
    store.merge_upsert("fact_ratings", first)
    later = frame(spark, [(2, 1, 2.5, ts(2000), 2000), (3, 3, 1.0, ts(2001), 2001)])
    rep = store.merge_upsert("fact_ratings", later)
    assert rep.row_count == 3
    assert rep.extra["partitions"] == [2000, 2001]
    got = rows(store.read("fact_ratings").select("user_id", "movie_id", "rating", "created_at",
                                                 "year"))
    assert got == sorted([(1, 1, 3.0, ts(1999), 1999), (2, 1, 2.5, ts(2000), 2000),
                          (3, 3, 1.0, ts(2001), 2001)])


def test_store_merge_refuses_multi_match(spark, scratch):
    store = TableStore(spark, scratch)
    store.merge_upsert("fact_ratings", frame(spark, [(1, 1, 3.0, ts(2000), 2000)]))
    dup = frame(spark, [(1, 1, 5.0, ts(2000), 2000), (1, 1, 4.0, ts(2000), 2000)])
    with pytest.raises(ValueError):
        store.merge_upsert("fact_ratings", dup)


def test_store_merge_takes_equal_updates_as_one(spark, scratch):
    store = TableStore(spark, scratch)
    first = [(1, 1, 3.0, ts(2000), 2000)] * 3 + [(2, 1, 4.0, ts(2000), 2000), (None, 1, 2.0, ts(2000), 2000)]
    store.merge_upsert("fact_ratings", frame(spark, first))
    new = [(1, 1, 5.0, ts(2000), 2000)] * 2 + [(3, 3, 1.0, ts(2001), 2001)] * 2 + [(None, 1, 2.0, ts(2000), 2000)] * 2
    rep = store.merge_upsert("fact_ratings", frame(spark, new))
    got = store.read("fact_ratings").select("user_id", "movie_id", "rating", "created_at", "year")
    want = [(1, 1, 5.0, ts(2000), 2000)] * 3 + [first[3], first[4]] + new[2:]
    assert sorted(map(str, rows_of(got))) == sorted(map(str, want)) and rep.row_count == len(want)


def test_store_merge_of_a_load_that_repeats_rows_changes_nothing(spark, scratch):
    store = TableStore(spark, scratch)
    load = frame(spark, [(1, 1, 3.0, ts(2000), 2000)] * 2 + [(2, 1, 4.0, ts(2000), 2000)])
    for _ in range(3):
        store.merge_upsert("fact_ratings", load, years=(2000,))
    assert rows(store.read("fact_ratings").select(*load.columns)) == rows(load)


def test_store_merge_of_a_load_with_several_ratings_of_a_key(spark, scratch):
    store = TableStore(spark, scratch)
    first = [(1, 1, 3.0, ts(2000), 2000)] * 2 + [(1, 1, 4.0, ts(2000), 2000), (2, 1, 4.0, ts(2000), 2000)] + [(3, 1, 2.0, ts(2000), 2000)] * 2
    store.merge_upsert("fact_ratings", frame(spark, first))
    new = [(u, m, r + 0.5, t, y) for u, m, r, t, y in first] + [(4, 1, 1.0, ts(2000), 2000), (4, 1, 2.0, ts(2000), 2000)]
    for _ in range(2):
        rep = store.merge_upsert("fact_ratings", frame(spark, new))
        assert rows(store.read("fact_ratings").select(*SCHEMA.replace(",", "").split()[::2])) == sorted(new) and rep.row_count == len(new)


def test_store_merge_refuses_what_it_would_have_to_guess(spark, scratch):
    store, key = TableStore(spark, scratch), (1, 1, 3.0, ts(2000), 2000)
    store.merge_upsert("fact_ratings", frame(spark, [(*key, "a"), (*key, "b"), (2, *key[1:], "c"), (2, *key[1:], "c")], SCHEMA + ", note string"))
    for user, ratings in ((1, (1.0, 2.0)), (2, (1.0, 2.0, 2.0))):
        with pytest.raises(ValueError):
            store.merge_upsert("fact_ratings", frame(spark, [(user, 1, r, ts(2000), 2000) for r in ratings]))
    store.merge_upsert("fact_ratings", frame(spark, [(2, 1, 1.0, ts(2000), 2000), (2, 1, 2.0, ts(2000), 2000)]))
    assert sorted((r.rating, r.note) for r in store.read("fact_ratings").filter("user_id = 2").collect()) == [(1.0, "c"), (2.0, "c")]


def rows_of(df):
    return [tuple(r) for r in df.collect()]
