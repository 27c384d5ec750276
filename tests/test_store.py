"""The table writers keep every stored row and column, whatever happens to a load."""

import datetime as dt
import itertools
import random
import threading

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from reelhouse.operators import facts, marts, staging
from reelhouse.plans.catalog import GOLD_PARTITIONS, register_stored, register_tables
from reelhouse.plans.files import Folders
from reelhouse.plans.tables import TableStore, WriteConflict
from reelhouse.sources.csv import read_raw_csv
from reelhouse.sources.fixtures import raw_relations
from tests.conftest import SMALL

FACT = "user_id int, movie_id int, rating double, created_at timestamp, year int"
MART = "movie_id int, total_ratings bigint, avg_rating double, quality_tier string"
WATCHED = ["total_ratings", "avg_rating", "quality_tier"]
T1, T2 = (dt.datetime(2024, m, 1, tzinfo=dt.timezone.utc) for m in (1, 2))


def at(year, second=0):
    return dt.datetime(year, 3, 1, 0, 0, second) if year else None


def ratings(spark, *rows, more="", extra=()):
    return spark.createDataFrame([(u, m, r, at(y), y, *extra) for u, m, r, y in rows], FACT + more)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)


def test_merge_keeps_rows_of_the_null_year(spark, scratch):
    store = TableStore(spark, scratch)
    store.merge_upsert("fact_ratings", ratings(spark, (7, 7, 1.0, None), (1, 1, 1.0, 2000)))
    report = store.merge_upsert("fact_ratings", ratings(spark, (8, 8, 2.0, None)))
    assert rows(store.read("fact_ratings"), "user_id", "year") == [(1, 2000), (7, None), (8, None)]
    assert report.row_count == 3 and report.extra["rows_touched"] == 1 and report.extra["partitions"] == [None]


def test_merge_refuses_updates_outside_the_years_given(spark, scratch):
    store = TableStore(spark, scratch)
    store.merge_upsert("fact_ratings", ratings(spark, (1, 1, 1.0, 2000), (2, 1, 1.0, 2001)))
    with pytest.raises(ValueError, match="2001"):
        store.merge_upsert("fact_ratings", ratings(spark, (3, 1, 1.0, 2000), (4, 1, 1.0, 2001)), years=[2000])
    assert store.read("fact_ratings").count() == 2


def test_evolved_columns_are_read_back(spark, scratch):
    store = TableStore(spark, scratch)
    store.merge_upsert("fact_ratings", ratings(spark, (1, 1, 1.0, 1999), (2, 1, 1.0, 2000)))
    store.merge_upsert("fact_ratings", ratings(spark, (2, 1, 2.0, 2000), more=", note string", extra=("n",)))
    assert rows(store.read("fact_ratings"), "user_id", "note") == [(1, None), (2, "n")]
    name = "snap_mart_movie_analytics"
    store.snapshot(name, spark.createDataFrame([(1, 10, 3.0, "a"), (2, 5, 2.0, "b")], MART), "movie_id", WATCHED, T1)
    store.snapshot(name, spark.createDataFrame([(1, 11, 3.0, "a", 7), (2, 5, 2.0, "b", 8)], MART + ", extra int"), "movie_id", WATCHED, T2)
    store.snapshot(name, spark.createDataFrame([(1, 11, 3.0, "a", 7), (2, 6, 2.0, "b", 9)], MART + ", extra int"), "movie_id", WATCHED, T2)
    assert rows(store.read(name), "movie_id", "total_ratings", "is_current", "extra") == [
        (1, 10, False, None), (1, 11, True, 7), (2, 5, False, None), (2, 6, True, 9)]


def test_a_rerun_with_the_same_clock_keeps_closed_versions(spark, scratch):
    store, name = TableStore(spark, scratch), "snap_mart_movie_analytics"
    load = lambda a, b, ts: store.snapshot(name, spark.createDataFrame([(1, a, 3.0, "x"), (2, b, 3.0, "x")], MART), "movie_id", WATCHED, ts)
    load(10, 5, T1)
    load(11, 5, T2)
    report = load(11, 6, T2)
    assert rows(store.read(name), "movie_id", "total_ratings", "is_current") == [(1, 10, False), (1, 11, True), (2, 5, False), (2, 6, True)]
    assert (report.row_count, report.extra["current_row_count"], report.extra["closed_this_run"]) == (4, 2, 1)


def test_tables_without_success_files_exist(spark, scratch):
    store = TableStore(spark, scratch)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        for user in (1, 2):
            store.merge_upsert("fact_ratings", ratings(spark, (user, 1, 1.0, 2000)))
            store.snapshot("snap_mart_movie_analytics", spark.createDataFrame([(user, 1, 1.0, "x")], MART), "movie_id", WATCHED, T1)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert store.read("fact_ratings").count() == 2 and store.read("snap_mart_movie_analytics").count() == 2


def test_a_repeated_source_key_is_refused(spark, scratch):
    store, name = TableStore(spark, scratch), "snap_mart_movie_analytics"
    store.snapshot(name, spark.createDataFrame([(1, 10, 3.0, "x")], MART), "movie_id", WATCHED, T1)
    with pytest.raises(ValueError, match="several source rows"):
        store.snapshot(name, spark.createDataFrame([(1, 11, 3.0, "x"), (1, 12, 3.0, "x")], MART), "movie_id", WATCHED, T2)
    assert store.read(name).count() == 1


def test_updates_are_evaluated_once_and_staged_files_go(spark, scratch):
    store, seen = TableStore(spark, scratch), spark.sparkContext.accumulator(0)
    store.merge_upsert("fact_ratings", ratings(spark, *[(i, 1, 1.0, 2000 + i % 3) for i in range(50)]))

    @F.udf("double")
    def counted(r):
        seen.add(1)
        return r

    updates = ratings(spark, *[(i, 1, 2.0, 2000 + i % 3) for i in range(100)]).withColumn("rating", counted("rating"))
    folder = spark.sparkContext.getCheckpointDir()
    before = set(Folders(spark).names(folder))
    store.merge_upsert("fact_ratings", updates)
    assert seen.value == 100 and set(Folders(spark).names(folder)) == before
    v = store.version("fact_ratings")
    assert sum(len(store._files("fact_ratings", p, s)) for p, s in v.parts.items()) <= 6


class Died(Exception):
    """The driver ends here."""


STEPS = ("write_note", "put_once", "remove", "names", "data_files")


def crash_points(action):
    """Run ``action`` with the driver ending before each of its file operations in turn, then whole."""
    for k in itertools.count():
        calls, patched = itertools.count(), {}

        def failing(old):
            def step(self, *args):
                if next(calls) == k:
                    raise Died
                return old(self, *args)
            return step
        for name in STEPS:
            patched[name] = getattr(Folders, name)
            setattr(Folders, name, failing(patched[name]))
        try:
            action()
            return
        except Died:
            pass
        finally:
            for name, old in patched.items():
                setattr(Folders, name, old)
        yield k


def test_a_write_that_dies_at_any_step_shows_all_or_nothing(spark, scratch):
    store = TableStore(spark, scratch)
    store.merge_upsert("fact_ratings", ratings(spark, (1, 1, 1.0, 2000), (2, 1, 1.0, 2001)))
    before, seen = [(1, 1.0, 2000, None), (2, 1.0, 2001, None)], 0
    after = [(1, 5.0, 2000, "n"), (2, 1.0, 2001, None), (3, 2.0, 2002, "n")]
    updates = ratings(spark, (1, 1, 5.0, 2000), (3, 1, 2.0, 2002), more=", note string", extra=("n",))
    for _ in crash_points(lambda: store.merge_upsert("fact_ratings", updates)):
        fresh = TableStore(spark, scratch)
        df, v = fresh.read("fact_ratings"), fresh.version("fact_ratings")
        if "note" in df.columns:  # published, and died while tidying up
            assert rows(df, "user_id", "rating", "year", "note") == after and v.row_count == 3
        else:
            assert rows(df.withColumn("note", F.lit(None)), "user_id", "rating", "year", "note") == before and v.row_count == 2
        seen += 1
    assert seen >= 4
    assert rows(store.read("fact_ratings"), "user_id", "rating", "year", "note") == after and store.version("fact_ratings").row_count == 3


def test_every_kind_of_write_that_dies_can_be_run_again(spark, scratch):
    name, store = "snap_mart_movie_analytics", TableStore(spark, scratch)
    load = lambda n, ts: store.snapshot(name, spark.createDataFrame([(1, n, 3.0, "x")], MART), "movie_id", WATCHED, ts)
    load(10, T1)
    for _ in crash_points(lambda: load(11, T2)):
        found = rows(store.read(name), "total_ratings", "is_current")
        assert found in ([(10, True)], [(10, False), (11, True)]) and store.version(name).row_count == len(found)
    assert rows(store.read(name), "total_ratings", "is_current") == [(10, False), (11, True)]
    store.full_refresh("fact_tags", spark.range(2))
    for _ in crash_points(lambda: store.full_refresh("fact_tags", spark.range(5))):
        assert store.read("fact_tags").count() in (2, 5)
    published = store.version("fact_tags").number
    for k in crash_points(lambda: store.append("fact_tags", spark.range(1))):
        v = store.version("fact_tags")
        assert store.read("fact_tags").count() == v.row_count == 5 + v.number - published


def test_readers_keep_their_version_and_change_nothing(spark, scratch):
    store = TableStore(spark, scratch)
    store.merge_upsert("fact_ratings", ratings(spark, (1, 1, 1.0, 2000), (2, 1, 1.0, 2001)))
    old = store.read("fact_ratings")
    files = lambda: sorted(str(p) for p in __import__("pathlib").Path(scratch).rglob("*"))
    before = files()
    assert store.exists("fact_ratings") and store.read("fact_ratings").count() == 2 and files() == before
    store.merge_upsert("fact_ratings", ratings(spark, (1, 1, 5.0, 2000)))
    store.full_refresh("fact_ratings", ratings(spark, (9, 9, 1.0, 2005)))
    assert rows(old, "user_id", "rating") == [(1, 1.0), (2, 1.0)]
    assert rows(store.read("fact_ratings"), "user_id") == [(9,)]
    assert store.vacuum("fact_ratings") == []
    gone = store.vacuum("fact_ratings", dt.timedelta(0))
    assert len(gone) == 4 and rows(store.read("fact_ratings"), "user_id") == [(9,)]  # two writes, two notes


def test_of_two_writers_one_is_refused(spark, scratch):
    store = TableStore(spark, scratch)
    store.merge_upsert("fact_ratings", ratings(spark, (1, 1, 1.0, 2000)))
    other, write = TableStore(spark, scratch), TableStore._write

    def interrupted(self, *args):
        made = write(self, *args)
        if self is store:
            other.append("fact_ratings", ratings(spark, (2, 1, 1.0, 2000)))
        return made

    TableStore._write = interrupted
    try:
        with pytest.raises(WriteConflict):
            store.merge_upsert("fact_ratings", ratings(spark, (3, 1, 1.0, 2000)))
    finally:
        TableStore._write = write
    assert rows(store.read("fact_ratings"), "user_id") == [(1,), (2,)]
    store.merge_upsert("fact_ratings", ratings(spark, (3, 1, 1.0, 2000)))
    assert rows(store.read("fact_ratings"), "user_id") == [(1,), (2,), (3,)]


def test_two_writers_and_a_reader_at_once(spark, scratch):
    store = TableStore(spark, scratch)
    store.merge_upsert("fact_ratings", ratings(spark, (0, 1, 1.0, 2000)))
    wrong, stop = [], threading.Event()

    def write(user):
        mine = TableStore(spark, scratch)
        for second in range(2):
            while True:
                try:
                    mine.append("fact_ratings", ratings(spark, (user, second, 1.0, 2000), (user, second, 2.0, 2001)))
                    break
                except WriteConflict:
                    pass

    def read():
        mine = TableStore(spark, scratch)
        while not stop.is_set():
            found = mine.read("fact_ratings").groupBy("user_id", "movie_id").count().filter("user_id > 0").collect()
            wrong.extend(r for r in found if r["count"] != 2)

    reader, writers = threading.Thread(target=read), [threading.Thread(target=write, args=(u,)) for u in (1, 2)]
    for t in [reader, *writers]:
        t.start()
    for t in writers:
        t.join()
    stop.set()
    reader.join()
    assert not wrong and store.read("fact_ratings").count() == 9 == store.version("fact_ratings").row_count


def test_a_correction_rewrites_the_files_that_hold_its_rows(spark, scratch):
    store = TableStore(spark, scratch)
    many = ratings(spark, *[(u, m, 1.0, y) for y in (2000, 2001) for u in range(40) for m in range(5)])
    for lo in range(0, 40, 10):  # four files a year
        store.append("fact_ratings", many.filter(f"user_id BETWEEN {lo} AND {lo + 9}").coalesce(1))
    files = lambda: {f for p, s in store.version("fact_ratings").parts.items() for f in store._files("fact_ratings", p, s).values()}
    before = files()
    assert len(before) == 8
    report = store.merge_upsert("fact_ratings", ratings(spark, (13, 2, 5.0, 2001)))
    assert (report.extra["files_rewritten"], report.extra["rows_in_rewritten_files"], report.row_count) == (1, 50, 400)
    assert len(before - files()) == 1 and store.read("fact_ratings").count() == 400
    assert rows(store.read("fact_ratings").filter("rating = 5"), "user_id", "movie_id", "year") == [(13, 2, 2001)]
    # new rows only: no file is rewritten
    assert store.merge_upsert("fact_ratings", ratings(spark, (99, 2, 5.0, 2001))).extra["files_rewritten"] == 0
    # duplicate rows of a key in two files are both updated
    store.append("fact_ratings", ratings(spark, (13, 2, 4.0, 2001)))
    assert store.merge_upsert("fact_ratings", ratings(spark, (13, 2, 3.0, 2001))).extra["files_rewritten"] >= 2
    assert rows(store.read("fact_ratings").filter("user_id = 13 AND movie_id = 2 AND year = 2001"), "rating") == [(3.0,), (3.0,)]
    # half of the year's files are to go: the year is rewritten, and no name is kept as gone
    for u in (3, 23, 33):
        store.merge_upsert("fact_ratings", ratings(spark, (u, 2, 5.0, 2001)))
    assert store.version("fact_ratings").parts["year=2001"]["gone"] == []
    n = store.read("fact_ratings").count()
    store.compact("fact_ratings")
    assert store.read("fact_ratings").count() == n == store.version("fact_ratings").row_count == 402
    assert all(len(s["in"]) == 1 for s in store.version("fact_ratings").parts.values())


def clock(k):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=k)


def test_loads_out_of_order_give_the_history_of_loads_in_order(spark, scratch):
    name = "snap_mart_movie_analytics"
    schema = "movie_id int, total_ratings bigint, avg_rating double, quality_tier string, title string"
    for seed in range(6):
        r = random.Random(seed)
        first = {m: r.choice((0, 0, 1, 2, 3)) for m in range(8)}  # each movie's first load; it's in all later ones
        loads = [[(m, r.choice((10, 20)), r.choice((None, 3.0)), "x", f"{m}-{k}") for m, f in first.items() if f <= k] for k in range(4)]
        order = r.sample(range(4), 4)
        if order == sorted(order):
            order.reverse()
        stores = []
        for way, ks in (("late", order), ("right", range(4))):
            store = TableStore(spark, f"{scratch}/{way}{seed}")
            for k in ks:
                store.snapshot(name, spark.createDataFrame(loads[k], schema), "movie_id", WATCHED, clock(k))
            stores.append(store)
        late, right = (s.read(name) for s in stores)
        # the titles aren't watched: where old values return, they're the version's own, not the later load's
        same = ["movie_id", "total_ratings", "avg_rating", "valid_from", "valid_to", "is_current"]
        assert rows(late, *same) == rows(right, *same), (seed, order)
        assert stores[0].version(name).row_count == late.count()
        assert stores[0].version(name).more["current_row_count"] == late.filter("is_current").count()


def test_late_loads_leave_no_overlap_and_no_gap(spark, scratch):
    store, name = TableStore(spark, scratch), "snap_mart_movie_analytics"
    load = lambda n, k: store.snapshot(name, spark.createDataFrame([(1, n, 3.0, "x")], MART), "movie_id", WATCHED, clock(k))
    load(10, 150)
    load(20, 0)  # earlier than all
    found = sorted((x.valid_from, x.valid_to, x.total_ratings, x.is_current) for x in store.read(name).collect())
    day = lambda k: clock(k).replace(tzinfo=None)
    assert found == [(day(0), day(150), 20, False), (day(150), None, 10, True)]
    with pytest.raises(ValueError, match="later ones"):
        load(30, 0)
    before = store.version(name).parts
    load(20, 50)  # as it was: nothing new
    assert store.read(name).count() == 2 and len(store.version(name).parts) == len(before)


def test_a_late_load_reads_only_what_was_closed_later(spark, scratch):
    store, name = TableStore(spark, scratch), "snap_mart_movie_analytics"
    for k in (0, 10, 20, 30):
        store.snapshot(name, spark.createDataFrame([(1, k, 3.0, "x")], MART), "movie_id", WATCHED, clock(k))
    old = {p: s for p, s in store.version(name).parts.items() if "20240111T" in p}
    store.snapshot(name, spark.createDataFrame([(1, 15, 3.0, "x")], MART), "movie_id", WATCHED, clock(15))
    assert len(old) == 1 and all(store.version(name).parts[p] == s for p, s in old.items())
    found = sorted((x.valid_from.day, x.valid_to and x.valid_to.day, x.total_ratings) for x in store.read(name).collect())
    assert found == [(1, 11, 0), (11, 16, 10), (16, 21, 15), (21, 31, 20), (31, None, 30)]


def test_registered_tables_follow_the_store(spark, scratch):
    store, db = TableStore(spark, scratch), "followed"
    try:
        store.merge_upsert("fact_ratings", ratings(spark, (1, 1, 1.0, 1999), (2, 1, 1.0, 2000), (7, 7, 1.0, None)))
        register_stored(spark, db, store, ["fact_ratings"])
        assert rows(spark.table(f"{db}.fact_ratings"), "user_id", "year") == [(1, 1999), (2, 2000), (7, None)]
        store.merge_upsert("fact_ratings", ratings(spark, (2, 1, 2.0, 2000), (3, 1, 2.0, 2001), more=", note string", extra=("n",)))
        register_stored(spark, db, store, ["fact_ratings"])
        assert rows(spark.table(f"{db}.fact_ratings"), "user_id", "rating", "note") == [(1, 1.0, None), (2, 2.0, "n"), (3, 2.0, "n"), (7, 1.0, None)]
        store.full_refresh("fact_ratings", ratings(spark, (5, 1, 1.0, 2003)))  # other partitions, and a column less
        register_stored(spark, db, store, ["fact_ratings"])
        assert rows(spark.table(f"{db}.fact_ratings"), "user_id", "year") == [(5, 2003)]
        name = "snap_mart_movie_analytics"
        for n, more in ((10, ""), (11, ", extra int")):
            df = spark.createDataFrame([(1, n, 3.0, "a", *([7] if more else []))], MART + more)
            store.snapshot(name, df, "movie_id", WATCHED, clock(n))
            register_stored(spark, db, store, [name], GOLD_PARTITIONS)
        table = spark.table(f"{db}.{name}")
        assert rows(table, "total_ratings", "is_current", "extra") == [(10, False, None), (11, True, 7)]
        assert dict(table.dtypes)["is_current"] == "boolean"
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_files_of_another_program_become_a_version(spark, scratch):
    store = TableStore(spark, scratch)
    ratings(spark, (1, 1, 1.0, 2000), (2, 1, 1.0, 2001)).write.partitionBy("year").parquet(store.path("fact_ratings"))
    assert store.exists("fact_ratings") and store.read("fact_ratings").count() == 2
    store.merge_upsert("fact_ratings", ratings(spark, (1, 1, 5.0, 2000)))
    assert rows(store.read("fact_ratings"), "user_id", "rating", "year") == [(1, 5.0, 2000), (2, 1.0, 2001)]


def test_staging_keeps_its_schema_and_appends_add(spark, scratch):
    store = TableStore(spark, scratch)
    store.full_refresh("stg_movies", spark.createDataFrame([(1, "a")], "movie_id int, title string"))
    with pytest.raises(ValueError, match="schema"):
        store.full_refresh("stg_movies", spark.createDataFrame([(1, 2)], "movie_id int, title int"))
    assert store.append("fact_ratings", ratings(spark, (1, 1, 1.0, 2000))).row_count == 1
    report = store.append("fact_ratings", ratings(spark, (1, 1, 1.0, 2000), (2, 1, 1.0, 2001)))
    assert (report.row_count, report.extra["rows_touched"], store.read("fact_ratings").count()) == (3, 2, 3)


def test_a_managed_table_survives_registration(spark, scratch):
    spark.sql(f"CREATE DATABASE kept LOCATION '{scratch}/kept.db'")
    spark.range(3).write.mode("overwrite").saveAsTable("kept.mine")
    spark.range(5).write.parquet(scratch + "/other")
    with pytest.raises(ValueError, match="managed"):
        register_tables(spark, "kept", {"mine": scratch + "/other"})
    assert spark.table("kept.mine").count() == 3
    for path, n in (("/other", 5), ("/second", 7)):
        spark.range(n).write.mode("overwrite").parquet(scratch + path)
        register_tables(spark, "kept", {"outside": scratch + path})
        assert spark.table("kept.outside").count() == n
    spark.sql("DROP DATABASE kept CASCADE")


def test_csv_columns_go_by_name(spark, scratch):
    with open(scratch + "/movies.csv", "w") as f:
        f.write("title,movieId,genres\nToy (1995),1,Drama\n")
    assert read_raw_csv(spark, scratch + "/movies.csv", "movies").first().asDict() == {"movieId": "1", "title": "Toy (1995)", "genres": "Drama"}
    with open(scratch + "/links.csv", "w") as f:
        f.write("movieId,imdb,tmdbId\n1,2,3\n")
    with pytest.raises(ValueError, match="imdbId"):
        read_raw_csv(spark, scratch + "/links.csv", "links")


def test_an_epoch_out_of_range_is_null(spark):
    raw = spark.createDataFrame([("1", "1", "4", x) for x in ("1600000000000000", "-99999999999999", "x", "964982703")],
                                "userId string, movieId string, rating string, timestamp string")
    assert [r.created_at for r in staging.stg_ratings(raw).collect()] == [None, None, None, dt.datetime(2000, 7, 30, 18, 45, 3)]


def test_joins_give_the_same_rows_with_and_without_broadcasts(spark):
    names = ["fact_ratings", "fact_tags", "mart_user_behavior", "mart_genre_performance", "win_top1"]
    run = lambda: {n: rows(E.queries()[n](spark, SMALL)) for n in names}
    small = run()
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        plan = E.queries()["mart_user_behavior"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert run() == small
    finally:
        for k in off:
            spark.conf.unset(k)


def test_checks_never_join_the_raw_fact(spark):
    stg = staging.staging(raw_relations(spark, SMALL))
    fact = stg["stg_ratings"].withColumn("year", F.year("created_at"))
    from reelhouse.operators import checks
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a broadcast needs no aggregation first
    try:
        plan = checks.check_fact_ratings_movie_fk(fact, stg["stg_movies"])._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("Join LeftAnti") < plan.index("Aggregate [movie_id")


def test_orders(spark):
    users = [r.user_id for r in E.queries()["sort_users"](spark, SMALL).collect()]
    assert users == sorted(users, key=lambda u: (u is not None, u))
    top = [(-r.total_ratings, r.movie_id) for r in E.queries()["report_top_movies"](spark, SMALL).collect()]
    assert top == sorted(top) and len(top) == 20


def test_a_rollup_of_a_rollup_has_the_same_figures(spark):
    df = spark.createDataFrame([(u, m, r / 2, at(2000)) for u, m, r in ((1, 1, 3), (1, 1, 4), (1, 2, 9), (2, 2, 5))],
                               "user_id int, movie_id int, rating double, created_at timestamp")
    both = facts.rolled_up(facts.rating_rollup(df, "user_id", "movie_id"), "user_id").withColumn("d", facts.deviation())
    got = {r.user_id: (r.n, r.s, r.d) for r in both.collect()}
    assert got[1][:2] == (3, 8.0) and abs(got[1][2] - 1.6072751268) < 1e-9 and got[2] == (1, 2.5, None)
    assert marts.GENRE_MART_COLUMNS[0] == "genres"
