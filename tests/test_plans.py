"""Physical-plan properties the scale design relies on."""

import datetime as dt


from reelhouse.operators import facts
from reelhouse.plans.tables import TableStore


def plan(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _stored(spark, scratch):
    store = TableStore(spark, scratch)
    ratings = spark.createDataFrame(
        [(u, m, 0.5 + (u + m) % 10 / 2, dt.datetime(1995 + (u % 10), 1 + m % 12, 1), )
         for u in range(50) for m in range(20)],
        "user_id int, movie_id int, rating double, created_at timestamp")
    store.full_refresh("stg_ratings", ratings)
    dim = spark.createDataFrame([(m, f"t{m}", 2000, "drama", 1) for m in range(10)],
                                "movie_id int, title string, year int, genres string, genre_count bigint")
    store.full_refresh("dim_movies", dim)
    return store


def test_year_filter_reaches_parquet_and_columns_are_pruned(spark, scratch):
    store = _stored(spark, scratch)
    fr = facts.fact_ratings(store.read("stg_ratings"), store.read("dim_movies"), None, [1996, 1997])
    p = plan(fr.select("movie_id", "rating"))
    scan = p[p.index("Scan parquet"):]
    pushed = [line for line in scan.splitlines() if line.startswith("PushedFilters")][0]
    assert "GreaterThanOrEqual(created_at,1996-01-01" in pushed
    assert "LessThan(created_at,1998-01-01" in pushed
    assert "GreaterThanOrEqual(rating,0.5)" in pushed
    schema = [line for line in scan.splitlines() if line.startswith("ReadSchema")][0]
    fields = schema.split("struct<", 1)[1].rstrip(">").split(",")
    # user_id (NULL filter), movie_id, rating, created_at (year filter)
    assert sorted(f.split(":")[0] for f in fields) == ["created_at", "movie_id", "rating", "user_id"]


def test_the_fact_is_never_shuffled_to_look_up_its_keys(spark, scratch):
    store = _stored(spark, scratch)
    store.full_refresh("dim_users", spark.range(30).selectExpr("cast(id AS int) AS user_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # whatever the dimension's size
    try:
        p = plan(facts.fact_ratings(store.read("stg_ratings"), store.read("dim_movies"), store.read("dim_users")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert p.count("BroadcastHashJoin Inner BuildRight") == 2 and "SortMergeJoin" not in p
    tree = p.split("\n\n")[0]
    assert tree.count("Exchange hashpartitioning") + tree.count("- Exchange (") == 2  # the id sets' own


def test_snapshot_reads_only_current_partition(spark, scratch):
    store, name = TableStore(spark, scratch), "snap_mart_movie_analytics"
    for n in (10, 11):
        s = spark.createDataFrame([(1, n)], "movie_id int, total_ratings bigint")
        store.snapshot(name, s, "movie_id", ["total_ratings"], dt.datetime(2024, 1, n))
    files = store.read_history(name, current_only=True).inputFiles()
    assert files and all("is_current=true" in f for f in files)
    assert any("is_current=false" in f for f in store.read(name).inputFiles())
