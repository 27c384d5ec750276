"""Queries that build several tables of the fact read its sources once; generated code stays within HotSpot's limit."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import marts
from reelhouse.plans.queries import Layers, registry
from reelhouse.session import CODEGEN_LIMIT, HOTSPOTS_LIMIT, SPARKS_LIMIT, ensure_session_defaults


@pytest.fixture()
def tables(spark, scratch):
    part = [(k, f"big part{k}", "steel" if k % 2 else "tin") for k in range(1, 9)]
    orders = [(k, 20 + k % 5) for k in range(40)]
    lines = [(k, 1 + (k + n) % 8, n, 5.0 + n, dt.datetime(1996 + k % 6, 1 + n, 3)) for k in range(40) for n in range(1, 4)]
    events = [(k, dt.datetime(2000, 1, 1), 2 + k % 3, "click") for k in range(30)]
    for name, rows, schema in (
            ("part", part, "p_partkey long, p_name string, p_type string"), ("orders", orders, "o_orderkey long, o_custkey long"),
            ("lineitem", lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz"),
            ("events", events, "event_id long, ts timestamp_ntz, user_id long, event_type string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/{name}.parquet")
    return scratch


def test_kept_ratings_are_the_fact(spark, tables):
    plain, kept = Layers(spark, tables), Layers(spark, tables).keep_ratings()
    for years in (None, [1997, 1999, 2000], []):
        a, b = plain.fact_ratings(years), kept.fact_ratings(years)
        assert a.schema == b.schema and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert plain.fact_ratings().count() > 50


@pytest.mark.parametrize("mart", ["movie_analytics", "user_behavior", "genre_performance"])
def test_a_history_joins_the_sources_once(spark, tables, mart):
    found = registry()[f"snap_mart_{mart}"](spark, tables)
    assert not [f for f in found.inputFiles() if "/lineitem.parquet/" in f or "/orders.parquet/" in f]
    assert found.filter(F.col("is_current")).count() > 1


def test_generated_methods_are_kept_small_unless_set_otherwise(spark):
    before = spark.conf.get(CODEGEN_LIMIT)
    try:
        for given, wanted in ((SPARKS_LIMIT, HOTSPOTS_LIMIT), ("4000", "4000")):
            spark.conf.set(CODEGEN_LIMIT, given)
            ensure_session_defaults(spark)
            assert spark.conf.get(CODEGEN_LIMIT) == wanted
    finally:
        spark.conf.set(CODEGEN_LIMIT, before)


def test_raters_need_one_shuffle_of_the_fact(spark):
    fact = spark.createDataFrame([(u, m, 3.0, dt.datetime(2000, 1, 1)) for u in (1, 2, 40000, 40000) for m in (1, 2)] + [(7, 3, 4.0, dt.datetime(2000, 1, 1))],
                                 "user_id int, movie_id int, rating double, created_at timestamp")
    dim = spark.createDataFrame([(1, "t", 2000, "a"), (1, "t", 2000, "a"), (2, "t", 2000, "a"), (2, "t", 2000, "b"), (3, "t", 2000, "b")],
                                "movie_id int, title string, year int, genres string")
    mart = marts.mart_genre_performance(fact, fact.selectExpr("user_id", "movie_id", "'x' AS tag", "created_at"), dim)
    assert {r.genres: r.unique_raters for r in mart.collect()} == {"a": 3, "b": 4}
    plan = mart._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan
