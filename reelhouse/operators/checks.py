"""Data-quality checks.

Each check returns a lazy **one-row DataFrame** ``(check, passed, metric…)``
instead of driver-side numbers, so it can be written, unioned with other
checks, or tested like any query.  Metrics from different relations are
combined without a cross join: every part is a one-row aggregate with its
own columns, the parts are unioned by name and folded with ``max``.

Fixed values: the names of the checks, as their callers know them.

``select(cols).distinct().count()`` semantics are kept where the original
uses them (a NULL key counts as one value), unlike ``count(DISTINCT)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _combine(parts: list[DataFrame]) -> DataFrame:
    """Fold one-row aggregates with disjoint columns into one row."""
    cols = [c for p in parts for c in p.columns]
    unioned = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return unioned.agg(*[F.max(c).alias(c) for c in cols])


def _result(name: str, metrics: DataFrame, passed: Column, order: list[str]) -> DataFrame:
    return metrics.select(F.lit(name).alias("check"), passed.alias("passed"), *order)


def _per_key(df: DataFrame, key: str) -> DataFrame:
    """(key, n): rows per key.  Written alike wherever a check needs it, so that
    the checks of one run share its exchange."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def _orphans(df: DataFrame, key: str, dim: DataFrame, alias: str) -> DataFrame:
    """Rows of ``df`` whose key the dimension lacks: counted per key before the join."""
    unknown = _per_key(df, key).join(dim.select(key), key, "left_anti")
    return unknown.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias(alias))


def _distinct_rows(df: DataFrame, cols: list[str], alias: str) -> DataFrame:
    # groupBy keeps NULL as a group, like distinct(); the partial aggregate
    # de-duplicates map-side before the shuffle.
    return df.select(*cols).distinct().agg(F.count(F.lit(1)).alias(alias))


def check_dim_movies_genre_count(dim_movies: DataFrame) -> DataFrame:
    """Per movie, distinct genres = min(genre_count) = max(genre_count)."""
    per_movie = dim_movies.groupBy("movie_id").agg(
        F.count_distinct("genres").alias("actual"),
        F.min("genre_count").alias("lo"),
        F.max("genre_count").alias("hi"))
    bad = per_movie.filter((F.col("actual") != F.col("lo")) | (F.col("lo") != F.col("hi")))
    metrics = bad.agg(F.count(F.lit(1)).alias("inconsistent_movie_count"))
    return _result("dim_movies_genre_count_consistent", metrics,
                   F.col("inconsistent_movie_count") == 0, ["inconsistent_movie_count"])


def check_fact_ratings_unique_key(fact_ratings: DataFrame) -> DataFrame:
    """fact_ratings is unique on (user_id, movie_id, created_at) — one pass."""
    per_key = fact_ratings.groupBy("user_id", "movie_id", "created_at").agg(
        F.count(F.lit(1)).alias("n"))
    metrics = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
                          F.count(F.lit(1)).alias("distinct_business_keys"))
    metrics = metrics.withColumn("duplicate_rows",
                                 F.col("total_rows") - F.col("distinct_business_keys"))
    return _result("fact_ratings_has_unique_business_key", metrics,
                   F.col("duplicate_rows") == 0,
                   ["total_rows", "distinct_business_keys", "duplicate_rows"])


def check_fact_ratings_movie_fk(fact_ratings: DataFrame, dim_movies: DataFrame) -> DataFrame:
    """No rating references a movie missing from dim_movies."""
    metrics = _orphans(fact_ratings, "movie_id", dim_movies, "orphan_movie_references")
    return _result("fact_ratings_has_valid_movie_keys", metrics,
                   F.col("orphan_movie_references") == 0, ["orphan_movie_references"])


def check_fact_tags_fk(fact_tags: DataFrame, dim_movies: DataFrame,
                       dim_users: DataFrame) -> DataFrame:
    """C4: no tag references an unknown movie or user."""
    metrics = _combine([_orphans(fact_tags, "movie_id", dim_movies, "orphan_movie_references"),
                        _orphans(fact_tags, "user_id", dim_users, "orphan_user_references")])
    return _result("fact_tags_has_valid_user_and_movie_keys", metrics,
                   (F.col("orphan_movie_references") == 0) & (F.col("orphan_user_references") == 0),
                   ["orphan_movie_references", "orphan_user_references"])


def check_fmgr_preserves_totals(fact_ratings: DataFrame, dim_movies: DataFrame,
                                fmgr: DataFrame) -> DataFrame:
    """|ratings ⨝ dim_movies| = Σ fmgr.rating_count.

    The join size is Σ over movies of (ratings of the movie) × (dimension
    rows of the movie): both sides are reduced per movie first, so the
    exploded join is never materialised.
    """
    per_movie_r = _per_key(fact_ratings, "movie_id")
    per_movie_d = dim_movies.groupBy("movie_id").agg(F.count(F.lit(1)).alias("k"))
    expected = (per_movie_r.join(per_movie_d, "movie_id")
                .agg(F.coalesce(F.sum(F.col("n") * F.col("k")), F.lit(0)).cast("bigint")
                     .alias("expected_exploded_rating_total")))
    actual = fmgr.agg(F.coalesce(F.sum("rating_count"), F.lit(0)).cast("bigint")
                      .alias("actual_rating_count_total"))
    metrics = _combine([expected, actual])
    return _result("fact_movie_genre_ratings_preserves_exploded_rating_totals", metrics,
                   F.col("expected_exploded_rating_total") == F.col("actual_rating_count_total"),
                   ["expected_exploded_rating_total", "actual_rating_count_total"])


def _row_count_check(name: str, expected: DataFrame, mart: DataFrame) -> DataFrame:
    actual = mart.agg(F.count(F.lit(1)).alias("actual_rows"))
    metrics = _combine([expected, actual])
    return _result(name, metrics, F.col("actual_rows") == F.col("expected_rows"),
                   ["expected_rows", "actual_rows"])


def check_movie_mart_row_count(fact_ratings: DataFrame, mart: DataFrame) -> DataFrame:
    """One mart row per distinct rated movie."""
    return _row_count_check("mart_movie_analytics_matches_distinct_movies",
                            _per_key(fact_ratings, "movie_id").agg(F.count("n").alias("expected_rows")), mart)


def check_movie_mart_totals(fact_ratings: DataFrame, mart: DataFrame) -> DataFrame:
    """Σ total_ratings = number of fact rows."""
    expected = _per_key(fact_ratings, "movie_id").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("expected_total_ratings"))
    actual = mart.agg(F.coalesce(F.sum("total_ratings"), F.lit(0)).cast("bigint")
                      .alias("actual_total_ratings"))
    metrics = _combine([expected, actual])
    return _result("mart_movie_analytics_preserves_rating_totals", metrics,
                   F.col("expected_total_ratings") == F.col("actual_total_ratings"),
                   ["expected_total_ratings", "actual_total_ratings"])


def check_user_mart_row_count(fact_ratings: DataFrame, mart: DataFrame) -> DataFrame:
    """One mart row per distinct rating user."""
    return _row_count_check("mart_user_behavior_matches_distinct_users",
                            _distinct_rows(fact_ratings, ["user_id"], "expected_rows"), mart)


def check_genre_mart_row_count(fmgr: DataFrame, mart: DataFrame) -> DataFrame:
    """One mart row per distinct genre of fact_movie_genre_ratings."""
    return _row_count_check("mart_genre_performance_matches_distinct_genres",
                            _distinct_rows(fmgr, ["genres"], "expected_rows"), mart)


def genre_set_diff(fmgr: DataFrame, mart: DataFrame) -> DataFrame:
    """Rows ``(genres, side)``: ``missing`` (in fmgr only) or ``unexpected``
    (in the mart only).  Distributed: a full outer join of the two distinct
    sets; NULL genres compare equal, as set difference does."""
    exp = fmgr.select("genres").distinct().withColumn("_e", F.lit(True))
    act = mart.select("genres").distinct().withColumn("_a", F.lit(True))
    j = exp.alias("e").join(act.alias("a"), F.col("e.genres").eqNullSafe(F.col("a.genres")),
                            "full_outer")
    return j.select(
        F.coalesce(F.col("e.genres"), F.col("a.genres")).alias("genres"),
        F.when(F.col("a._a").isNull(), F.lit("missing"))
         .when(F.col("e._e").isNull(), F.lit("unexpected")).alias("side"),
        F.col("e._e").isNotNull().alias("in_expected"),
        F.col("a._a").isNotNull().alias("in_actual"),
    )


def check_genre_mart_set(fmgr: DataFrame, mart: DataFrame) -> DataFrame:
    """Same genre set in fmgr and the mart.

    The one-row result carries the sizes; the genre lists themselves are
    :func:`genre_set_diff` rows (never gathered into one task).
    """
    d = genre_set_diff(fmgr, mart)
    metrics = d.agg(
        F.count_if(F.col("side") == "missing").alias("missing_genre_count"),
        F.count_if(F.col("side") == "unexpected").alias("unexpected_genre_count"),
        F.count_if(F.col("in_expected")).alias("expected_genre_count"),
        F.count_if(F.col("in_actual")).alias("actual_genre_count"))
    return _result("mart_genre_performance_has_expected_genre_set", metrics,
                   (F.col("missing_genre_count") == 0) & (F.col("unexpected_genre_count") == 0),
                   ["missing_genre_count", "unexpected_genre_count", "expected_genre_count",
                    "actual_genre_count"])


def check_bronze_source(spark, name: str, path: str) -> DataFrame:
    """C11–C14: the source exists, has > 0 data lines and > 0 bytes."""
    from reelhouse.sources.csv import source_file_stats
    check = f"bronze_{name}_has_data"
    try:
        stats = source_file_stats(spark, path)
    except Exception as exc:  # missing path: AnalysisException at plan time
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        return spark.createDataFrame(
            [(check, False, 0, 0, path)],
            "check string, passed boolean, row_count bigint, file_size_bytes bigint, source_path string")
    return stats.select(F.lit(check).alias("check"),
                        ((F.col("row_count") > 0) & (F.col("file_size_bytes") > 0)).alias("passed"),
                        "row_count", "file_size_bytes", "source_path")


def silver_gold_checks(t: dict[str, DataFrame]) -> list[DataFrame]:
    """C1–C10 over ``{dim_movies, dim_users, fact_ratings, fact_tags, fmgr,
    mart_movie_analytics, mart_user_behavior, mart_genre_performance}``."""
    return [
        check_dim_movies_genre_count(t["dim_movies"]),
        check_fact_ratings_unique_key(t["fact_ratings"]),
        check_fact_ratings_movie_fk(t["fact_ratings"], t["dim_movies"]),
        check_fact_tags_fk(t["fact_tags"], t["dim_movies"], t["dim_users"]),
        check_fmgr_preserves_totals(t["fact_ratings"], t["dim_movies"], t["fmgr"]),
        check_movie_mart_row_count(t["fact_ratings"], t["mart_movie_analytics"]),
        check_movie_mart_totals(t["fact_ratings"], t["mart_movie_analytics"]),
        check_user_mart_row_count(t["fact_ratings"], t["mart_user_behavior"]),
        check_genre_mart_row_count(t["fmgr"], t["mart_genre_performance"]),
        check_genre_mart_set(t["fmgr"], t["mart_genre_performance"]),
    ]
