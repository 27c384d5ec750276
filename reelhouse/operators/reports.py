"""Dashboard queries over the marts (the serving layer's questions)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.tiers import movie_quality_tier

TOP_MOVIES = 20


def report_top_movies(mart_movie: DataFrame, k: int = TOP_MOVIES) -> DataFrame:
    """Top ``k`` movies by total ratings (ties by movie id).  The limit is the
    feature; Spark plans it as a per-partition top-k merged once."""
    return (mart_movie.select("movie_id", "title", "total_ratings", "avg_rating", "quality_tier")
            .orderBy(F.col("total_ratings").desc(), F.col("movie_id").asc()).limit(k))


def top_movies(by_movie: DataFrame, dim_movies: DataFrame, k: int = TOP_MOVIES) -> DataFrame:
    """The same report from the ratings' rollup per movie, of movies in the dimension.

    The top ``k`` are picked before anything is looked up; only their titles are.
    """
    top = (by_movie.select("movie_id", F.col("n").alias("total_ratings"), (F.col("s") / F.col("n")).alias("avg_rating"))
           .orderBy(F.col("total_ratings").desc(), F.col("movie_id").asc()).limit(k))
    titles = (dim_movies.join(F.broadcast(top.select("movie_id")), "movie_id", "left_semi")  # k rows
              .groupBy("movie_id").agg(F.first("title", ignorenulls=True).alias("title")))
    return (top.join(titles, "movie_id").select("movie_id", "title", "total_ratings", "avg_rating", movie_quality_tier(F.col("avg_rating")).alias("quality_tier"))
            .orderBy(F.col("total_ratings").desc(), F.col("movie_id").asc()))


def report_quality_tiers(mart_movie: DataFrame) -> DataFrame:
    return mart_movie.groupBy("quality_tier").agg(F.count(F.lit(1)).alias("movies"),
                                                  F.sum("total_ratings").alias("ratings"))


def report_user_segments(mart_user: DataFrame) -> DataFrame:
    return mart_user.groupBy("user_segment", "rating_style").agg(
        F.count(F.lit(1)).alias("users"), F.sum("total_ratings").alias("ratings"))


def report_genres(mart_genre: DataFrame) -> DataFrame:
    """Genre popularity against mean rating."""
    return mart_genre.select("genres", "total_ratings", "avg_rating", "unique_raters",
                             "popularity_tier", "quality_tier")


def report_preferred_genres(mart_user: DataFrame) -> DataFrame:
    return mart_user.groupBy("preferred_genre").agg(F.count(F.lit(1)).alias("users"))
