"""Rollups of the rating fact per year, and the marts' figures from them.

A year's rollup depends on that year's ratings alone, and every figure of the
marts is a rollup of the years': counts, sums, squares, extremes and active
days (a day is in one year) add up; distinct raters of a genre are the bits of
bitmaps that are OR-ed; a user's distinct movies are the union of the years'
sets.  So after a load only the touched years are read again.

Bitmaps hold 32,768 users each.  A genre has one a year for each such range of
ids that rated it: dense, as genres are few.  A user's movies are a set of ids
instead: a bitmap of 4 KB for a few dozen movies would be mostly empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.operators.facts import rating_rollup, rolled_up


def movies(fact_ratings: DataFrame) -> DataFrame:
    """(year, movie_id, n, s, ss, lo, hi, t0, t1)."""
    return rating_rollup(fact_ratings, "year", "movie_id")


def genre_raters(fact_ratings: DataFrame, dim_movies: DataFrame, *by: str) -> DataFrame:
    """(*by, genres, bucket, raters): the users who rated a movie of the genre, as bitmaps.

    The bitmaps are made map-side, so what is shuffled is bitmaps, not (genre, user) pairs.
    """
    genres = dim_movies.select("movie_id", "genres").distinct()
    user = F.col("user_id").cast("bigint")
    rated = fact_ratings.select(*by, "movie_id", user.alias("user_id")).join(genres, "movie_id")
    return rated.groupBy(*by, "genres", F.bitmap_bucket_number("user_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("raters"))


def users(fact_ratings: DataFrame) -> DataFrame:
    """(year, user_id, n, s, ss, lo, hi, t0, t1, active_days, movies)."""
    by_movie = rating_rollup(fact_ratings, "year", "user_id", "movie_id")
    days = fact_ratings.select("year", "user_id", F.to_date("created_at").alias("day")).distinct()
    days = days.groupBy("year", "user_id").agg(F.count("day").alias("active_days"))
    return rolled_up(by_movie, "year", "user_id", movies=F.collect_list("movie_id")).join(days, ["year", "user_id"])


def user_genres(fact_ratings: DataFrame, dim_movies: DataFrame) -> DataFrame:
    """(year, user_id, genres, n, s): ratings per genre, one for each of a movie's rows of it."""
    by_movie = rating_rollup(fact_ratings, "year", "user_id", "movie_id").select("year", "user_id", "movie_id", "n", "s")
    return (by_movie.join(dim_movies.select("movie_id", "genres"), "movie_id")
            .groupBy("year", "user_id", "genres").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))


# -- over all years ---------------------------------------------------------------

def by_movie(rollup: DataFrame) -> DataFrame:
    return rolled_up(rollup, "movie_id")


def by_genre_raters(rollup: DataFrame) -> DataFrame:
    """(genres, unique_raters)."""
    years = rollup.groupBy("genres", "bucket").agg(F.bitmap_or_agg("raters").alias("raters"))
    return years.groupBy("genres").agg(F.sum(F.bitmap_count("raters")).alias("unique_raters"))


def by_user(rollup: DataFrame) -> DataFrame:
    """The user mart's rating figures; a user's distinct movies are at most the catalogue."""
    sets = F.array_distinct(F.flatten(F.collect_list("movies")))
    return rolled_up(rollup, "user_id", active_days=F.sum("active_days"), unique_movies_rated=F.size(sets).cast("bigint"))


def by_user_genre(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("user_id", "genres").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
