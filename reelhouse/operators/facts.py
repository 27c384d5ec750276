"""Rating and tag facts and the per movie × genre rating aggregate."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.columns import year_range_filter

# The yearly partitions of fact_ratings run from 1995 up to,
# but excluding, 2024.
FIRST_PARTITION_YEAR = 1995
END_PARTITION_YEAR = 2024
PARTITION_YEARS = tuple(range(FIRST_PARTITION_YEAR, END_PARTITION_YEAR))
RATING_MIN = 0.5
RATING_MAX = 5.0


def id_set(ids: DataFrame, column: str) -> DataFrame:
    """(bucket, words): the distinct non-NULL ids as bitmaps of 32,768 bits, 512 longs each.

    Ids are 32-bit integers, so there are at most 131,073 buckets, 4 KB each: the
    set of all ids there can be is 512 MB, and of a million consecutive ones 128 KB.
    """
    bits = ids.filter(F.col(column).isNotNull()).select(F.col(column).cast("int").cast("bigint").alias("id"))
    bits = bits.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
    words = F.expr("transform(sequence(0, 511), w -> cast(conv(hex(substring(bits, 8 * w + 1, 8)), 16, -10) AS BIGINT))")
    return bits.select("bucket", words.alias("words"))


def in_set(column: str, words: str) -> Column:
    """Whether a row's id is in its bucket's bitmap; bits go up within a byte, bytes down a long."""
    at = F.bitmap_bit_position(F.col(column).cast("bigint"))
    word = F.get(F.col(words), F.floor(at / 64).cast("int"))
    place = (F.lit(56) - F.floor(at % 64 / 8) * 8 + at % 8).cast("int")
    return F.call_function("bit_get", word, place) == 1


def with_known(df: DataFrame, ids: DataFrame, column: str, known: bool = True) -> DataFrame:
    """The rows whose ``column`` is among ``ids`` (or, not ``known``, isn't, NULL included): a semi (anti) join.

    The ids go out as a set of bitmaps (:func:`id_set`, whose size is bounded), so
    the rows stay where they are: a fact isn't shuffled, and a hot id costs nothing.
    """
    bucket, words = "id_bucket", "id_words"
    while {bucket, words} & set(df.columns):
        bucket, words = f"_{bucket}", f"_{words}"
    held = F.broadcast(id_set(ids, column).select(F.col("bucket").alias(bucket), F.col("words").alias(words)))
    rows = df.join(held, F.bitmap_bucket_number(F.col(column).cast("bigint")) == F.col(bucket), "inner" if known else "left")
    test = in_set(column, words)
    return rows.filter(test if known else ~F.coalesce(test, F.lit(False))).select(*df.columns)


def known_rows(df: DataFrame, dim_movies: DataFrame, dim_users: DataFrame | None) -> DataFrame:
    """Keep rows whose movie is in the dimension and whose user is known.

    Both are semi joins: ``dim_movies`` has one row per genre, so an inner
    join would multiply rows, and ``dim_users`` is distinct by construction,
    so its inner join is a semi join.  Both go by :func:`with_known`.  When
    ``dim_users`` is ``None`` the caller asserts it was derived from the same
    staging relations (every non-NULL user is in it), and the join reduces to
    ``user_id IS NOT NULL``.
    """
    df = with_known(df, dim_movies, "movie_id")
    return df.filter(F.col("user_id").isNotNull()) if dim_users is None else with_known(df, dim_users, "user_id")


def fact_ratings(stg_ratings: DataFrame, dim_movies: DataFrame,
                 dim_users: DataFrame | None = None,
                 years: Iterable[int] | None = None) -> DataFrame:
    """Valid ratings of the chosen years (default: every partition year).

    ``rating BETWEEN 0.5 AND 5.0`` (NULL dropped) and ``year(created_at)`` in
    ``years``; the year test is written as ranges on ``created_at`` so that
    it reaches the Parquet reader.  ``year`` is the rating's year.
    """
    kept = known_rows(valid_ratings(stg_ratings, years), dim_movies, dim_users)
    return kept.select("user_id", "movie_id", "rating", "created_at", "year")


def valid_ratings(stg_ratings: DataFrame, years: Iterable[int] | None = None) -> DataFrame:
    """The fact's rows before their movie and user are looked up."""
    years = PARTITION_YEARS if years is None else tuple(years)
    ratings = (stg_ratings
               .filter(F.col("rating").between(RATING_MIN, RATING_MAX))
               .filter(year_range_filter("created_at", years)))
    return ratings.select("user_id", "movie_id", "rating", "created_at",
                          F.year("created_at").cast("int").alias("year"))


def fact_tags(stg_tags: DataFrame, dim_movies: DataFrame,
              dim_users: DataFrame | None = None) -> DataFrame:
    """Key-filtered tags; no rating range or year restriction."""
    tags = known_rows(stg_tags, dim_movies, dim_users)
    return tags.select("user_id", "movie_id", "tag", "created_at",
                       F.year("created_at").cast("int").alias("year"))


def rating_rollup(fact_ratings: DataFrame, *keys: str) -> DataFrame:
    """Per ``keys``: what every further rating statistic follows from by sums, minima and maxima.

    n, s and ss are count, sum and sum of squares (exact: ratings are half
    stars), lo and hi the extremes, t0 and t1 the first and last time.  A hot
    key is harmless: the partial aggregate combines it map-side and only one
    row per key and task is shuffled.
    """
    r = F.col("rating")
    return fact_ratings.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(r).alias("s"), F.sum(r * r).alias("ss"), F.min(r).alias("lo"),
        F.max(r).alias("hi"), F.min("created_at").alias("t0"), F.max("created_at").alias("t1"))


def rolled_up(rollup: DataFrame, *keys: str, weight: Column | None = None, **more: Column) -> DataFrame:
    """A rollup of a rollup; ``weight`` counts each of its rows so many times."""
    k = F.lit(1) if weight is None else weight
    return rollup.groupBy(*keys).agg(
        F.sum(F.col("n") * k).alias("n"), F.sum(F.col("s") * k).alias("s"), F.sum(F.col("ss") * k).alias("ss"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("t0").alias("t0"), F.max("t1").alias("t1"),
        *[c.alias(name) for name, c in more.items()])


def deviation() -> Column:
    """Sample standard deviation from n, s and ss (NULL for one rating)."""
    n, s, ss = F.col("n"), F.col("s"), F.col("ss")
    return F.when(n > 1, F.sqrt(F.greatest(ss - s * s / n, F.lit(0.0)) / (n - 1)))


def fact_movie_genre_ratings(fact_ratings: DataFrame, dim_movies: DataFrame,
                             keep_rating_sum: bool = False) -> DataFrame:
    """Per (movie_id, title, movie year, genres): count, mean, min, max.

    Equal to ``ratings ⨝ dim_movies`` grouped by those keys, but the ratings
    are first reduced to one row per movie and the (small) dimension rows to
    one row per group with their multiplicity ``k``: a joined group then has
    ``n·k`` ratings summing to ``s·k`` with the movie's min and max.  The
    exploded join of the full fact never happens.  ``year`` is the movie's
    release year.  ``rating_sum`` (exact Σ rating) is kept on request for
    consumers that combine means.
    """
    stats = rating_rollup(fact_ratings, "movie_id")
    groups = (dim_movies.groupBy("movie_id", "title", "year", "genres")
              .agg(F.count(F.lit(1)).alias("k")))
    joined = groups.join(stats, on="movie_id", how="inner")
    cols = [
        "movie_id", "title", "year", "genres",
        (F.col("n") * F.col("k")).alias("rating_count"),
        ((F.col("s") * F.col("k")) / (F.col("n") * F.col("k"))).alias("avg_rating"),
        F.col("lo").alias("min_rating"),
        F.col("hi").alias("max_rating"),
    ]
    if keep_rating_sum:
        cols.append((F.col("s") * F.col("k")).alias("rating_sum"))
    return joined.select(*cols)
