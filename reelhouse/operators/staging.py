"""A2–A5: typed staging tables from the all-string raw relations.

Pure projections and one filter: each is a map-only stage that keeps the
scan's column pruning and predicate pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.columns import epoch_seconds_to_ts, legacy_double, legacy_int


def stg_movies(raw: DataFrame) -> DataFrame:
    return raw.select(legacy_int("movieId").alias("movie_id"), "title", "genres")


def stg_ratings(raw: DataFrame) -> DataFrame:
    return raw.select(
        legacy_int("userId").alias("user_id"),
        legacy_int("movieId").alias("movie_id"),
        legacy_double("rating").alias("rating"),
        epoch_seconds_to_ts("timestamp").alias("created_at"),
    )


def stg_tags(raw: DataFrame) -> DataFrame:
    tag = F.lower(F.trim(F.col("tag")))
    return (raw.select(
        legacy_int("userId").alias("user_id"),
        legacy_int("movieId").alias("movie_id"),
        tag.alias("tag"),
        epoch_seconds_to_ts("timestamp").alias("created_at"),
    ).filter(F.col("tag").isNotNull() & (F.col("tag") != "")))


def stg_links(raw: DataFrame) -> DataFrame:
    # imdb_id stays text: its leading zeros are part of the id.
    return raw.select(
        legacy_int("movieId").alias("movie_id"),
        F.col("imdbId").alias("imdb_id"),
        legacy_int("tmdbId").alias("tmdb_id"),
    )


def staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All four staging relations from ``{"movies", "links", "ratings", "tags"}``."""
    return {
        "stg_movies": stg_movies(raw["movies"]),
        "stg_links": stg_links(raw["links"]),
        "stg_ratings": stg_ratings(raw["ratings"]),
        "stg_tags": stg_tags(raw["tags"]),
    }
