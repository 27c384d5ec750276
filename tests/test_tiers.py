"""Tier thresholds at, just below and above each bound (FIXTURES §4)."""

import pytest
from pyspark.sql import functions as F

from reelhouse.functions import tiers

CASES = [
    (tiers.engagement_tier, "bigint", [9, 10, 49, 50, 99, 100],
     ["Limited Ratings", "Moderately Rated", "Moderately Rated", "Well Rated", "Well Rated",
      "Highly Rated"]),
    (tiers.movie_quality_tier, "double", [1.99, 2.0, 2.99, 3.0, 3.49, 3.5, 3.99, 4.0],
     ["Poor", "Below Average", "Below Average", "Average", "Average", "Good", "Good",
      "Excellent"]),
    (tiers.user_segment, "bigint", [19, 20, 99, 100, 499, 500, 999, 1000],
     ["Light", "Regular", "Regular", "Active", "Active", "Heavy", "Heavy", "Power"]),
    (tiers.rating_style, "double", [2.99, 3.0, 3.99, 4.0],
     ["Critical Rater", "Neutral Rater", "Neutral Rater", "Positive Rater"]),
    (tiers.popularity_tier, "bigint", [999, 1000, 9999, 10000, 49999, 50000, 99999, 100000],
     ["Niche", "Moderately Popular", "Moderately Popular", "Popular", "Popular",
      "Very Popular", "Very Popular", "Highly Popular"]),
    (tiers.genre_quality_tier, "double", [3.19, 3.2, 3.49, 3.5, 3.79, 3.8],
     ["Below Average", "Average Rated", "Average Rated", "Well Rated", "Well Rated",
      "Top Rated"]),
]


@pytest.mark.parametrize("fn,typ,values,expected", CASES, ids=[c[0].__name__ for c in CASES])
def test_tier_bounds(spark, fn, typ, values, expected):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    got = [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]
    assert got == expected


def test_decade_bounds(spark):
    from reelhouse.operators.marts import mart_genre_performance
    years = [None, 1989, 1990, 1999, 2000, 2009, 2010, 2019, 2020, 2029, 2030]
    dim = spark.createDataFrame([(i, "t", y, "drama") for i, y in enumerate(years)],
                                "movie_id int, title string, year int, genres string")
    fr = spark.createDataFrame([(1, 0, 4.0, None, 2000)],
                               "user_id int, movie_id int, rating double, created_at timestamp, year int")
    ft = spark.createDataFrame([], "user_id int, movie_id int, tag string, created_at timestamp, year int")
    row = mart_genre_performance(fr, ft, dim).collect()[0]
    assert (row.movies_before_1990, row.movies_1990s, row.movies_2000s, row.movies_2010s,
            row.movies_2020s) == (1, 2, 2, 2, 2)
    assert row.unique_movies == 1 and row.total_tags == 0
