"""Tier and segment labels.

Fixed values: the thresholds and labels below must equal the original
pipeline's, in this order (first matching threshold wins; ``>=`` compare).

* engagement_tier on total_ratings: 100 Highly Rated, 50 Well Rated,
  10 Moderately Rated, else Limited Ratings
* movie quality_tier on avg_rating: 4.0 Excellent, 3.5 Good, 3.0 Average,
  2.0 Below Average, else Poor
* user_segment on total_ratings: 1000 Power, 500 Heavy, 100 Active,
  20 Regular, else Light
* rating_style on avg_rating_given: 4.0 Positive Rater, 3.0 Neutral Rater,
  else Critical Rater
* popularity_tier on total_ratings: 100000 Highly Popular, 50000 Very
  Popular, 10000 Popular, 1000 Moderately Popular, else Niche
* genre quality_tier on avg_rating: 3.8 Top Rated, 3.5 Well Rated,
  3.2 Average Rated, else Below Average
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENGAGEMENT_TIERS = [(100, "Highly Rated"), (50, "Well Rated"), (10, "Moderately Rated")]
ENGAGEMENT_DEFAULT = "Limited Ratings"
MOVIE_QUALITY_TIERS = [(4.0, "Excellent"), (3.5, "Good"), (3.0, "Average"), (2.0, "Below Average")]
MOVIE_QUALITY_DEFAULT = "Poor"
USER_SEGMENTS = [(1000, "Power"), (500, "Heavy"), (100, "Active"), (20, "Regular")]
USER_SEGMENT_DEFAULT = "Light"
RATING_STYLES = [(4.0, "Positive Rater"), (3.0, "Neutral Rater")]
RATING_STYLE_DEFAULT = "Critical Rater"
POPULARITY_TIERS = [(100000, "Highly Popular"), (50000, "Very Popular"), (10000, "Popular"),
                    (1000, "Moderately Popular")]
POPULARITY_DEFAULT = "Niche"
GENRE_QUALITY_TIERS = [(3.8, "Top Rated"), (3.5, "Well Rated"), (3.2, "Average Rated")]
GENRE_QUALITY_DEFAULT = "Below Average"


def threshold_label(value, thresholds, default: str) -> Column:
    """Searched CASE: the label of the first threshold ``value`` reaches."""
    value = F.col(value) if isinstance(value, str) else value
    expr = None
    for bound, label in thresholds:
        expr = (F.when(value >= bound, F.lit(label)) if expr is None
                else expr.when(value >= bound, F.lit(label)))
    return expr.otherwise(F.lit(default))


def engagement_tier(c="total_ratings") -> Column:
    return threshold_label(c, ENGAGEMENT_TIERS, ENGAGEMENT_DEFAULT)


def movie_quality_tier(c="avg_rating") -> Column:
    return threshold_label(c, MOVIE_QUALITY_TIERS, MOVIE_QUALITY_DEFAULT)


def user_segment(c="total_ratings") -> Column:
    return threshold_label(c, USER_SEGMENTS, USER_SEGMENT_DEFAULT)


def rating_style(c="avg_rating_given") -> Column:
    return threshold_label(c, RATING_STYLES, RATING_STYLE_DEFAULT)


def popularity_tier(c="total_ratings") -> Column:
    return threshold_label(c, POPULARITY_TIERS, POPULARITY_DEFAULT)


def genre_quality_tier(c="avg_rating") -> Column:
    return threshold_label(c, GENRE_QUALITY_TIERS, GENRE_QUALITY_DEFAULT)
