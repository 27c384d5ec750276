"""Column-level building blocks (all JVM-side ``pyspark.sql.functions``)."""

from reelhouse.functions.columns import (  # noqa: F401
    epoch_seconds_to_ts,
    legacy_double,
    legacy_int,
    legacy_long,
    normalize_imdb_id,
    title_year,
    year_range_filter,
)
from reelhouse.functions.tiers import (  # noqa: F401
    engagement_tier,
    genre_quality_tier,
    movie_quality_tier,
    popularity_tier,
    rating_style,
    user_segment,
)
