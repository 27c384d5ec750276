"""Maintained rollups: stored per year, brought up to date from the years that changed.

Each rollup table's version notes the state of the fact's partitions that it was
made of.  The fact's partitions whose state is another now are the only ones
read; their partitions of the rollup are replaced.  Rollups that depend on the
movies' genres also note a digest of those, and are made anew if it changes.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.operators import marts, rollups
from reelhouse.plans.tables import TableStore

FACT = "fact_ratings"
#: Each rollup table: how a part of the fact is rolled up, and whether genres matter.
TABLES: dict[str, tuple[Callable[..., DataFrame], bool]] = {
    "rollup_movies": (rollups.movies, False),
    "rollup_users": (rollups.users, False),
    "rollup_genre_raters": (lambda fact, dim: rollups.genre_raters(fact, dim, "year"), True),
    "rollup_user_genres": (rollups.user_genres, True),
}


def _genres_digest(dim_movies: DataFrame) -> str:
    h = F.xxhash64("movie_id", "genres")
    found = dim_movies.agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")).first()
    return f"{found.n}:{found.x}:{found.s}"


def maintain_rollups(store: TableStore) -> dict[str, list[str]]:
    """Bring every rollup up to date; returns the fact's partitions that each was made of anew."""
    fact, dim = store.version(FACT), store.read("dim_movies")
    genres, done = _genres_digest(dim), {}
    for name, (roll, by_genre) in TABLES.items():
        base = store.version(name)
        of = base.more["of"] if base and (not by_genre or base.more.get("genres") == genres) else {}
        changed = [p for p, state in fact.parts.items() if of.get(p) != state]
        gone = list(base.parts if base and not of else [p for p in of if p not in fact.parts])
        done[name] = changed
        if changed or gone or base is None:
            rows = store.rows(FACT, fact, changed)
            store.replace_partitions(name, roll(rows, dim) if by_genre else roll(rows), changed + gone, of=fact.parts, genres=genres)
    return done


def marts_of_rollups(store: TableStore, as_of: datetime | None = None) -> dict[str, DataFrame]:
    """The three marts from the stored rollups, tags and dimensions; the fact isn't read."""
    r = store.read
    by_movie = rollups.by_movie(r("rollup_movies"))
    return {
        "mart_movie_analytics": marts.movie_mart(by_movie, r("fact_tags"), r("dim_movies"), as_of),
        "mart_user_behavior": marts.user_mart(rollups.by_user(r("rollup_users")), rollups.by_user_genre(r("rollup_user_genres")),
                                              r("fact_tags"), r("dim_users"), as_of),
        "mart_genre_performance": marts.genre_mart(by_movie, rollups.by_genre_raters(r("rollup_genre_raters")),
                                                   r("fact_tags"), r("dim_movies"), as_of),
    }
