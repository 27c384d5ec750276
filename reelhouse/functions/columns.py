"""Scalar column expressions shared by the operators.

Spark 4 runs with ANSI casts, where ``cast('' as int)`` raises.  Raw CSV
text is therefore converted with ``try_cast``; the integer helpers also keep
the lenient reading of the older non-ANSI cast (surrounding blanks allowed,
a fractional part truncated, anything else NULL).
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must stay equal to the original pipeline's output.
IMDB_PREFIX = "tt"
IMDB_URL_PREFIX = "https://www.imdb.com/title/"
IMDB_URL_SUFFIX = "/"
TMDB_URL_PREFIX = "https://www.themoviedb.org/movie/"
NO_GENRES = "(no genres listed)"
GENRE_SEPARATOR_REGEX = r"\|"
TITLE_YEAR_REGEX = r"\((\d{4})\)\s*$"
ALL_GENRES_SEPARATOR = ", "

_INTEGRAL_TEXT = r"^\s*([+-]?\d+)(\.\d*)?\s*$"


# The first second of year 1 and the last of year 9999, UTC.
EPOCH_RANGE = (-62135596800, 253402300799)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lenient_integral(c, type_name: str) -> Column:
    # Fast path: a clean integer (surrounding blanks allowed) casts directly;
    # only text that fails is matched against the decimal pattern, whose
    # integer part is kept.  ``coalesce`` evaluates the second branch lazily.
    c = _col(c)
    return F.coalesce(c.try_cast(type_name),
                      F.regexp_extract(c, _INTEGRAL_TEXT, 1).try_cast(type_name))


def legacy_int(c) -> Column:
    """String -> int, NULL on bad input, fraction truncated, overflow NULL."""
    return _lenient_integral(c, "int")


def legacy_long(c) -> Column:
    """String -> bigint with the same leniency as :func:`legacy_int`."""
    return _lenient_integral(c, "bigint")


def legacy_double(c) -> Column:
    """String -> double (surrounding blanks allowed), NULL on bad input."""
    return _col(c).try_cast("double")


def epoch_seconds_to_ts(c) -> Column:
    """Epoch-seconds text -> TIMESTAMP (the session zone only affects display).

    Values beyond the years 1 to 9999 (e.g. an epoch in microseconds) are
    malformed and become NULL; the multiplication would overflow.
    """
    seconds = legacy_long(c)
    return F.when(seconds.between(*EPOCH_RANGE), F.timestamp_seconds(seconds))


def normalize_imdb_id(c) -> Column:
    """Force exactly one ``tt`` prefix; NULL stays NULL."""
    c = _col(c)
    return F.when(c.isNotNull(),
                  F.concat(F.lit(IMDB_PREFIX), F.regexp_replace(c, "^" + IMDB_PREFIX, "")))


def title_year(c) -> Column:
    """Release year in a trailing ``(YYYY)``, NULL when there is none."""
    return F.regexp_extract(_col(c), TITLE_YEAR_REGEX, 1).try_cast("int")


def imdb_url(c) -> Column:
    c = _col(c)
    return F.when(c.isNotNull(), F.concat(F.lit(IMDB_URL_PREFIX), c, F.lit(IMDB_URL_SUFFIX)))


def tmdb_url(c) -> Column:
    c = _col(c)
    return F.when(c.isNotNull(), F.concat(F.lit(TMDB_URL_PREFIX), c.cast("string")))


def _year_runs(years: Iterable[int]) -> list[tuple[int, int]]:
    """Collapse a set of years into inclusive runs: {1,2,3,7} -> [(1,3),(7,7)]."""
    runs: list[tuple[int, int]] = []
    for y in sorted(set(int(v) for v in years)):
        if runs and runs[-1][1] == y - 1:
            runs[-1] = (runs[-1][0], y)
        else:
            runs.append((y, y))
    return runs


def _year_start(y: int) -> Column:
    return F.lit(datetime(y, 1, 1, tzinfo=timezone.utc)).cast("timestamp")


def year_range_filter(ts_col, years: Iterable[int]) -> Column:
    """``year(ts) IN years`` written as half-open ranges on ``ts``.

    ``year(ts) = Y`` is not pushed to the Parquet reader, a range on the raw
    column is; contiguous years collapse into one range.
    """
    ts = _col(ts_col)
    runs = _year_runs(years)
    if not runs:
        return F.lit(False)
    cond = None
    for lo, hi in runs:
        part = (ts >= _year_start(lo)) & (ts < _year_start(hi + 1))
        cond = part if cond is None else (cond | part)
    return cond


def as_of_literal(as_of: datetime | None) -> Column:
    """The ``refreshed_at`` / ``valid_from`` clock: a literal or the query clock."""
    if as_of is None:
        return F.current_timestamp()
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return F.lit(as_of).cast("timestamp")
