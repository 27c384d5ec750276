"""Property: loading years one merge at a time (with corrections and
replays) ends in the same table as one full load of the final data."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reelhouse.operators.upsert import upsert

SCHEMA = "user_id int, movie_id int, rating double, created_at timestamp, year int"

row = st.tuples(st.one_of(st.none(), st.integers(1, 4)), st.integers(1, 4),
                st.sampled_from([0.5, 1.0, 2.5, 4.0, 5.0]),
                st.integers(0, 5), st.sampled_from([1998, 1999, 2000]))


def _frame(spark, rows):
    data = [(u, m, r, dt.datetime(y, 1, 1, 0, 0, s), y) for u, m, r, s, y in rows]
    return spark.createDataFrame(data, SCHEMA)


def _key(r):
    return tuple("" if v is None else str(v) for v in r)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, max_size=12, unique_by=lambda r: (r[0], r[1], r[3], r[4])),
       st.lists(st.sampled_from([0.5, 3.0, 5.0]), min_size=12, max_size=12))
def test_yearly_merges_equal_full_load(spark, rows, corrections):
    # final data: every key once, some ratings corrected
    final = [(u, m, corrections[i], s, y) if i % 3 == 0 else (u, m, r, s, y)
             for i, (u, m, r, s, y) in enumerate(rows)]
    original = {(u, m, s, y): r for u, m, r, s, y in rows}
    table = _frame(spark, [])
    for year in (1998, 1999, 2000):
        # first the original ratings of the year, then a replay with corrections
        first = [(u, m, original[(u, m, s, y)], s, y) for u, m, _, s, y in final if y == year]
        table = upsert(table, _frame(spark, first))
        table = upsert(table, _frame(spark, [r for r in final if r[4] == year
                                             and r[0] is not None]))
    got = sorted((tuple(r) for r in table.collect()), key=_key)
    # NULL-user rows never match, so their replay is skipped above and they
    # appear once, with their original rating
    expect = sorted((tuple(r) for r in _frame(spark, [
        (u, m, original[(u, m, s, y)] if u is None else r, s, y)
        for u, m, r, s, y in final]).collect()), key=_key)
    assert got == expect
