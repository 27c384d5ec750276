"""Every registered query against its DuckDB oracle."""

import pytest

import __spark_entry__ as E
from reelhouse.plans.queries import registry
from tests.conftest import SMALL
from tests.oracle_compare import compare

NAMES = sorted(registry())


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SMALL, E.queries()[name], E.oracle_sql()[name])
    assert r["schema_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "engagement_tier" in df.columns
