"""Every tabular query against its SQL on the smallest tables."""

import pytest

from loomtab import registry
from tests.helpers import duck, rows

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(DIR)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, con, name):
    df = registry.queries()[name](spark, DIR)
    found = con.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(found.columns, found.fetchall())
