import pytest

import __spark_entry__ as entry
from lodestrata.plans.catalog import QUERIES, SQL

from .conftest import SF, same


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    same(QUERIES[name](spark, SF), duck, SQL[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
