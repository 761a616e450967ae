"""Every registered query against its SQL twin, on the smallest tables."""

import pytest
from check_queries import compare, connect
from conftest import FOLDER

from __spark_entry__ import entry, oracle_sql, queries

TWINS = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_same_as_sql(spark, duck, name):
    assert compare(queries()[name](spark, FOLDER), duck, TWINS[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(TWINS)))
def test_has_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    result = entry(spark)
    assert "f1_score_weighted" in result.columns
    assert result.count() > 0


def test_every_twin_belongs_to_a_query():
    assert set(TWINS) <= set(queries())
