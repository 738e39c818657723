"""Every catalogue query against its SQL, on the smallest tables."""

import pytest

from sparkloom.plans import catalogue
from tests.conftest import check_against_sql


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, sql, name):
    check_against_sql(spark, sf_dir, sql, catalogue.queries()[name], catalogue.oracle_sql()[name])


def test_all_queries_have_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
