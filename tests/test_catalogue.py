import pytest

from matrixloom import catalogue
from tests.oracle import assert_same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert_same(spark, SF, catalogue.queries()[name], catalogue.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert catalogue.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
