import pytest

from tapework.plans import queries as q
from tests.compare import assert_same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_query_matches_sql(spark, name):
    assert_same(q.QUERIES[name](spark, SF), q.ORACLES[name], SF)


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
