"""Queries ask Spark to split generated methods that the JVM would not compile; it is the setting that is checked, not the size of the methods."""

import pytest

from tapework.plans import queries as q

SF, MOST = "/root/testdata/sf0.001", 8000


@pytest.mark.parametrize("name", ["t17_futures_klines", "t5_tickers"])
def test_methods_are_small_enough_to_compile(spark, name):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    q.QUERIES[name](spark, SF)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= MOST
