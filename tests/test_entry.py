"""The registered queries: they import, are paired with SQL by name, and the flagship runs."""

import os

import pytest

import __spark_entry__


def test_names():
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert __spark_entry__.FLAGSHIP in queries and set(oracles) <= set(queries)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_flagship(spark):
    row = __spark_entry__.entry(spark).first()
    assert (row.n, row.success_rate, row.collision_rate, row.tracking_rate) == (15, 0.533333, 0.4, 0.597)
