import pytest
from comparing import compare

from skyloom import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, data, name):
    compare(spark, data, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, data, name):
    df = queries.QUERIES[name](spark, data)
    assert df.columns and df.count() >= 0


def test_entry(spark, data):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
