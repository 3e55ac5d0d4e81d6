import pytest

import __spark_entry__ as entry
from tessaloom import catalog


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_as_sql(name, same_as_sql):
    same_as_sql(catalog.queries()[name], catalog.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(name, spark, data):
    rows = catalog.queries()[name](spark, data)
    # these give a row for each input row, sampled row or chunk, so never none
    assert rows.count() > 0 and len(set(rows.columns)) == len(rows.columns)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 50 and rows[0]["frequency"] >= rows[-1]["frequency"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
