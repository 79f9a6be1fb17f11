"""Every query with SQL against that SQL on the small tables."""

import pytest

from citylake.catalog.all import ORACLES, QUERIES
from tools.check_oracle import compare


def test_registry_is_consistent():
    import __spark_entry__ as entry

    assert set(ORACLES) <= set(QUERIES)
    assert entry.queries().keys() == QUERIES.keys() | entry.CORPUS_QUERIES.keys()
    assert entry.oracle_sql().keys() == ORACLES.keys() | entry.CORPUS_ORACLES.keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, sf_dir, name):
    problems = compare(spark, con, sf_dir, name)
    assert not problems, problems


def test_entry_runs(spark, sf_dir):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert {"zona", "fecha", "hora", "nivel_congestion"} <= set(df.columns)
    assert df.count() > 0
