"""Every corpus query with SQL against that SQL."""

import pytest

from citylake.llm.queries import ORACLES, QUERIES
from tools.check_oracle import difference


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, sf_dir, name):
    assert not difference(QUERIES[name](spark, sf_dir), con, ORACLES[name])
