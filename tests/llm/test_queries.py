"""The queries that have SQL against it, on the smallest given data."""

from pathlib import Path

import pytest

from checks.compare import connect, difference
from starmart.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the given tables")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    got = QUERIES[name](spark, FOLDER).toArrow()
    assert difference(got, connect(FOLDER).sql(ORACLE[name]).to_arrow_table()) is None
