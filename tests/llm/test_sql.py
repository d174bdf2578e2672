"""Queries of this subpackage that have SQL, against DuckDB."""

import pytest

from learnertrace.llm.queries import QUERIES, SQL
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    assert difference(spark, connect(FOLDER), FOLDER, QUERIES[name], SQL[name]) is None
