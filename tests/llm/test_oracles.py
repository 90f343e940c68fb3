"""Queries next to their SQL on the smallest tables."""

from pathlib import Path

import pytest
from oracle import compare, connect

from civiclake.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the benchmark tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    assert compare(spark, connect(FOLDER), name, QUERIES[name], ORACLES[name], FOLDER) is None
