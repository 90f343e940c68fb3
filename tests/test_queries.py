"""Every registered query against its SQL on the smallest benchmark tables."""

import os

import oracle
import pytest

from civiclake.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")


@pytest.fixture(scope="module")
def db():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    if name in ORACLES:
        assert oracle.compare(spark, db, name, QUERIES[name], ORACLES[name], FOLDER) is None
    else:
        assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
