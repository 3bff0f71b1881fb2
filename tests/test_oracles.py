"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks import oracles
from checks.compare import connect, difference
from checks.queries import QUERIES

SF_DIR = Path(entry.SMALL)
pytestmark = pytest.mark.skipif(not SF_DIR.is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    return connect(str(SF_DIR))


STATEMENTS = oracles.oracle_sql()


def test_every_query_has_a_statement():
    assert set(STATEMENTS) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(SF_DIR))
    assert difference(df, duck, STATEMENTS[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["categorie", "nb_rappels"]
