"""Every registered query against its SQL counterpart on the given tables."""

import oracle
import pytest

from conftest import SF_DIR
from tillstream.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, con, name):
    problem, _rows, _seconds = oracle.compare(spark, con, QUERIES[name], SQL[name], SF_DIR)
    assert problem is None
