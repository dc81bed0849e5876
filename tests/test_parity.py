"""Every registered query against its SQL, on the smallest test tables."""

import oracle
import pytest

from tarnkeep.suite.oracles import ORACLES
from tarnkeep.suite.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_parity(spark, connection, name):
    assert oracle.difference(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) is None
