"""Every registered query against its oracle."""

import pytest

from check import compare, connect
from conftest import SF
from registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF) is None


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
