"""Every registered query against its SQL, on the smallest tables."""

import pytest

import checks.queries  # noqa: F401
from checks.base import QUERIES
from checks.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name) == ""
