"""Every registered query against its check SQL on the smallest data set."""

import os

import pytest

from pageloom.plans import catalog
from tools.check import compare, connect

SF_DIR = os.environ.get("PAGELOOM_SF_DIR", "/root/testdata/sf0.001")
NAMES = list(catalog.all_queries())


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    ok, text, _, _ = compare(spark, con, catalog.all_queries()[name], SF_DIR)
    assert ok, text
