"""Queries with check SQL, on the smallest data set."""

import os

import pytest

from pageloom.llm.queries import ORACLES, QUERIES
from tools.check import connect, rows_of

SF_DIR = os.environ.get("PAGELOOM_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    result = connect(SF_DIR).execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, result.fetchall())
