"""Registered queries against their SQL, and the columns that each returns."""

from __future__ import annotations

import pytest

from scriptoria.llm import queries
from tests.oracle import differences

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, name):
    assert differences(spark, FOLDER, queries.QUERIES[name], queries.ORACLES[name]) == ""


def test_one_query_an_operator():
    assert sorted(int(n.partition("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))
