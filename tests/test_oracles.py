"""Every query with SQL gives the SQL's rows on the smallest tables."""

from __future__ import annotations

import pytest

from scriptoria import registry
from tests.oracle import differences

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.load()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert differences(spark, FOLDER, QUERIES[name], ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
