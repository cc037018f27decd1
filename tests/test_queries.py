"""Every registered query beside its oracle on the smallest tables."""

import pytest

from standins.compare import connect, oracle_rows, spark_rows
from standins.queries import QUERIES
from standins.registry import ORACLES

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in text]
    names, rows = spark_rows(df)
    want_names, want = oracle_rows(duck, ORACLES[name])
    assert names == want_names
    assert rows == want
    assert rows, "the comparison must not be empty"
