"""Every query with checking SQL gives the same rows, values and types in both engines."""

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry
from touchline.operators import tuning
from workload import load_all, modelling
from workload.registry import ORACLES

load_all()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(autouse=True)
def fewer_rounds(monkeypatch):
    """The queries run their whole number of rounds where they are compared at a larger scale; here the facts are wanted, not the time."""
    monkeypatch.setattr(modelling, "RANKING_ROUNDS", 25)
    monkeypatch.setattr(modelling, "QUANTILE_ROUNDS", 40)
    monkeypatch.setattr(modelling, "TREES", 8)
    for space in (tuning.SPACE, tuning.PENALISED_SPACE):
        monkeypatch.setitem(space, "maxIter", tuning.whole_step(1, 4))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, name):
    result = entry.queries()[name](spark, SF)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "PythonUDF" not in plan
    assert compare(result, con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    table = entry.entry(spark)
    assert len(table.columns) == 19 and table.count() == 15
