"""Every registered query of the catalogue against its SQL on the smallest tables."""

import pytest

import oracle
from conftest import DATA
from edgeloom import catalog
from parity import difference, duck

ENTRIES = catalog.registered()
#: A fold in order of time that built-in functions cannot express.
FOLDS = {"admitted_requests"}
SQL = oracle.texts()


@pytest.fixture(scope="module")
def con():
    return duck(f"{DATA}/sf0.001")


def test_every_entry_has_a_check():
    assert set(ENTRIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_same_as_sql(spark, small, con, name):
    df = catalog.runnable(ENTRIES[name])(spark, small)
    assert difference(df, con, SQL[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    slow = ("EvalPython", "InArrow", *(() if name in FOLDS else ("InPandas",)))
    assert not any(word in plan for word in ("CartesianProduct", *slow))
