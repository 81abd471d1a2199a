"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry
from liftline.catalog import oracles, queries  # the optional package has tests of its own

SF = "/root/testdata/sf0.001"
# Row-wise Python and pairings of everything with everything.
UNWANTED = ["PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"]
# Random draws per user are made by a helper in Python; its intervals have no SQL.
IN_PYTHON, WITHOUT_SQL = {"exact_resample_totals"}, {"bootstrap_intervals_exact"}
QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return compare.duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) | WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, connection, name):
    frame = QUERIES[name](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert [node for node in UNWANTED if node in plan] == [] or name in IN_PYTHON
    wanted = connection.sql(ORACLES[name])
    assert compare.difference(frame.toPandas(), wanted.df()) is None
    assert compare.type_difference(dict(frame.dtypes), dict(zip(wanted.columns, map(str, wanted.types)))) is None


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns == ["assigned_variant", "users", "activation_rate_7d"] and got.count() == 2
