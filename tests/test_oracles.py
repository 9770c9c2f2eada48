"""Every registered query against its SQL, or at least its shape."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import duck, duck_rows, spark_rows
from turntable.checks.oracles import ORACLES
from turntable.checks.registered import REGISTERED

ROWS_ONLY = {"als_model_runs", "als_recommendations", "als_artist_recommendations"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql_or_a_reason():
    assert set(REGISTERED) - set(ORACLES) == ROWS_ONLY


# No plan may multiply rows blindly or leave the JVM.
UNWANTED = "CartesianProduct BroadcastNestedLoopJoin BatchEvalPython ArrowEvalPython MapInPandas".split()


def checked(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in UNWANTED if operator in plan]
    return df


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, connection, sf_dir, name):
    assert spark_rows(checked(queries()[name](spark, sf_dir))) == duck_rows(connection, oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_some_rows(spark, sf_dir, name):
    assert checked(queries()[name](spark, sf_dir)).count() > 0
