"""Queries of the subpackage against their SQL; the native ones run no Python on executors."""

import os

import pytest
from checks.compare import compare
from trackspark.llm.queries import ORACLES, QUERIES

from .helpers import SF_DIR

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")
NATIVE = ("op2_", "op5_", "op7_", "op9_")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    ok, message = compare(spark, SF_DIR, name, QUERIES[name], ORACLES[name])
    assert ok, message


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if q.startswith(NATIVE)))
def test_native_queries_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for banned in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert banned not in plan


def test_all_are_registered():
    import __spark_entry__ as driver

    numbers = {int(n[2:].split("_")[0]) for n in driver.queries() if n.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in driver.queries()
