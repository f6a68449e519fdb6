"""Every registered query against its oracle on the smallest tables, and its join strategies."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    built = {}

    def once(s, d):
        built["df"] = QUERIES[name](s, d)
        return built["df"]

    assert compare(spark, duck, SF, name, once, ORACLES.get(name)) is None
    plan = built["df"]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
