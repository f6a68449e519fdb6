"""Rows are not broadcast to their few coefficients, however small their file is."""

from gustgrid.operators.trend import detrend
from gustgrid.session import stage


def test_rows_meet_coefficients_by_shuffle(spark):
    rows = spark.range(4000).selectExpr("CAST(id % 3 AS INT) AS k", "id % 7 * 1D AS x", "id % 11 * 1D AS y", "id % 5 * 1D AS topo", "id * 0.5D AS u")
    out = detrend(stage(rows, "rows"), ["k"], ["u"])
    assert out.count() == 4000
    plan = out._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "topo" not in line]
    assert "SortMergeJoin" in plan and "BuildLeft" not in plan and joins
