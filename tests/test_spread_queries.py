"""Few queries are copied to the cells around them, and their candidates are never rows."""

import pytest

from gustgrid.operators import neighbors
from gustgrid.operators.kriging import gather_neighbors
from gustgrid.plans import interpolate as interp
from tests.test_knn_arrays import SCHEMA, rows


@pytest.mark.parametrize("fold,k,repeat,crowd,pack", [
    (None, 5, False, 2000, 1000), ("f", 7, True, 2000, 3), ("f", 4, True, 10, 1000), (None, 1, True, 2000, 1000)])
def test_same_as_rows(spark, monkeypatch, fold, k, repeat, crowd, pack):
    monkeypatch.setattr(neighbors, "PACK_ROWS", pack)
    monkeypatch.setattr(neighbors, "_crowd", lambda k: crowd)
    train = spark.createDataFrame(rows(300, 1), SCHEMA)
    asked = rows(150, 2, repeat)
    asked = spark.createDataFrame([(r[0], r[1], r[2] * 1.3 - 5, r[3] * 1.3 - 5, *r[4:]) for r in asked] + rows(60, 1), SCHEMA)
    options = dict(fold=fold, train_cols=["v", "name"], spread="query")
    want = gather_neighbors(neighbors.knn_join(asked, train, k, ["k"], **options), ["k"], ["v", "name"])
    got = neighbors.knn_arrays(asked, train, k, ["k"], query_cols=["f"], **options)
    key = lambda r: repr((r.k, r.q_id, [tuple(e) for e in r.nb]))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    assert got.schema["nb"].dataType.simpleString() == want.schema["nb"].dataType.simpleString()


def test_hold_out_sorts_no_pairs(spark):
    nodes = spark.createDataFrame([r for r in rows(300, 3) if r[0] is not None], SCHEMA).selectExpr(
        "k", "id AS node_key", "x AS x_local", "y AS y_local", "v AS u", "1 - v AS v", "id % 5 = 0 AS is_test")
    fits = nodes.select("k").distinct().selectExpr("k", "explode(array('u', 'v')) AS var", "'Exp' AS model", "0.1D AS nugget", "1D AS psill", "9D AS range")
    scores = interp.holdout_metrics(nodes, fits, ["k"], 6)
    assert scores.count() == 6
    plan = scores._jdf.queryExecution().executedPlan().toString()
    # Pairs are rows, and sorted, only where a cell is crowded.
    ranked = [line for line in plan.splitlines() if "WindowGroupLimit" in line and "d2" in line]
    assert plan.count("MapInArrow") == 2 and ranked and all("_cx" in line for line in ranked)


def test_depths_are_tried_as_needed(spark, monkeypatch):
    """Cells finer than the average density's are counted only where that is crowded."""
    depths, cell = [], neighbors._Grid.cell
    monkeypatch.setattr(neighbors._Grid, "cell", lambda grid, x, y: depths.append(grid.finer) or cell(grid, x, y))
    even = spark.range(2000).selectExpr("1 AS k", "id", "CAST(id % 50 AS DOUBLE) AS x", "CAST(id DIV 50 AS DOUBLE) AS y")
    dense = even.unionByName(spark.range(3000).selectExpr("1 AS k", "id + 5000 AS id", "20.5 + id * 1e-7 AS x", "20.5 + (id % 55) * 1e-6 AS y"))
    assert neighbors._grid_of(even.selectExpr("k", "x AS t_x", "y AS t_y"), ["k"], 4.0).finer == 0 and depths == [0]
    assert neighbors._grid_of(dense.selectExpr("k", "x AS t_x", "y AS t_y"), ["k"], 4.0).finer > 5
    near = neighbors.knn_join(even, dense, 3, ["k"]).filter("rank = 1")
    assert near.count() == 2000 and near.filter("d2 > 0").count() == 0


def test_counts_of_near_cells_meet(spark):
    """Counts are copied to the cells around them where those lie in the same task, so few partial sums are shuffled."""
    even = spark.range(20000).selectExpr("1 AS k", "id", "CAST(id % 200 AS DOUBLE) AS t_x", "CAST(id DIV 200 AS DOUBLE) AS t_y")
    grid = neighbors._grid_of(even, ["k"], 4.0)
    train = even.selectExpr("*", *grid.cell("t_x", "t_y"))
    levels = neighbors._query_levels(train, train, grid, ["k"], 4, None)
    assert levels.count() == train.select("_fx", "_fy").distinct().count()
    assert "shiftright(_cx" in levels._jdf.queryExecution().executedPlan().toString()


def test_bounded_neighbours_are_not_broadcast(spark):
    """Queries copied to the cells around them outgrow a broadcast, though their file is small."""
    df = spark.createDataFrame([r for r in rows(300, 5) if r[0] is not None], SCHEMA).coalesce(1)
    near = neighbors.knn_join(df, df, 5, ["k"], train_cols=["v"], maxdist=2.5, spread="query")
    plan = near._jdf.queryExecution().executedPlan().toString().splitlines()
    met = [line for line in plan if "Join" in line and "_cx" in line.split("Join", 1)[1]]
    assert met and all("SortMergeJoin" in line for line in met)
