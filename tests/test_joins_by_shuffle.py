"""Tables that grow with the rows meet by shuffle, also where the planner takes them for small ones."""

import random

import pytest
from pyspark.sql import functions as F

from gustgrid.operators.neighbors import idw_within, knn_join
from gustgrid.operators.sampling import hash_rank


def joins(df, column):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Join" in line and column in line.split("Join", 1)[1]]


def points(spark, n, seed):
    rng = random.Random(seed)
    rows = [(i % 3, i, round(rng.random() ** 3 * 50, 1), round(rng.random() * 80, 1), i % 4, rng.random()) for i in range(n)]
    return spark.createDataFrame(rows, "k int, id long, x double, y double, f int, v double").coalesce(1), rows


@pytest.mark.parametrize("spread", ["train", "query"])
def test_neighbours_are_not_broadcast(spark, spread):
    df, _ = points(spark, 300, 1)
    near = knn_join(df, df, 5, ["k"], train_cols=["v"], spread=spread)
    met = joins(near, "_cx")
    assert met and all("SortMergeJoin" in line for line in met)


def test_ranks_and_weights_are_not_broadcast(spark):
    df, _ = points(spark, 300, 2)
    ranked, weighted = joins(hash_rank(df, ["k"], "id", 1), "_b"), joins(idw_within(df, df, 3.0, ["k"], ["v"]), "q_id")
    assert ranked and weighted and all("SortMergeJoin" in line for line in ranked + weighted)


@pytest.mark.parametrize("spread", ["train", "query"])
@pytest.mark.parametrize("fold,maxdist,k", [(None, None, 5), ("f", None, 7), (None, 2.5, 4), ("f", 6.0, 1)])
def test_neighbours_of_skewed_points(spark, spread, fold, maxdist, k):
    """Against all pairs, with queries outside the extent and copies of locations."""
    df, rows = points(spark, 400, 3)
    asked = [(key, i, x * 1.4 - 8, y * 1.4 - 12, f, v) for key, i, x, y, f, v in rows[:200]] + rows[200:260]
    near = knn_join(spark.createDataFrame(asked, df.schema), df, k, ["k"], maxdist=maxdist, fold=fold, spread=spread)
    got = {}
    for r in near.orderBy("k", "q_id", "rank").collect():
        got.setdefault((r.k, r.q_id), []).append(r.t_id)
    want = {}
    for key, i, x, y, f, _ in asked:
        d = sorted(((x - b[2]) * (x - b[2]) + (y - b[3]) * (y - b[3]), b[1]) for b in rows if b[0] == key and not (fold and b[4] == f))
        found = [t for d2, t in d[:k] if maxdist is None or d2 <= maxdist**2]
        if found:
            want[key, i] = found
    assert got == want
