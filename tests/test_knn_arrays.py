"""Neighbours chosen from arrays are those of the join of rows, also for crowded blocks and repeated ids."""

import random

import pytest
from pyspark.sql import functions as F

from gustgrid.operators import neighbors
from gustgrid.operators.kriging import gather_neighbors

SCHEMA = "k int, id long, x double, y double, f int, v double, name string"


def rows(n, seed, repeat=False):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        place = (float(rng.randrange(12)), float(rng.randrange(9))) if rng.random() < 0.4 else (rng.random() ** 3 * 50, rng.random() * 80)
        ident = rng.choice([None, i // 3]) if repeat else i
        out.append((rng.choice([0, 1, 2, None]), ident, *place, rng.choice([0, 1, 2, 3, None]), rng.choice([None, rng.random()]), f"n{i % 7}"))
    return out


@pytest.mark.parametrize("fold,k,repeat,crowd,pack", [
    (None, 5, False, 2000, 1000), ("f", 7, True, 2000, 3), ("f", 4, True, 40, 1000), (None, 1, True, 2000, 1000)])
def test_same_as_rows(spark, monkeypatch, fold, k, repeat, crowd, pack):
    monkeypatch.setattr(neighbors, "PACK_ROWS", pack)
    monkeypatch.setattr(neighbors, "_crowd", lambda k: crowd)
    train = spark.createDataFrame(rows(300, 1), SCHEMA)
    asked = rows(150, 2, repeat)
    asked = spark.createDataFrame([(r[0], r[1], r[2] * 1.3 - 5, r[3] * 1.3 - 5, *r[4:]) for r in asked] + rows(60, 1), SCHEMA)
    asked = asked.withColumn("mark", F.concat("name", F.lit("x")))
    options = dict(fold=fold, train_cols=["v", "name"])
    pairs = neighbors.knn_join(asked, train, k, ["k"], **options)
    want = gather_neighbors(pairs, ["k"], ["v", "name"])
    got = neighbors.knn_arrays(asked, train, k, ["k"], query_cols=["mark"], **options)
    key = lambda r: repr((r.k, r.q_id, [tuple(e) for e in r.nb]))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    assert got.schema["nb"].dataType.simpleString() == want.schema["nb"].dataType.simpleString()


def test_aggregates_of_arrays(spark):
    df = spark.createDataFrame([r for r in rows(200, 4) if r[0] is not None], SCHEMA)
    pairs = neighbors.knn_join(df, df, 6, ["k"], train_cols=["v"])
    want = gather_neighbors(pairs, ["k"], ["v"], extra=[neighbors.idw_aggregate("v").alias("w"), *neighbors.neighbor_aggregates(3.0)])
    got = neighbors.knn_arrays(df, df, 6, ["k"], train_cols=["v"]).select("k", "q_id", neighbors.idw_of("nb", "v").alias("w"), *neighbors.neighbor_counts("nb", 3.0))
    columns = ["k", "q_id", "w", "nearest_distance", "neighbors_used"]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*columns).collect()))
