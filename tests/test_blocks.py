"""Blocked joins against plain ones, with hot keys, and how evenly their pairs are dealt."""

import random

from pyspark.sql import functions as F

from gustgrid.operators.blocks import blocked_join, blocked_pairs
from gustgrid.operators.neighbors import range_join
from gustgrid.operators.numbering import row_numbers
from gustgrid.operators.variogram import empirical_variogram


def frame(spark, name, n, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot"] * 4 + ["a", "b", "c"]) if i % 9 else None, f"{name}{i}") for i in range(n)]
    return spark.createDataFrame(rows, f"k string, {name} string")


def test_join_equals_a_plain_join(spark):
    left, right = frame(spark, "x", 150, 1), frame(spark, "y", 90, 2)
    for size in (7, 40, 1000):
        got = blocked_join(left, right, ["k"], size)
        assert got.columns == ["k", "x", "y"]
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
    assert blocked_join(left.filter("false"), right, ["k"]).count() == 0


def test_each_pair_once(spark):
    rows = frame(spark, "x", 120, 3).filter("k IS NOT NULL")
    for size in (5, 1000):
        pairs = blocked_pairs(rows, ["k"], {"a": "x"}, {"b": "x"}, size).filter("_ordered OR a < b").collect()
        got = [tuple(sorted((r.a, r.b))) for r in pairs]
        by_key = {}
        for r in rows.collect():
            by_key.setdefault(r.k, []).append(r.x)
        want = {tuple(sorted((a, b))) for xs in by_key.values() for i, a in enumerate(xs) for b in xs[i + 1 :]}
        assert len(got) == len(set(got)) and set(got) == want


def test_a_hot_cell_is_many_tasks(spark):
    """All points within one cutoff: no task of the pair join gets more than a small share of the rows."""
    n = 4000
    points = spark.range(n).selectExpr("id", "rand(1) AS x", "rand(2) AS y", "1D AS v")
    near = range_join(points, points.selectExpr("id AS t_id", "x", "y"), 10.0, [], train_cols=["t_id"])
    counted = near.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()
    assert sum(r.n for r in counted) == n * n
    assert max(r.n for r in counted) <= 0.6 * n * n and len(counted) >= 4


def test_variogram_of_one_cell(spark):
    rng = random.Random(4)
    pts = [(1, rng.random() * 3, rng.random() * 3, rng.gauss(0, 1)) for _ in range(1500)] + [(2, 0.0, 0.0, 1.0), (2, 0.0, 1.0, 3.0)]
    got = {(r.k, r.bin): (r.np, r.gamma) for r in empirical_variogram(spark.createDataFrame(pts, "k int, x double, y double, v double"), ["k"], ["v"], 5.0, 1.0).collect()}
    want = {}
    for i, (k, x, y, v) in enumerate(pts):
        for k2, x2, y2, v2 in pts[i + 1 :]:
            d = ((x - x2) ** 2 + (y - y2) ** 2) ** 0.5
            if k == k2 and 0 < d <= 5:
                bin_ = -(-d // 1)
                n, s = want.get((k, bin_), (0, 0.0))
                want[k, bin_] = n + 1, s + (v - v2) ** 2
    assert set(got) == set(want)
    assert all(got[b][0] == n and abs(got[b][1] - s / n / 2) < 1e-9 for b, (n, s) in want.items())


def test_row_numbers(spark):
    rng = random.Random(8)
    rows = [(rng.randrange(5), rng.choice(["x", "y", None])) for _ in range(300)]
    got = [tuple(r) for r in row_numbers(spark.createDataFrame(rows, "a int, b string").repartition(7), ["a", "b"]).orderBy("number").collect()]
    assert [n for *_, n in got] == list(range(1, 301))
    assert [(a, b) for a, b, _ in got] == sorted(rows, key=lambda r: (r[0], r[1] or ""))
    assert row_numbers(spark.createDataFrame([], "a int"), ["a"]).count() == 0
