"""Variograms from packed blocks against all pairs, and bins that are made once."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gustgrid.operators import blocks
from gustgrid.operators.variogram import empirical_variogram, fit_variogram


@pytest.mark.parametrize("size", [3, 1000])
def test_each_pair_of_neighbouring_cells_once(spark, size):
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.choice([0, 0, 0, 0, 1, 2, 5]), rng.choice([0, 0, -1, 1]), i) for i in range(160)]
    met = blocks.packed_pairs(spark.createDataFrame(rows, "k int, _cx long, _cy long, i int"), ["k"], ["_cx", "_cy"], size).collect()
    got = []
    for r in met:
        a, b = [x.i for x in r.a], [x.i for x in r.b]
        got += [frozenset((x, y)) for n, x in enumerate(a) for y in (b[n + 1 :] if r.same else b)]
    want = {
        frozenset((p[3], q[3])) for n, p in enumerate(rows) for q in rows[n + 1 :]
        if p[0] is not None and p[0] == q[0] and abs(p[1] - q[1]) <= 1 and abs(p[2] - q[2]) <= 1
    }
    assert len(got) == len(set(got)) and set(got) == want


def test_variogram_with_copies_and_gaps(spark, monkeypatch):
    """Places with several rows, rows without a value, and rows without a place or key."""
    monkeypatch.setattr(blocks.packed_pairs, "__defaults__", (20,))
    rng = random.Random(6)
    pts = [(rng.choice([1, 2, None]), rng.choice([None, *range(12)]), float(rng.randrange(9)), rng.choice([None, rng.gauss(0, 1)]), rng.gauss(0, 1)) for _ in range(400)]
    pts = [(k, None if x is None else float(x), y, u, v) for k, x, y, u, v in pts]
    got = {(r.k, r.var, r.bin): (r.np, r.dist, r.gamma) for r in empirical_variogram(
        spark.createDataFrame(pts, "k int, x double, y double, u double, v double"), ["k"], ["u", "v"], 5.0, 1.5).collect()}
    want = {}
    for n, a in enumerate(pts):
        for b in pts[n + 1 :]:
            if a[0] is None or a[0] != b[0] or a[1] is None or b[1] is None:
                continue
            d = math.hypot(a[1] - b[1], a[2] - b[2])
            for var, p, q in (("u", a[3], b[3]), ("v", a[4], b[4])):
                if 0 < d <= 5 and p is not None and q is not None:
                    at = (a[0], var, math.ceil(d / 1.5))
                    m, s, g = want.get(at, (0, 0.0, 0.0))
                    want[at] = m + 1, s + d, g + (p - q) ** 2
    assert set(got) == set(want)
    for at, (m, s, g) in want.items():
        assert got[at][0] == m and got[at][1] == pytest.approx(s / m) and got[at][2] == pytest.approx(g / m / 2)


def test_bins_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def noted(g):
        made.add(1)
        return g

    rows = [(1, "u", i, 50, float(i), 1 - math.exp(-i / 3)) for i in range(1, 9)]
    bins = spark.createDataFrame(rows, "pk int, var string, bin int, np long, dist double, gamma double").withColumn("gamma", noted("gamma"))
    assert fit_variogram(bins, ["pk"], 8.0, 1.0).count() == 3
    assert made.value == len(rows)
