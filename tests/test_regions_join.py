"""Points in many rings by slabs, against testing each ring on its own."""

import math
import random

from pyspark.sql import functions as F

from gustgrid.functions.geometry import in_ring, near_ring
from gustgrid.operators.region_join import points_in_regions

RING = "k int, region string, ring array<struct<lon:double,lat:double>>"


def star(x, y, size, n, rng):
    return [(x + size * (0.4 + 0.6 * rng.random()) * math.cos(2 * math.pi * i / n), y + size * (0.4 + 0.6 * rng.random()) * math.sin(2 * math.pi * i / n)) for i in range(n)]


def test_many_rings_of_many_edges(spark):
    rng = random.Random(5)
    rings = [(k, f"r{i}", star(rng.uniform(0, 10), rng.uniform(0, 10), rng.uniform(0.5, 4), rng.choice([3, 5, 100, 300]), rng)) for k in (1, 2) for i in range(8)]
    rings += [(1, "square", [(2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0), (2.0, 2.0)]), (1, "empty", []), (2, "none", None)]
    points = [(1 + i % 2, i, rng.uniform(-1, 11), rng.uniform(-1, 11)) for i in range(600)]
    # On edges and corners of the square, and NULL coordinates.
    points += [(1, 1000, 2.0, 3.0), (1, 1001, 4.0, 4.0), (1, 1002, 3.0, 2.0), (1, 1003, None, 3.0), (1, 1000, 2.0, 3.0)]
    df, table = spark.createDataFrame(points, "k int, id int, x double, y double"), spark.createDataFrame(rings, RING)
    for distance in (0.0, 0.7):
        for slabs in (3, 1024):
            got = [tuple(r) for r in points_in_regions(df, table, ["k"], ["id"], "region", distance=f"{distance}D", slabs=slabs).collect()]
            assert len(got) == len(set(got))
            want = set()
            for k, name, ring in rings:
                if ring:
                    test = near_ring(F.col("x"), F.col("y"), ring, distance) if distance else in_ring(F.col("x"), F.col("y"), ring)
                    want |= {(k, r.id, name) for r in df.filter((F.col("k") == k) & test).collect()}
            assert set(got) == want
    assert points_in_regions(df, table.filter("false"), ["k"], ["id"], "region").count() == 0
