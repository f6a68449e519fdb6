"""Centroid clustering against exact integer arithmetic in Python."""

import hashlib
import math
import random

import pytest

from gustgrid.llm.centroids import LONGEST, centroid_digests, cluster_vectors


def brute(rows, k, rounds, size, scale=256, seed=2):
    kept = []
    for ident, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            v = [math.floor(scale * x) for x in v]
            limit = int(LONGEST / math.sqrt(size))
            kept.append((ident, v if sum(x * x for x in v) <= LONGEST**2 else [max(-limit, min(limit, x)) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        groups = {}
        for (_, v), (_, j) in zip(kept, assign()):
            groups.setdefault(j, []).append(v)
        for j, vs in groups.items():
            cents[j] = [sum(col) // len(vs) for col in zip(*vs)]
    final, inertia = assign(), {}
    for d, j in final:
        inertia[j] = inertia.get(j, 0) + d
    big = (1 << 63) - 1
    out = [(ident, j, d, min(big, inertia[j]), min(big, sum(inertia.values()))) for (ident, _), (d, j) in zip(kept, final)]
    return sorted(out, key=str), cents


@pytest.mark.parametrize("kind", ["double", "float"])
def test_against_brute_force(spark, kind):
    rng = random.Random(3)
    rows = [(i, [round(rng.gauss(0, 1) * 64) / 64 + (i % 3) for _ in range(4)]) for i in range(120)]
    rows += [(200, [0.5, None, 1.0, 1.0]), (201, [1.0, float("nan"), 0.0, 0.0]), (202, [1.0, float("-inf"), 0.0, 0.0]), (203, [1.0] * 3), (204, None),
             (205, []), (7, [9.0] * 4), (7, [9.0] * 4), (None, [-3.0] * 4), (206, [3e30, -3e30, 0.0, 0.0]), (207, [2.0e6, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, cluster string, _v int").repartition(5)
    got, cents = cluster_vectors(df, k=6, rounds=4, size=4)
    want, final = brute(rows, 6, 4, 4)
    assert cents == final
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert centroid_digests(cents)[0] == hashlib.sha256(",".join(map(str, cents[0])).encode()).hexdigest()


def test_ties_few_and_no_vectors(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, cents = cluster_vectors(df, k=40, rounds=3, size=2)
    want, final = brute(rows, 40, 3, 2)
    assert len(cents) == 3 and cents == final and sorted((tuple(r) for r in got.collect()), key=str) == want
    none, cents = cluster_vectors(df.filter("false"), size=2)
    assert none.collect() == [] and cents == [] and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia"]
