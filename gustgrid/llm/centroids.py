"""Centroid clustering of integer vectors in JVM expressions.

Components become integers, so every distance, sum and mean is exact and no order of rows shows.
Centroids are literal arrays in the plan: ``zip_with`` and ``aggregate`` give a vector's squared
distance to each, ``array_min`` of (distance, number) structs chooses the cluster with ties to the
smaller number. A round is one scan: assignment and column sums are combined map-side, so ``k`` rows
leave each task and ``k`` rows reach the driver, whatever the size of the table or of a cluster.

Defined cases: a vector with another number of components, a null or a non-finite one is left out;
a vector longer than ``LONGEST`` after scaling is cut (so that a distance fits 64 bits); equal
vectors are equal rows; fewer vectors than ``k`` give as many centroids; none give no rows. Inertias
beyond 64 bits read as the largest. A null id hashes as an empty one; rows that repeat an id are
ranked by their components.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, functions as F

from gustgrid.session import stage

# Vectors up to this length (Euclidean, after scaling) are as they are: squared distances of them and of their
# means stay below 2^63. In a longer one each component is cut to this magnitude over the root of their number.
LONGEST = 1 << 30
LONG_MAX = (1 << 63) - 1


def integer_vectors(vectors: DataFrame, vec_col: str, id_col: str, size: int, scale: int) -> DataFrame:
    """(_id, _v): the rows with ``size`` finite components, each as floor(scale * x), cut beyond ``LONGEST``."""
    x = F.col(vec_col)
    whole = F.size(x).eqNullSafe(size) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("double"))
    limit = float(int(LONGEST / math.sqrt(size)))
    square = F.aggregate("_s", F.lit(0.0), lambda s, c: s + c * c)
    cut = F.transform("_s", lambda c: F.greatest(F.lit(-limit), F.least(F.lit(limit), c)))
    return vectors.filter(F.coalesce(whole, F.lit(False))).select(F.col(id_col).alias("_id"), scaled.alias("_s")).select(
        "_id", F.when(square <= float(LONGEST) ** 2, F.col("_s")).otherwise(cut).cast("array<bigint>").alias("_v"))


def first_centroids(ints: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest sha256 of ``<seed>:<id>``, by hash."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    return [r["_v"] for r in ints.orderBy(key, "_v").limit(k).collect()]


def nearest(centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest of the literal centroids."""
    def far(number: int, centroid: list[int]) -> str:
        literal = f"CAST(split('{','.join(map(str, centroid))}', ',') AS ARRAY<BIGINT>)"
        squares = f"zip_with(_v, {literal}, (a, b) -> (a - b) * (a - b))"
        return f"named_struct('distance', aggregate({squares}, 0L, (s, d) -> s + d), 'cluster', {number})"

    return F.expr(f"array_min(array({', '.join(far(j, c) for j, c in enumerate(centroids))}))")


def update(ints: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Means of the clusters, rounded down; an empty cluster keeps its centroid."""
    size = len(centroids[0])
    assigned = ints.select(nearest(centroids).getField("cluster").alias("cluster"), "_v")
    sums = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.get("_v", F.lit(i)).cast("decimal(18,0)")).alias(f"s{i}") for i in range(size)))
    moved = list(centroids)
    for r in sums.collect():
        moved[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(size)]
    return moved


def _saturated(total: Column) -> Column:
    return F.least(total, F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")


def cluster_vectors(
    vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, size: int = 64, scale: int = 256,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance, cluster_inertia, inertia) of every kept vector, and the final centroids.

    ``k`` times ``size`` numbers pass through the driver each round; both are parameters.
    """
    ints = integer_vectors(vectors, vec_col, id_col, size, scale)
    centroids = first_centroids(ints, k, seed)
    if not centroids:
        empty = "CAST(NULL AS INT) AS cluster, CAST(NULL AS BIGINT) AS distance, CAST(NULL AS BIGINT) AS cluster_inertia, CAST(NULL AS BIGINT) AS inertia"
        return ints.selectExpr(f"_id AS `{id_col}`", *empty.split(", ")), []
    for _ in range(rounds):
        centroids = update(ints, centroids)
    assigned = stage(ints.select("_id", nearest(centroids).alias("_n")).select("_id", "_n.cluster", "_n.distance"), "clusters")
    by_cluster = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)")).alias("d"))
    totals = {r["cluster"]: int(r["d"]) for r in by_cluster.collect()}
    of_cluster = F.get(F.lit([str(totals.get(j, 0)) for j in range(len(centroids))]), F.col("cluster")).cast("decimal(38,0)")
    rows = assigned.select(
        F.col("_id").alias(id_col), "cluster", "distance", _saturated(of_cluster).alias("cluster_inertia"),
        _saturated(F.lit(str(sum(totals.values()))).cast("decimal(38,0)")).alias("inertia"))
    return rows, centroids


def centroid_digests(centroids: list[list[int]]) -> list[str]:
    """sha256 (lowercase hex) of each centroid's components in decimal, joined by commas."""
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
