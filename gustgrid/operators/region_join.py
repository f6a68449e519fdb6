"""Points in many regions at once: rings are rows, not plans.

The edges of all rings form one table, cut into slabs of y. A point lies in one slab, so points and edges
meet in an equi-join on the key and the slab, and a point is inside a ring if the edges of its slab that
cross the ray to its right are odd in number. The counts are summed map-side: all edges a point can
cross meet it in one task. Rings of any number of edges, and any number of rings, take the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gustgrid.functions.geometry import ring_bounds, ring_edges

# Slabs over the height of all rings together.
SLABS = 1024


def ring_edge_table(rings: DataFrame, keys: Sequence[str], region: str, ring: str = "ring", distance: str = "0D") -> DataFrame:
    """(keys, region, reach, box of the ring widened by it, x1, y1, x2, y2): one row per edge.

    ``ring`` is array<struct<lon, lat>>; rings without points have no edges. ``distance`` is SQL of the reach.
    """
    boxed = rings.filter(F.size(ring) > 0).select(
        *keys, region, F.expr(f"CAST({distance} AS DOUBLE)").alias("reach"), ring_edges(F.col(ring)).alias("edges"),
        *(c.alias(n) for n, c in zip(("rx0", "ry0", "rx1", "ry1"), ring_bounds(F.col(ring)))))
    return boxed.select(
        *keys, region, "reach", (F.col("rx0") - F.col("reach")).alias("rx0"), (F.col("rx1") + F.col("reach")).alias("rx1"),
        (F.col("ry0") - F.col("reach")).alias("ry0"), (F.col("ry1") + F.col("reach")).alias("ry1"), F.inline("edges"))


def points_in_regions(
    points: DataFrame, rings: DataFrame, keys: Sequence[str], id_cols: Sequence[str], region: str, x: str = "x", y: str = "y",
    ring: str = "ring", distance: str = "0D", slabs: int = SLABS,
) -> DataFrame:
    """(keys, id_cols, region) of every point and each ring of its keys that contains it (boundary included).

    ``distance`` is SQL over ``rings`` of how far outside a point may lie. Points with NULL coordinates or ids that
    repeat count once each and in no region, respectively once. The lowest and highest y of the rings reach the driver.
    """
    keys, id_cols = list(keys), list(id_cols)
    edges = ring_edge_table(rings, keys, region, ring, distance)
    low, high = edges.agg(F.min("ry0"), F.max("ry1")).first()
    if low is None:
        return points.select(*keys, *id_cols, F.lit(None).cast(rings.schema[region].dataType).alias(region)).filter("false")
    height = (high - low) / slabs or 1.0
    slab = f"CAST(floor(({{}} - {low!r}D) / {height!r}D) AS BIGINT)"
    cut = edges.selectExpr("*", f"explode(sequence({slab.format('least(y1, y2) - reach')}, {slab.format('greatest(y1, y2) + reach')})) AS slab")
    own = points.selectExpr(*keys, *id_cols, f"CAST({x} AS DOUBLE) AS px", f"CAST({y} AS DOUBLE) AS py").filter(f"py >= {low!r}D AND py <= {high!r}D").distinct()
    own = own.withColumn("slab", F.expr(slab.format("py")))
    # A crossed edge reaches beyond the point; a close one may be anywhere in the widened box.
    met = own.join(cut, [*keys, "slab"]).filter("px >= rx0 AND px <= rx1 AND py >= ry0 AND py <= ry1 AND (greatest(x1, x2) >= px OR reach > 0)")
    crosses = "(y1 > py) <> (y2 > py) AND px < (x2 - x1) * (py - y1) / nullif(y2 - y1, 0D) + x1"
    touches = ("(x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) = 0 AND px BETWEEN least(x1, x2) AND greatest(x1, x2) AND py BETWEEN least(y1, y2) AND greatest(y1, y2)")
    # Nearest place of the edge: its share of the way from the first end to the second.
    share = "coalesce(greatest(0D, least(1D, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0D))), 0D)"
    close = "pow(px - x1 - way * (x2 - x1), 2) + pow(py - y1 - way * (y2 - y1), 2) <= reach * reach"
    tested = met.selectExpr("*", f"{share} AS way").selectExpr(
        *keys, *id_cols, region, "px", "py", f"CASE WHEN {crosses} THEN 1 ELSE 0 END AS crossed", f"({touches}) OR (reach > 0 AND {close}) AS on_edge")
    found = tested.groupBy(*keys, *id_cols, region, "px", "py").agg(F.sum("crossed").alias("crossed"), F.max("on_edge").alias("on_edge"))
    return found.filter("on_edge OR crossed % 2 = 1").select(*keys, *id_cols, region)
