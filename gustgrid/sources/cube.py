"""Gridded cubes to point rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gustgrid.functions.times import hour_columns


def explode_cube(cubes: DataFrame, source_model: str = "unknown") -> DataFrame:
    """One row per (time, iy, ix).

    A cube row has ``time``, axes ``x`` (nx) and ``y`` (ny), and row-major arrays ``lat, lon, dir,
    mod, topo`` (ny*nx). Values are narrowed to 32 bits as in the published hours.
    """
    cells = F.posexplode(F.arrays_zip("lat", "lon", "dir", "mod", "topo")).alias("pos", "c")
    out = cubes.select("time", "x", "y", cells).selectExpr("*", "CAST(pos % size(x) AS INT) AS ix", "CAST(pos div size(x) AS INT) AS iy")
    rows = out.select(
        "time", "ix", "iy", F.get("x", F.col("ix")).alias("x"), F.get("y", F.col("iy")).alias("y"),
        F.col("c.lon").alias("lon"), F.col("c.lat").alias("lat"),
        *(F.col(f"c.{a}").cast("float").alias(b) for a, b in (("topo", "topo"), ("dir", "wind_dir"), ("mod", "wind_speed"))),
        F.lit(source_model).alias("source_model"),
    )
    return rows.withColumns(hour_columns(F.col("time")))
