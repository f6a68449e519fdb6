"""Writing hourly datasets: ingested cubes and interpolated grids, each with its sidecars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gustgrid.functions.geometry import lonlat_to_wkb
from gustgrid.sources.cube import explode_cube
from gustgrid.sources.hours import HOUR_KEYS, write_hourly, write_sidecars


def with_hour_keys(df: DataFrame) -> DataFrame:
    """Partition columns from ``date`` (YYYY-MM-DD); ``hour`` is already one."""
    return df.withColumns({k: F.substring("date", a, n) for k, a, n in (("year", 1, 4), ("month", 6, 2), ("day", 9, 2))})


def ingest_cubes(cubes: DataFrame, root: str, source_model: str = "unknown", files_per_hour: int = 1) -> None:
    """Cubes to hourly point rows: WKB geometry instead of lon/lat, no lattice indices."""
    rows = explode_cube(cubes, source_model).withColumn("geometry", lonlat_to_wkb("lon", "lat"))
    write_hourly(rows.drop("ix", "iy", "lon", "lat"), root, files_per_hour)


def publish_grid(grid: DataFrame, root: str, sidecars: DataFrame | None = None, files_per_hour: int = 1) -> None:
    """Interpolated grid keyed by (date, hour), with geometry; and one sidecar per hour if given."""
    rows = with_hour_keys(grid).withColumn("geometry", lonlat_to_wkb("lon", "lat"))
    write_hourly(rows, root, files_per_hour)
    if sidecars is not None:
        write_sidecars(sidecars, root, HOUR_KEYS)
