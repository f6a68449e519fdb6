"""Boxes, region selection and region edits (G6, G8-G10), on whole datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gustgrid.functions.geometry import in_ring, near_ring, python_bounds
from gustgrid.functions.text import non_empty

# Column names tried for longitude and latitude, in order.
LON_NAMES = ("lon", "longitude", "x")
LAT_NAMES = ("lat", "latitude", "y")


def first_present(df: DataFrame, names: Sequence[str]) -> str | None:
    return next((n for n in names if n in df.columns), None)


def bbox(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Box of each key over the first usable coordinate columns."""
    lon, lat = first_present(df, LON_NAMES), first_present(df, LAT_NAMES)
    if lon is None or lat is None:
        raise ValueError("no coordinate columns")
    return df.groupBy(*keys).agg(
        F.min(lon).alias("min_lon"), F.min(lat).alias("min_lat"), F.max(lon).alias("max_lon"), F.max(lat).alias("max_lat")
    )


def merge_bbox(boxes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Union of boxes; NULL boxes are ignored."""
    return boxes.groupBy(*keys).agg(
        F.min("min_lon").alias("min_lon"), F.min("min_lat").alias("min_lat"),
        F.max("max_lon").alias("max_lon"), F.max("max_lat").alias("max_lat"),
    )


def points_in_polygon(df: DataFrame, ring, x="lon", y="lat") -> DataFrame:
    return df.filter(in_ring(F.col(x), F.col(y), ring))


def points_near_polygon(df: DataFrame, ring, distance: float, x="x", y="y") -> DataFrame:
    """Rows inside the ring widened by ``distance``, in the units of x and y."""
    return df.filter(near_ring(F.col(x), F.col(y), ring, distance))


def region_report(df: DataFrame, regions: dict[str, Sequence], keys: Sequence[str], x="lon", y="lat") -> DataFrame:
    """Region box, points box and number of points inside, per region and key, in one scan."""
    counts = [F.count_if(in_ring(F.col(x), F.col(y), ring)).alias(f"n{i}") for i, ring in enumerate(regions.values())]
    boxes = [F.min(x).alias("min_lon"), F.min(y).alias("min_lat"), F.max(x).alias("max_lon"), F.max(y).alias("max_lat")]
    names = ("region_min_lon", "region_min_lat", "region_max_lon", "region_max_lat")
    rows = F.array(*(
        F.struct(
            F.lit(name).alias("region_name"),
            *(F.lit(v).alias(n) for n, v in zip(names, python_bounds(ring))),
            F.col(f"n{i}").alias("points_inside"),
        )
        for i, (name, ring) in enumerate(regions.items())
    ))
    agg = df.groupBy(*keys).agg(*boxes, *counts)
    return agg.select(*keys, "min_lon", "min_lat", "max_lon", "max_lat", F.inline(rows))


def region_label(region: Column) -> Column:
    return F.coalesce(non_empty(region["region_name"]), non_empty(region["name"]))


def pick_region(regions: Column, name: str | None = None) -> Column:
    """First region, or the first with this name; an error if there is none."""
    found = regions if name is None else F.filter(regions, lambda r: region_label(r) == name)
    first = F.try_element_at(found, F.lit(1))
    return F.when(first.isNotNull(), first).otherwise(F.raise_error(F.lit(f"region not found: {name or 'any'}")))


def add_region(regions: Column, name: str, ring: Sequence) -> Column:
    if not name or not ring:
        raise ValueError("a region needs a name and a polygon")
    entry = F.struct(
        F.lit(name).alias("region_name"), F.lit(None).cast("string").alias("name"),
        F.array(*(F.array(F.lit(float(a)), F.lit(float(b))) for a, b in ring)).alias("polygon"),
    )
    return F.concat(F.coalesce(regions, F.filter(F.array(entry), lambda r: F.lit(False))), F.array(entry))


def remove_region(regions: Column, name: str) -> Column:
    """Drop regions that carry this name in either name field."""
    return F.filter(
        regions, lambda r: ~(r["region_name"].eqNullSafe(F.lit(name)) | r["name"].eqNullSafe(F.lit(name)))
    )
