"""From ingested hours to interpolation inputs, with projection, region and test points of each hour.

The sidecar of an hour names its projection, region and points. They are columns of a small table keyed
by the hour: projections as their constants, regions as rings whose edges meet the nodes in a join. So all
hours are loaded and interpolated by one plan, however many settings a dataset has. Hours that cannot be
loaded are explained in ``status`` and take no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gustgrid.functions.crs import CONSTANTS, ByRow, normalize_crs, projection_constants, resolve_crs
from gustgrid.functions.geometry import in_box, ring_bounds, ring_from_pairs, wkb_to_lonlat
from gustgrid.operators.lattice import anchor_offset
from gustgrid.operators.projection import project
from gustgrid.operators.region_join import points_in_regions
from gustgrid.operators.regions import region_label
from gustgrid.params import InterpolationParams
from gustgrid.plans.interpolate import Interpolation, interpolate, prepare_nodes
from gustgrid.session import stage
from gustgrid.sources.hours import HOUR_KEYS, read_sidecars, scan_partitions

NO_CRS, BAD_CRS, NO_REGION = "projection metadata missing", "projection not supported", "region missing"


@dataclass(frozen=True)
class Hours:
    """Nodes of all usable hours with anchored grid coordinates; (keys, crs, projection, ring) and (keys, name, lon, lat) of each."""

    nodes: DataFrame
    settings: DataFrame
    points: DataFrame
    status: DataFrame
    keys: list[str] = field(default_factory=lambda: list(HOUR_KEYS))


def with_lonlat(rows: DataFrame) -> DataFrame:
    """Longitude and latitude of rows that only have a WKB ``geometry``."""
    if {"lon", "lat"} <= set(rows.columns):
        return rows
    return rows.withColumn("_p", wkb_to_lonlat("geometry")).withColumns({"lon": F.col("_p.lon"), "lat": F.col("_p.lat")}).drop("_p")


def hour_settings(docs: DataFrame, file_crs: Column | None = None) -> DataFrame:
    """(hour keys, crs, regions, test_points) of sidecar documents: the first usable projection text, normalised."""
    fields = ("nc_proj_string", "crs", "projection", "proj4", "proj4text", "proj4_string")
    sidecar = F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*map(F.col, fields)))
    attributes = F.col("netcdf_attributes.global")
    crs = resolve_crs(sidecar, attributes, F.lit(None).cast("string") if file_crs is None else file_crs, F.array(*map(F.col, fields)))
    return docs.select(*HOUR_KEYS, F.when(F.upper(crs).startswith("EPSG:"), crs).otherwise(normalize_crs(crs)).alias("crs"), "regions", "test_points")


def load_hours(
    spark: SparkSession, root: str, date: str | None = None, hour: str | None = None, region: str | None = None, buffer_m: float = 0.0
) -> Hours:
    """Nodes of the hours under ``root`` with their settings.

    ``region`` names the sidecar region to keep (``None`` keeps all nodes); nodes up to ``buffer_m``
    metres outside stay. Grid coordinates are shifted by the projected position of the hour's first node.
    """
    keys = list(HOUR_KEYS)
    rows = scan_partitions(spark, root, date, hour)
    known = settings_of(rows.select(*keys).distinct(), hour_settings(read_sidecars(spark, root)), keys, region)
    missing = F.when(F.col("crs").isNull(), NO_CRS).when(F.col("projection.kind").isNull(), BAD_CRS)
    if region is not None:
        missing = missing.when(F.col("ring").isNull(), NO_REGION)
    known = stage(known.withColumn("status", missing.otherwise("ok")), "settings")
    usable = known.filter("status = 'ok'").drop("status")
    # Geometry is decoded and projected once; what follows reads plain columns.
    nodes = with_lonlat(rows.join(usable.select(*keys, "projection"), keys))
    nodes = anchor_offset(project(nodes, ByRow(F.col("projection")), x="proj_x", y="proj_y"), keys).drop("proj_x", "proj_y", "projection")
    nodes = prepare_nodes(nodes)
    if region is not None:
        nodes = clip_to_rings(nodes, usable, keys, buffer_m)
    points = usable.select(*keys, F.inline("test_points")).distinct()
    return Hours(stage(nodes, "loaded"), usable.drop("regions", "test_points"), points, known.select(*keys, "status"))


def settings_of(hours: DataFrame, settings: DataFrame, keys: list[str], region: str | None) -> DataFrame:
    """Hours with their settings, the constants of their projection and the ring of the named region (NULL without)."""
    texts = settings.select("crs").distinct().select("crs", projection_constants("crs").alias("projection"))
    picked = F.try_element_at(F.filter("regions", lambda r: region_label(r) == region), F.lit(1))["polygon"] if region is not None else F.lit(None).cast("array<array<double>>")
    return hours.join(settings, keys, "left").join(texts, "crs", "left").withColumn("ring", ring_from_pairs(picked))


def clip_to_rings(nodes: DataFrame, settings: DataFrame, keys: list[str], buffer_m: float) -> DataFrame:
    """Rows within ``buffer_m`` metres of their hour's ring, measured in the UTM zone of the ring's middle.

    A degree box around all rings reaches the scan first.
    """
    ring = F.col("ring")
    middle = F.aggregate(ring, F.lit(0.0), lambda s, p: s + p["lon"]) / F.size(ring)
    zone = F.pmod(F.floor((middle + 180.0) / 6.0), F.lit(60)) + 1
    utm = F.struct(F.lit("utm").alias("kind"), *((zone * 6.0 - 183.0 if c == "lon_0" else F.lit(0.0)).alias(c) for c in CONSTANTS), F.lit(None).cast("string").alias("error"))
    zoned = settings.select(*keys, "ring", utm.alias("utm"))
    lows = [agg(c) for agg, c in zip((F.min, F.min, F.max, F.max), ring_bounds(ring))]
    x0, y0, x1, y1 = settings.agg(*lows).first()
    if x0 is None:
        return nodes.filter("false")
    # One degree of latitude is at least 110 km; longitudes shrink with the cosine.
    room = buffer_m / 110000.0 + 0.01
    wide = room / max(0.01, math.cos(math.radians(min(89.0, max(abs(y0), abs(y1)) + room))))
    near = nodes.filter(in_box(F.col("lon"), F.col("lat"), x0 - wide, y0 - room, x1 + wide, y1 + room))
    near = project(near.join(zoned.select(*keys, "utm"), keys), ByRow(F.col("utm")), x="_ux", y="_uy").drop("utm")

    def metres(p):
        x, y = ByRow(F.col("utm")).forward(p["lon"], p["lat"])
        return F.struct(x.alias("lon"), y.alias("lat"))

    rings = zoned.select(*keys, F.transform(ring, metres).alias("ring"), F.lit("ring").alias("region"))
    inside = points_in_regions(near, rings, keys, ["_ux", "_uy"], "region", "_ux", "_uy", distance=f"{float(buffer_m)!r}D")
    return near.join(inside.drop("region"), [*keys, "_ux", "_uy"], "left_semi").drop("_ux", "_uy")


def interpolate_hours(hours: Hours, params: InterpolationParams) -> Interpolation:
    """Interpolates all hours by one plan; hours that could not be loaded appear in ``status``."""
    failed = hours.status.filter("status <> 'ok'")
    if hours.settings.isEmpty():
        raise ValueError("no hour could be loaded: " + "; ".join(r.status for r in failed.select("status").distinct().collect()))
    out = interpolate(hours.nodes, hours.keys, params, points=hours.points, settings=hours.settings)
    return replace(out, status=out.status.unionByName(failed, allowMissingColumns=True))


def build_sidecars(hours: DataFrame, settings: DataFrame, script: str, source_model: Column | None = None) -> DataFrame:
    """Sidecar documents of interpolated hours: those of their inputs, with the script and time that made them."""
    docs = hours.select(*HOUR_KEYS).distinct().join(settings, list(HOUR_KEYS))
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return docs.withColumns({
        "source_model": source_model if source_model is not None else F.lit(None).cast("string"),
        "generated": F.struct(F.lit(script).alias("script"), stamp.alias("timestamp")),
    })
