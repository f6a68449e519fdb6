"""Rings, boxes, point-in-polygon and WKB.

A ring is ``array<struct<lon:double,lat:double>>``; its edges are
``array<struct<x1,y1,x2,y2>>``. Rings are small (a region outline), points are the data.
"""

from __future__ import annotations

import re
import struct
import sys
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

# The WKB functions travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RING_TYPE = "array<struct<lon:double,lat:double>>"
# Rings given as Python lists up to this many edges become one generated expression.
UNROLL_EDGES = 64


def ring_column(points) -> Column:
    """Column literal of a Python list of (lon, lat) pairs."""
    return F.array(*(F.struct(F.lit(float(a)).alias("lon"), F.lit(float(b)).alias("lat")) for a, b in points))


def ring_from_pairs(pairs: Column) -> Column:
    """Ring of an ``array<array<double>>`` column as stored in sidecars."""
    return F.transform(pairs, lambda p: F.struct(p[0].cast("double").alias("lon"), p[1].cast("double").alias("lat")))


def swap_ring(ring: Column) -> Column:
    return F.transform(ring, lambda p: F.struct(p["lat"].alias("lon"), p["lon"].alias("lat")))


def close_ring(ring: Column) -> Column:
    """Append the first point if the ring is open."""
    first, last = F.get(ring, F.lit(0)), F.element_at(ring, -1)
    same = (first["lon"] == last["lon"]) & (first["lat"] == last["lat"])
    return F.when(same | (F.size(ring) == 0), ring).otherwise(F.concat(ring, F.array(first)))


def ring_edges(ring: Column) -> Column:
    closed = close_ring(ring)
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(closed) - 1, F.lit(1))),
        lambda i: F.struct(
            F.get(closed, i - 1)["lon"].alias("x1"), F.get(closed, i - 1)["lat"].alias("y1"),
            F.get(closed, i)["lon"].alias("x2"), F.get(closed, i)["lat"].alias("y2"),
        ),
    )


def bbox_ring(min_x: Column, min_y: Column, max_x: Column, max_y: Column) -> Column:
    """Closed five-point ring of a box, NULL if a bound is NULL."""
    corners = ((min_x, min_y), (max_x, min_y), (max_x, max_y), (min_x, max_y), (min_x, min_y))
    ring = F.array(*(F.struct(a.alias("lon"), b.alias("lat")) for a, b in corners))
    return F.when(min_x.isNotNull() & min_y.isNotNull() & max_x.isNotNull() & max_y.isNotNull(), ring)


def ring_bounds(ring: Column) -> tuple[Column, Column, Column, Column]:
    lon, lat = F.transform(ring, lambda p: p["lon"]), F.transform(ring, lambda p: p["lat"])
    return F.array_min(lon), F.array_min(lat), F.array_max(lon), F.array_max(lat)


# Edge tests are written once for number-or-column coordinates.

def _straddles(py, y1, y2):
    return (y1 > py) != (y2 > py)


def _crosses(px, py, x1, y1, x2, y2):
    return _straddles(py, y1, y2) & (px < (x2 - x1) * (py - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1)


def _touches(px, py, x1, y1, x2, y2):
    on_line = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) == 0
    return (
        on_line
        & (px >= F.least(x1, x2)) & (px <= F.greatest(x1, x2))
        & (py >= F.least(y1, y2)) & (py <= F.greatest(y1, y2))
    )


def _segment_distance2(px, py, x1, y1, x2, y2):
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / F.nullif(length2, F.lit(0.0))))
    t = F.coalesce(t, F.lit(0.0))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return ex * ex + ey * ey


def _python_edges(points):
    pts = [(float(a), float(b)) for a, b in points]
    if pts[0] != pts[-1]:
        pts.append(pts[0])
    return [tuple(F.lit(v) for v in (*a, *b)) for a, b in zip(pts, pts[1:])]


def in_ring(px: Column, py: Column, ring) -> Column:
    """Point inside or on the boundary (planar). ``ring`` is a column or a Python list of pairs."""
    if not isinstance(ring, Column):
        if len(ring) <= UNROLL_EDGES:
            edges = _python_edges(ring)
            crossings = reduce(lambda a, b: a + b, (F.when(_crosses(px, py, *e), 1).otherwise(0) for e in edges))
            touching = reduce(lambda a, b: a | b, (_touches(px, py, *e) for e in edges))
            return in_box(px, py, *python_bounds(ring)) & (touching | (crossings % 2 == 1))
        return in_box(px, py, *python_bounds(ring)) & in_edges(px, py, ring_edges(ring_column(ring)))
    return in_box(px, py, *ring_bounds(ring)) & in_edges(px, py, ring_edges(ring))


def in_edges(px: Column, py: Column, edges: Column) -> Column:
    def e(s):
        return s["x1"], s["y1"], s["x2"], s["y2"]

    parity = F.aggregate(edges, F.lit(False), lambda acc, s: acc != _crosses(px, py, *e(s)))
    return F.exists(edges, lambda s: _touches(px, py, *e(s))) | parity


def near_ring(px: Column, py: Column, ring, distance: float) -> Column:
    """Inside the ring or within ``distance`` of its boundary (an exact round buffer)."""
    limit = F.lit(float(distance) ** 2)
    if isinstance(ring, Column):
        edges = ring_edges(ring)
        close = F.exists(
            edges, lambda s: _segment_distance2(px, py, s["x1"], s["y1"], s["x2"], s["y2"]) <= limit
        )
        x0, y0, x1, y1 = ring_bounds(ring)
        box = in_box(px, py, x0 - distance, y0 - distance, x1 + distance, y1 + distance)
        return box & (close | in_edges(px, py, edges))
    x0, y0, x1, y1 = python_bounds(ring)
    box = in_box(px, py, x0 - distance, y0 - distance, x1 + distance, y1 + distance)
    if len(ring) > UNROLL_EDGES:
        return near_ring(px, py, ring_column(ring), distance) & box
    close = reduce(lambda a, b: a | b, (_segment_distance2(px, py, *e) <= limit for e in _python_edges(ring)))
    return box & (close | in_ring(px, py, ring))


def python_bounds(points) -> tuple[float, float, float, float]:
    xs, ys = [float(p[0]) for p in points], [float(p[1]) for p in points]
    return min(xs), min(ys), max(xs), max(ys)


def in_box(px: Column, py: Column, min_x, min_y, max_x, max_y) -> Column:
    """Range predicate; with plain numbers it is pushed into the Parquet scan."""
    return (px >= min_x) & (px <= max_x) & (py >= min_y) & (py <= max_y)


def in_region(px: Column, py: Column, rings) -> Column:
    """Point inside or on the boundary of a region of several rings (Python lists): parts add up, holes are left out."""
    edges = F.concat(*(ring_edges(ring_column(r)) for r in rings))
    bounds = [python_bounds(r) for r in rings]
    box = [f(b[i] for b in bounds) for i, f in enumerate((min, min, max, max))]
    return in_box(px, py, *box) & in_edges(px, py, edges)


NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"


def rings_from_wkt(text: str) -> list[list[tuple[float, float]]]:
    """The rings of a POLYGON or MULTIPOLYGON text, holes among them; further coordinates of a point are ignored."""
    head = re.match(r"\s*(?:SRID=\d+;)?\s*(MULTI)?POLYGON\b\s*(?:ZM|Z|M)?\s*\(", text, re.I)
    if not head or text.count("(") != text.count(")"):
        raise ValueError("a region must be a POLYGON or MULTIPOLYGON")
    rings = []
    for body in re.findall(r"\(([^()]+)\)", text):
        points = [tuple(float(v) for v in re.findall(NUMBER, p)[:2]) for p in body.split(",")]
        if len(points) < 3 or any(len(p) < 2 for p in points):
            raise ValueError("a ring needs three points of two coordinates")
        rings.append(points)
    if not rings:
        raise ValueError("a region needs a ring")
    return rings


def wkt_point(text: Column) -> tuple[Column, Column]:
    """Coordinates of POINT texts (2D, Z, M; with or without SRID); NULL for anything else."""
    pattern = rf"(?i)^\s*(?:SRID=\d+;)?\s*POINT\s*(?:ZM|Z|M)?\s*\(\s*({NUMBER})\s+({NUMBER})(?:\s+{NUMBER})*\s*\)\s*$"
    return tuple(F.nullif(F.regexp_extract(text, pattern, i), F.lit("")).try_cast("double") for i in (1, 2))


def wkb_point(wkb: Column) -> tuple[Column, Column]:
    """Coordinates of WKB and EWKB points of either byte order, by column expressions alone; NULL for anything else.

    A double is put together from its bits: sign, exponent and fraction, each exact.
    """
    text = F.hex(wkb)
    small = text.startswith("01")
    kind, size = F.substr(text, F.lit(3), F.lit(8)), F.octet_length(wkb)
    plain = (size == 21) & F.when(small, kind == "01000000").otherwise(text.startswith("00") & (kind == "00000001"))
    located = (size == 25) & F.when(small, kind == "01000020").otherwise(text.startswith("00") & (kind == "20000001"))
    start = F.when(plain, 11).when(located, 19)

    def number(at: int) -> Column:
        def part(n: int) -> Column:
            return F.substr(text, start + F.lit(at + 2 * n), F.lit(2))

        bits = F.when(small, F.concat(*(part(n) for n in range(7, -1, -1)))).otherwise(F.concat(*(part(n) for n in range(8))))
        head = F.conv(F.substr(bits, F.lit(1), F.lit(3)), 16, 10).cast("bigint")
        fraction = F.conv(F.substr(bits, F.lit(4), F.lit(13)), 16, 10).cast("bigint")
        power = head % 2048
        # Zero and the smallest numbers have no leading one; the largest exponent is no number.
        lead = F.when(power == 0, 0.0).otherwise(1.0)
        value = (lead + fraction / float(1 << 52)) * F.pow(F.lit(2.0), (F.greatest(power, F.lit(1)) - 1023).cast("double"))
        return F.when(power < 2047, F.when(head >= 2048, -value).otherwise(value))

    return number(0), number(16)


# ---------------------------------------------------------------------------
# WKB points, only at the scan and sink edge

# Layout of (E)WKB points.
_POINT, _SRID_FLAG = 1, 0x20000000
_POINT_HEAD = struct.pack("<BI", 1, _POINT)


@F.pandas_udf(T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())]))
def wkb_to_lonlat(wkb: pd.Series) -> pd.DataFrame:
    """Coordinates of WKB or EWKB points of either byte order; anything else is NULL."""
    lon, lat = np.full(len(wkb), np.nan), np.full(len(wkb), np.nan)
    sizes = wkb.map(lambda b: 0 if b is None else len(b)).to_numpy()
    for size, offset in ((21, 5), (25, 9)):
        rows = np.flatnonzero(sizes == size)
        if not len(rows):
            continue
        raw = np.frombuffer(b"".join(wkb.iloc[rows]), dtype=np.uint8).reshape(len(rows), size)
        for order, mark in (("<", 1), (">", 0)):
            pick = raw[:, 0] == mark
            if not pick.any():
                continue
            block = raw[pick]
            kind = np.ascontiguousarray(block[:, 1:5]).view(f"{order}u4").ravel()
            wanted = _POINT | (_SRID_FLAG if size == 25 else 0)
            xy = np.ascontiguousarray(block[:, offset : offset + 16]).view(f"{order}f8").reshape(-1, 2)
            xy = np.where((kind == wanted)[:, None], xy, np.nan)
            lon[rows[pick]], lat[rows[pick]] = xy[:, 0], xy[:, 1]
    out = pd.DataFrame({"lon": lon, "lat": lat}).astype(object)
    return out.where(out.notna(), None)


@F.pandas_udf(T.BinaryType())
def lonlat_to_wkb(lon: pd.Series, lat: pd.Series) -> pd.Series:
    """Little-endian WKB points; NULL coordinates give NULL."""
    xy = np.column_stack([lon.to_numpy(dtype="<f8"), lat.to_numpy(dtype="<f8")])
    body = xy.tobytes()
    ok = ~np.isnan(xy).any(axis=1)
    return pd.Series([_POINT_HEAD + body[16 * i : 16 * i + 16] if good else None for i, good in enumerate(ok)])
