"""Cube to ingested hours to nodes with settings per hour, and to a published, cataloged dataset."""

import math

from pyspark.sql import functions as F

from gustgrid.operators import catalog
from gustgrid.plans.load import build_sidecars, hour_settings, load_hours
from gustgrid.plans.publish import ingest_cubes, publish_grid
from gustgrid.sources import hours


def ingested(spark, root):
    """Three hours of an 8 x 8 field: one complete, one with another region, one without a sidecar."""
    n = 8
    cubes = spark.sql(
        f"SELECT make_timestamp(2025, 1, 2, CAST(id AS INT), 0, 0) AS time, transform(sequence(0, {n - 1}), i -> i * 1000D) AS x,"
        f" transform(sequence(0, {n - 1}), i -> i * 1000D) AS y,"
        f" transform(sequence(0, {n * n - 1}), i -> 43D + (i div {n}) * 0.009D) AS lat, transform(sequence(0, {n * n - 1}), i -> -9D + (i % {n}) * 0.0123D) AS lon,"
        f" transform(sequence(0, {n * n - 1}), i -> CAST(200 + 3 * (i % {n}) AS FLOAT)) AS dir, transform(sequence(0, {n * n - 1}), i -> CAST(5 + sin(i * 0.3D) AS FLOAT)) AS mod,"
        f" transform(sequence(0, {n * n - 1}), i -> CAST(i % 7 AS FLOAT)) AS topo FROM range(3)")
    ingest_cubes(cubes, root, "wrf1km")
    box = [[-8.98, 43.01], [-8.93, 43.01], [-8.93, 43.05], [-8.98, 43.05]]
    docs = spark.createDataFrame(
        [("2025", "01", "02", h, "+proj=utm +zone=29", [{"region_name": name, "name": None, "polygon": box}], [("buoy", -8.95, 43.03)]) for h, name in (("00", "bay"), ("01", "other"))],
        f"year string, month string, day string, hour string, crs string, regions array<{hours.REGION_TYPE}>, test_points array<struct<name:string,lon:double,lat:double>>")
    hours.write_sidecars(docs, root)


def test_settings_per_hour_and_round_trip(spark, tmp_path):
    root, out = str(tmp_path / "winds"), str(tmp_path / "out")
    ingested(spark, root)
    loaded = load_hours(spark, root, region="bay", buffer_m=1000.0)
    assert {r.hour: r.status for r in loaded.status.collect()} == {"00": "ok", "01": "region missing", "02": "projection metadata missing"}
    (setting,) = loaded.settings.collect()
    assert "+zone=29" in setting.crs and setting.projection.kind == "utm" and len(setting.ring) == 4
    assert [(p.hour, p.name) for p in loaded.points.collect()] == [("00", "buoy")]
    rows = loaded.nodes.collect()
    # A degree of longitude is about 81 km here: the widened box reaches from -8.992 to -8.918.
    assert {r.hour for r in rows} == {"00"} and 9 < len(rows) < 64 and all(-8.9925 < r.lon < -8.9175 and 43.0005 < r.lat < 43.0595 for r in rows)
    assert all(r.u is not None and 400000 < r.x < 600000 for r in rows)
    assert len({round(r.x / 10) for r in rows}) <= 8

    grid = loaded.nodes.withColumn("date", F.concat_ws("-", "year", "month", "day")).drop("year", "month", "day")
    publish_grid(grid, out, build_sidecars(loaded.nodes, hour_settings(hours.read_sidecars(spark, root)), "test"))
    back = hours.scan_partitions(spark, out)
    (item,) = catalog.scan_items(back).collect()
    assert item.item_id == "20250102T00" and item.row_count == len(rows) and -8.9925 < item.min_lon < item.max_lon < -8.9175
    assert {r.hour for r in hours.read_sidecars(spark, out).collect()} == {"00"}
    kept = catalog.subset(back, ring=[(-8.96, 43.02), (-8.94, 43.02), (-8.94, 43.04), (-8.96, 43.04)])
    assert 0 < kept.count() < len(rows)


def test_hours_with_their_own_settings_are_one_plan(spark, tmp_path):
    """Fifty hours with fifty projections and rings give what each gives alone, by one interpolation."""
    from gustgrid.functions.crs import projection_constants, projection_from_text
    from gustgrid.params import InterpolationParams
    from gustgrid.plans.interpolate import interpolate
    from gustgrid.plans.load import Hours, interpolate_hours

    count = 50
    texts = [f"+proj=lcc +lat_1={40 + h % 7} +lat_0=43 +lon_0={-9 + h / 10} +units=km" if h % 2 else f"EPSG:326{29 + h % 3}" for h in range(count)]
    rows = []
    for h, text in enumerate(texts):
        x0, y0 = projection_from_text(text).forward(-9.0, 43.0, math)
        step = 1.0 if h % 2 else 1000.0
        rows += [(h, x0 + i * step, y0 + j * step, float(i % 3), math.sin(0.7 * i) + 0.1 * h, math.cos(0.5 * j) + 0.05 * i) for i in range(6) for j in range(6)]
    nodes = spark.createDataFrame(rows, "h int, x double, y double, topo double, u double, v double")
    rings = [[(-9.0 + 0.012, 43.0 + 0.008), (-9.0 + 0.045, 43.0 + 0.009 + h / 2000), (-9.0 + 0.03, 43.04)] if h % 5 else None for h in range(count)]
    settings = spark.createDataFrame([(h, text, ring) for h, (text, ring) in enumerate(zip(texts, rings))], "h int, crs string, ring array<struct<lon:double,lat:double>>")
    settings = settings.withColumn("projection", projection_constants("crs"))
    points = spark.createDataFrame([(h, f"buoy{h}", -8.97, 43.02) for h in range(count)] + [(h, None, -8.975, 43.015) for h in range(count)], "h int, name string, lon double, lat double")
    # Cutoff and width in units of each projection would differ; only nodes and places are compared here.
    params = InterpolationParams(2, 6.0, 1.0, 80.0, 2, 4)
    out = interpolate_hours(Hours(nodes, settings, points, spark.createDataFrame([(99, "region missing")], "h int, status string"), ["h"]), params)
    grid = {}
    for r in out.grid.select("h", "node_id", "x", "y", "lon", "lat", "is_orig", "u").collect():
        grid.setdefault(r.h, {})[r.node_id] = r
    assert set(grid) == set(range(count)) and all((h % 5 or f"buoy{h}" in grid[h]) and f"buoy{h + 1}" not in grid[h] for h in grid)
    assert {r.h for r in out.status.collect()} == {*range(count), 99}
    for h in (7, 10):
        alone = interpolate(nodes.filter(f"h = {h}"), ["h"], params, projection_from_text(texts[h]), points.filter(f"h = {h}").drop("h"), rings[h]).grid
        want = {r.node_id: r for r in alone.select("node_id", "x", "y", "lon", "lat", "is_orig", "u").collect()}
        assert set(want) == set(grid[h])
        for k, r in want.items():
            g = grid[h][k]
            assert abs(g.lon - r.lon) < 1e-9 and abs(g.lat - r.lat) < 1e-9 and g.is_orig == r.is_orig and abs(g.x - r.x) < 1e-6
            assert (g.u is None) == (r.u is None) and (g.u is None or abs(g.u - r.u) < 1e-9), (h, k)
