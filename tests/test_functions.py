import math

import pytest
from pyspark.sql import functions as F

from gustgrid.functions import crs, times, wind
from gustgrid.operators import lattice, sampling
from gustgrid.operators.projection import project
from gustgrid.plans.interpolate import prepare_nodes
from gustgrid import session


def test_timestamp_layouts(spark):
    texts = {
        "2025-01-02T03:04:05Z": "2025-01-02 03:04:05", "2025-01-02T03:04:05+02:00": "2025-01-02 01:04:05", "2025-01-02 03:04:05": "2025-01-02 03:04:05",
        "2025-01-02T03:04:05.250Z": "2025-01-02 03:04:05", "2025-01-02T03:04:05.123456": "2025-01-02 03:04:05",
        "2025-01-02": "2025-01-02 00:00:00", "20250102": "2025-01-02 00:00:00", "20250102030405": "2025-01-02 03:04:05",
        "2025/01/02": "2025-01-02 00:00:00", "2025/01/02 03:04:05": "2025-01-02 03:04:05", "soon": None, "2025-13-01": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.p for r in df.select("t", F.date_format(times.parse_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("p")).collect()}
    assert got == texts
    with pytest.raises(Exception, match="cannot parse timestamp"):
        df.select(times.parse_timestamp(F.col("t"), strict=True).alias("p")).collect()


def test_crs_text_of_a_wrapped_meridian(spark):
    out = spark.range(1).select(crs.normalize_crs(F.lit("+proj=lambert_conformal_conic +lon_0=190")).alias("c")).first().c
    assert "+proj=lcc" in out and "+no_defs" in out and "+ellps=WGS84" in out and "+datum=WGS84" in out and "+lon_0=-170" in out
    again = spark.range(1).select(crs.normalize_crs(F.lit(out)).alias("c")).first().c
    assert again == out


def test_projections_agree_with_known_values(spark):
    # Published check values: UTM zone 31 of the Eiffel Tower, LCC of Snyder's worked example (1987, p. 296).
    x, y = crs.Utm(31).forward(2.294495, 48.858222, math)
    assert (x, y) == (pytest.approx(448252, abs=2), pytest.approx(5411943, abs=10))
    clarke = crs.Lambert(33, 45, 23, -96, a=6378206.4, f=1 - math.sqrt(1 - 0.00676866))
    x, y = clarke.forward(-75.0, 35.0, math)
    assert (x, y) == (pytest.approx(1894410.9, abs=0.5), pytest.approx(1564649.5, abs=0.5))
    lon, lat = clarke.inverse(x, y, math)
    assert (lon, lat) == (pytest.approx(-75, abs=1e-7), pytest.approx(35, abs=1e-7))
    row = project(spark.sql("SELECT -75D AS lon, 35D AS lat"), clarke).first()
    assert (row.x, row.y) == (pytest.approx(x), pytest.approx(y))
    sphere = crs.projection_from_text("+proj=lcc +lat_1=43 +lat_2=43 +lat_0=34.8 +lon_0=-14.1 +R=6370000 +units=km")
    assert sphere.inverse(*sphere.forward(-8.5, 43.4, math), math) == (pytest.approx(-8.5), pytest.approx(43.4))
    with pytest.raises(ValueError):
        crs.projection_from_text("+proj=merc")


def test_height_parameters_are_checked(spark):
    with pytest.raises(ValueError):
        wind.height_correct(F.lit(1.0), source=float("nan"))
    bad = spark.sql("SELECT 5D AS s, CAST('NaN' AS DOUBLE) AS h").select(wind.height_correct(F.col("s"), F.col("h")).alias("c"))
    with pytest.raises(Exception, match="height correction"):
        bad.collect()


def test_buffer_in_metres(spark):
    ring = [(-8.6, 43.3), (-8.4, 43.3), (-8.4, 43.5), (-8.6, 43.5)]
    rows = [(0, -8.5, 43.4), (1, -8.6, 43.3), (2, -8.5, 43.3 - 4.9 / 111.1), (3, -8.5, 43.3 - 5.1 / 111.1), (4, -8.4 + 0.06, 43.4), (5, -8.4 + 0.07, 43.4)]
    df = spark.createDataFrame(rows, "id int, lon double, lat double").selectExpr("*", "5D AS wind_speed", "270D AS wind_dir")
    out = prepare_nodes(df, ring, 5000.0).orderBy("id").collect()
    assert [r.id for r in out] == [0, 1, 2, 4]
    assert out[0].u == pytest.approx(5.0) and out[0].v == pytest.approx(0.0, abs=1e-12)
    with pytest.raises(ValueError):
        prepare_nodes(df.drop("wind_dir"))


def test_samples_are_exact_and_disjoint(spark):
    df = spark.range(1003).selectExpr("id % 3 AS pk", "id")
    n = {r.pk: r.n for r in sampling.holdout_split(df, ["pk"], "id", 10.0).filter("is_test").groupBy("pk").agg(F.count("*").alias("n")).collect()}
    assert n == {0: 34, 1: 34, 2: 34}
    assert sampling.subsample(df, ["pk"], "id", 100.0).count() == 1003
    sizes = [r["count"] for r in sampling.kfold(df, ["pk"], "id", 5).groupBy("pk", "fold").count().collect()]
    assert len(sizes) == 15 and max(sizes) - min(sizes) <= 1


def test_point_lists_of_any_length(spark):
    nodes = spark.sql("SELECT pk, id % 3 * 1D AS x, id div 3 * 1D AS y FROM range(9), (SELECT explode(array(0, 1)) AS pk)")
    lat = lattice.infer_lattice(nodes, ["pk"])
    grid = lattice.refine_grid(lat, ["pk"], 2)
    points = spark.sql("SELECT concat('p', id) AS name, 0.5D AS lon, id * 0.1D AS lat FROM range(20000)")
    out = lattice.append_points(grid, points, lat, ["pk"], crs.LonLat())
    assert out.count() == 2 * (25 + 20000) and out.filter("is_test_point").select("pk", "node_id").distinct().count() == 40000
    unnamed = spark.sql("SELECT CAST(NULL AS STRING) AS name, 3.0D - id AS lon, 0D AS lat FROM range(3)")
    rows = lattice.append_points(grid, unnamed, lat, ["pk"], crs.LonLat()).filter("is_test_point AND pk = 0").collect()
    assert sorted((r.node_id, r.x) for r in rows) == [("test_point_1", 1.0), ("test_point_2", 2.0), ("test_point_3", 3.0)]


def test_noise_and_scatter_in_lattices(spark):
    nodes = spark.sql(
        "SELECT 'clean' AS pk, id % 6 * 4D AS x, id div 6 * 4D AS y FROM range(36) UNION ALL"
        " SELECT 'noisy', id % 6 * 4D + sin(id) * 1e-9D, id div 6 * 4D + cos(id) * 1e-9D FROM range(36) UNION ALL"
        " SELECT 'scattered', 50 * sin(id * 12.9898D), 50 * cos(id * 78.233D) FROM range(60) UNION ALL SELECT 'one', 1D, 2D")
    lat = {r.pk: r for r in lattice.infer_lattice(nodes, ["pk"]).collect()}
    assert lat["clean"].base_res == 4 and (lat["clean"].n_x, lat["clean"].n_y) == (6, 6)
    assert abs(lat["noisy"].base_res - 4) < 1e-6 and (lat["noisy"].n_x, lat["noisy"].n_y) == (6, 6)
    assert lat["scattered"].base_res is None and lat["one"].base_res is None
    noisy = nodes.filter("pk = 'noisy'")
    lines = lattice.infer_lattice(noisy, ["pk"])
    assert lattice.refine_grid(lines, ["pk"], 2).count() == 121
    assert lattice.assign_node_id(noisy, lines, ["pk"], 2).filter("node IS NULL").count() == 0


def test_stages_are_read_back_and_released(spark):
    df = session.stage(spark.range(5), "t")
    assert df.count() == 5
    session.release_stages(spark)
    with pytest.raises(Exception):
        df.count()


def test_lattice_steps_by_votes(spark):
    """A stray node at either end, patches far apart, holes, unequal axes, an offset that falls between two remainders."""
    from gustgrid.operators.lattice import infer_lattice, off_lattice

    square = [(float(i), float(j)) for i in range(30) for j in range(30)]
    cases = {
        "stray": square + [(5.01, 7.0)], "first": [(x + 0.0105, y) for x, y in square] + [(0.0, 3.0)],
        "patches": [(x, y) for x, y in square if x < 20 and y < 20] + [(x + 5000, y + 5000) for x, y in square if x < 20 and y < 20],
        "holes": [(3.0 * i, 3.0 * j) for i in (0, 1, 3, 4, 8, 11, 12) for j in (0, 2, 3, 5, 6)],
        "axes": [(2.0 * i, 7.0 + j) for i in range(40) for j in range(3)], "noise": [(x + 1e-9 * (x * 7 % 3), y) for x, y in square],
    }
    df = spark.createDataFrame([(k, x, y) for k, pts in cases.items() for x, y in pts], "k string, x double, y double")
    found = infer_lattice(df, ["k"])
    lat = {r.k: r for r in found.collect()}
    assert {k: round(r.base_res, 6) for k, r in lat.items()} == {"stray": 1, "first": 1, "patches": 1, "holes": 3, "axes": 1, "noise": 1}
    assert (lat["stray"].n_x, lat["stray"].max_x_local) == (30, 29) and abs(lat["first"].min_x - 0.0105) < 1e-9
    assert (lat["patches"].n_x, lat["patches"].max_x_local) == (40, 5019) and lat["axes"].min_y == 7
    assert sorted((r.k, r.x, r.y) for r in off_lattice(df, found, ["k"]).collect()) == [("first", 0.0, 3.0), ("stray", 5.01, 7.0)]


def test_geometry_columns_without_python(spark):
    """WKB of either byte order with and without SRID, extreme numbers, WKT forms; unreadable ones are NULL."""
    import struct

    from gustgrid.functions.geometry import rings_from_wkt, wkb_point, wkt_point
    from gustgrid.operators.catalog import subset_geometry

    numbers = [0.0, -0.0, 1.0, -8.75, 42.123456789012345, 1e-310, -5e-324, 1.7976931348623157e308, 2.2250738585072014e-308, 0.1, -180.0]
    rows = []
    for i, a in enumerate(numbers):
        b = numbers[-1 - i]
        rows += [(struct.pack("<BIdd", 1, 1, a, b), a, b), (struct.pack(">BIdd", 0, 1, a, b), a, b), (struct.pack("<BIIdd", 1, 0x20000001, 4326, a, b), a, b), (struct.pack(">BIIdd", 0, 0x20000001, 4326, a, b), a, b)]
    rows += [(struct.pack("<BIdd", 1, 2, 1.0, 2.0), None, None), (b"short", None, None), (None, None, None), (struct.pack("<BIdd", 1, 1, float("nan"), float("inf")), None, None)]
    df = spark.createDataFrame(rows, "w binary, x double, y double")
    x, y = wkb_point(F.col("w"))
    plan = df.select(x, y)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    for r in df.select("x", "y", x.alias("gx"), y.alias("gy")).collect():
        assert (r.gx, r.gy) == (r.x, r.y), r
    texts = [("POINT (1.5 -2)", 1.5, -2.0), ("point z(1e2 .5 7)", 100.0, 0.5), ("SRID=4326;POINT(3 4)", 3.0, 4.0), ("POINT EMPTY", None, None), ("LINESTRING (1 2, 3 4)", None, None), (None, None, None)]
    df = spark.createDataFrame(texts, "w string, x double, y double")
    x, y = wkt_point(F.col("w"))
    assert all((r.gx, r.gy) == (r.x, r.y) for r in df.select("x", "y", x.alias("gx"), y.alias("gy")).collect())
    assert rings_from_wkt("POLYGON Z ((0 0 9, 1 0 9, 1 1 9))") == [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]]
    for bad in ("POINT (1 2)", "POLYGON ((0 0, 1 1))", "POLYGON ((0 0, 1 0, 1 1)", "POLYGON EMPTY"):
        with pytest.raises(ValueError):
            rings_from_wkt(bad)
    hole = "POLYGON ((0 0, 4 0, 4 4, 0 4), (1 1, 3 1, 3 3, 1 3))"
    pts = spark.createDataFrame([(k, f"POINT ({a} {b})") for k, (a, b) in enumerate([(0.5, 0.5), (2, 2), (3, 2), (4, 4), (5, 1)])], "k int, g string")
    assert sorted(r.k for r in subset_geometry(pts, hole, geometry="g", geom_format="wkt").collect()) == [0, 2, 3]
