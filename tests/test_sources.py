import json
import os
import shutil
import struct

import pytest
from pyspark.sql import functions as F

from gustgrid.functions import geometry as geo
from gustgrid.functions.text import sidecar_root
from gustgrid.operators import catalog, metrics, regions
from gustgrid.plans import compare
from gustgrid.sources import hours, inputs, reports
from gustgrid.streaming.catalog import catalog_stream, read_catalog


def hour_rows(spark, day="02", n_hours=3, shift=0.0):
    rows = [
        ("2025", "01", day, f"{h:02d}", str(i), -9.0 + i * 0.1 + shift, 42.0 + i * 0.1, f"2025-01-{day}T{h:02d}:00:00Z", "wrf4km")
        for h in range(n_hours) for i in range(4)
    ]
    return spark.createDataFrame(
        rows, "year string, month string, day string, hour string, node_id string, lon double, lat double, timestamp string, source_model string")


def test_write_and_scan_hours(spark, tmp_path):
    root = str(tmp_path / "winds")
    hours.write_hourly(hour_rows(spark), root)
    hours.write_hourly(hour_rows(spark, n_hours=1, shift=5.0).withColumn("extra", F.lit(1)), root, files_per_hour=3)
    df = hours.scan_partitions(spark, root)
    assert df.count() == 12 and "extra" in df.columns and dict(df.dtypes)["hour"] == "string"
    assert df.filter("hour = '00'").agg(F.min("lon")).first()[0] == pytest.approx(-4.0)
    one = hours.scan_partitions(spark, root, "2025-01-02", "1")
    assert one.count() == 4
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan.replace("\n", "")


def test_legacy_files_fill_missing_hours(spark, tmp_path):
    root = tmp_path / "winds"
    hours.write_hourly(hour_rows(spark, n_hours=1), str(root))
    other = tmp_path / "other"
    hours.write_hourly(hour_rows(spark, n_hours=2, shift=1.0), str(other))
    for folder in other.glob("year=*/month=*/day=*/hour=*"):
        target = root / folder.relative_to(other)
        target.mkdir(parents=True, exist_ok=True)
        shutil.copy(next(folder.glob("*.parquet")), target / "data.geoparquet")
    got = {r.hour: r.lon for r in hours.scan_partitions(spark, str(root)).groupBy("hour").agg(F.min("lon").alias("lon")).collect()}
    assert got == {"00": pytest.approx(-9.0), "01": pytest.approx(-8.0)}


def test_sidecars_round_trip_and_missing(spark, tmp_path):
    root = str(tmp_path / "winds")
    assert hours.read_sidecars(spark, root).count() == 0
    region = {"region_name": "A", "name": None, "polygon": [[0.0, 0.0], [1.0, 0.0], [0.0, 1.0]]}
    docs = spark.createDataFrame(
        [("2025", "01", "02", "03", "+proj=utm +zone=29", [region])],
        f"year string, month string, day string, hour string, crs string, regions array<{hours.REGION_TYPE}>")
    hours.write_sidecars(docs, root)
    side = hours.read_sidecars(spark, root)
    row = side.first()
    assert row.crs == "+proj=utm +zone=29" and row.regions[0].polygon[1] == [1.0, 0.0] and row.hour == "03"
    edited = side.select(*hours.HOUR_KEYS, "crs", regions.add_region(F.col("regions"), "B", [(0, 0), (1, 1), (0, 2)]).alias("regions"))
    assert [r.region_name for r in edited.first().regions] == ["A", "B"]
    picked = side.select(regions.pick_region(F.col("regions"), "A").alias("r")).first().r
    assert picked.region_name == "A"
    with pytest.raises(Exception, match="region not found"):
        side.select(regions.pick_region(F.col("regions"), "Z").alias("r")).collect()
    assert sidecar_root("s3://bucket/path/data") == "s3://bucket/path/metadata/data"
    assert sidecar_root("/a/b/") == "/a/metadata/b" and sidecar_root("s3://bucket") == "s3://bucket/metadata"


def test_points_and_regions_from_files(spark, tmp_path):
    (tmp_path / "p.csv").write_text("test_point,longitude,latitude\nA,-8.5,43.4\nB,-8.6,43.1\n")
    assert [tuple(r) for r in inputs.read_points(spark, str(tmp_path / "p.csv")).orderBy("name").collect()] == [("A", -8.5, 43.4), ("B", -8.6, 43.1)]
    for bad in ("name,lon,lat\n,1,2\n", "name,lon,lat\nA,x,2\n"):
        (tmp_path / "bad.csv").write_text(bad)
        with pytest.raises(Exception, match="test point without"):
            inputs.read_points(spark, str(tmp_path / "bad.csv")).collect()
    ring = [[-8.6, 43.3], [-8.4, 43.3], [-8.4, 43.5], [-8.6, 43.3]]
    (tmp_path / "coast.geojson").write_text(json.dumps(
        {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[ring]]}}]}, indent=1))
    row = inputs.read_regions(spark, str(tmp_path / "coast.geojson"), first_only=True).first()
    assert row.region_name == "coast" and [[p.lon, p.lat] for p in row.ring] == ring
    hole, other = [[-8.5, 43.35], [-8.45, 43.35], [-8.45, 43.4]], [[0, 0], [1, 0], [1, 1]]
    polygons = [{"type": "MultiPolygon", "coordinates": [[ring, hole], [other]]}, {"type": "Polygon", "coordinates": [other]}]
    (tmp_path / "many.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": g} for g in polygons]}))
    rows = inputs.read_regions(spark, str(tmp_path / "many.geojson")).collect()
    assert sorted((r.feature, r.part, r.ring_no, len(r.ring)) for r in rows) == [(0, 0, 0, 4), (0, 0, 1, 3), (0, 1, 0, 3), (1, 0, 0, 3)]
    (tmp_path / "line.geojson").write_text('{"type":"LineString","coordinates":[[0,0],[1,1]]}')
    with pytest.raises(Exception, match="no polygon"):
        inputs.read_regions(spark, str(tmp_path / "line.geojson")).collect()


def test_inverted_manifest_is_an_error(spark):
    spans = spark.sql("SELECT 'wrf4km' AS model, DATE'2025-01-02' AS start_date, DATE'2025-01-01' AS end_date")
    with pytest.raises(Exception, match="end date before start"):
        inputs.source_manifest(spans, inputs.model_table(spark)).collect()


def test_wkb_variants(spark):
    little, big = struct.pack("<BIdd", 1, 1, -8.5, 43.4), struct.pack(">BIdd", 0, 1, -8.5, 43.4)
    ewkb = struct.pack("<BIIdd", 1, 1 | 0x20000000, 4326, -8.5, 43.4)
    line = struct.pack("<BIIdd", 1, 2, 1, -8.5, 43.4)
    df = spark.createDataFrame([(0, little), (1, big), (2, ewkb), (3, line), (4, None), (5, b"x")], "i int, g binary")
    got = {r.i: (r.p.lon, r.p.lat) if r.p and r.p.lon is not None else None for r in df.select("i", geo.wkb_to_lonlat("g").alias("p")).collect()}
    assert got == {0: (-8.5, 43.4), 1: (-8.5, 43.4), 2: (-8.5, 43.4), 3: None, 4: None, 5: None}
    out = spark.createDataFrame([(-8.5, 43.4), (None, 1.0)], "lon double, lat double").select(geo.lonlat_to_wkb("lon", "lat").alias("g")).collect()
    assert bytes(out[0].g) == little and out[1].g is None


def test_plan_file_and_comparison_reports(spark, tmp_path):
    plan_file = tmp_path / "plan.json"
    entry = {"id": "Vila No", "catalog": "c.json", "item_id": "I", "node_id": "N", "obs_start": "2025-01-01", "buoy_height_correction": True}
    plan_file.write_text(json.dumps({"buoys": [entry]}, indent=1))
    plan = compare.buoy_plan(compare.read_plan(spark, str(plan_file)), {"prediction_path": "winds"})
    row = plan.first()
    assert (row.buoy_id, row.label, row.corrected, row.source_height) == ("vila_no", "Vila No", True, 3.0)
    plan_file.write_text(json.dumps([entry, {"id": "b"}]))
    with pytest.raises(Exception, match="has no catalog"):
        compare.buoy_plan(compare.read_plan(spark, str(plan_file)), {"prediction_path": "p"}).collect()
    obs = spark.sql("SELECT 'I' AS item_id, timestamp'2025-01-01 00:00:00' + make_interval(0,0,0,0,id) AS ts, CASE WHEN id = 3 THEN -9999D ELSE 5D + id END AS wind_speed, 10D * id AS wind_dir FROM range(6)")
    pred = spark.sql("SELECT 'N' AS node_id, 'test_point' AS interpolation_source, date_format(timestamp'2025-01-01 00:00:00' + make_interval(0,0,0,0,id), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS timestamp, 6D + id AS wind_speed, 10D * id AS wind_dir, 0D AS u, 0D AS v FROM range(6)")
    out = compare.compare(obs, pred, plan)
    speed = out.filter("variable = 'wind_speed'").first()
    assert speed.samples == 5 and speed.eaam_dir == pytest.approx(0) and speed.obs_height_m == 10.0
    reports.write_metrics({"metrics": out, "lines": compare.report_rows(out)}, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out" / "metrics"))
    assert back.count() == 4 and os.path.isdir(tmp_path / "out" / "metrics" / "buoy_id=vila_no")


def test_metric_edge_cases(spark):
    nan = float("nan")
    rows = [(1, 5.0, 5.0), (1, 6.0, 5.0), (2, nan, 1.0), (2, None, 1.0), (2, float("inf"), 1.0), (3, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "s int, wind_speed_pred double, wind_speed_obs double").selectExpr(
        "*", "1D AS u_pred", "1D AS u_obs", "1D AS v_pred", "2D AS v_obs", "350D AS wind_dir_pred", "10D AS wind_dir_obs")
    m = {r.s: r for r in metrics.speed_metrics(df, ["s"]).collect()}
    assert m[1].samples == 2 and m[1].r2_speed is None and m[1].corr_speed is None
    assert m[2].samples == 0 and m[2].rmse_speed is None
    assert m[3].corr_speed is None and m[3].eam_dir == pytest.approx(-20)
    c = {(r.s, r.variable): r for r in metrics.component_metrics(df, ["s"]).collect()}
    assert c[2, "Wind speed (m/s)"].samples == 0 and c[1, "U component (m/s)"].rsr is None and c[3, "V component (m/s)"].bias == -1


def test_catalog_of_files_and_subset(spark, tmp_path):
    root = str(tmp_path / "winds")
    hours.write_hourly(hour_rows(spark), root)
    items = catalog.scan_items(hours.scan_partitions(spark, root))
    got = {r.item_id: r for r in items.collect()}
    assert set(got) == {"20250102T00", "20250102T01", "20250102T02"}
    assert got["20250102T01"].row_count == 4 and got["20250102T01"].max_lon == pytest.approx(-8.7)
    ids = spark.createDataFrame([("1",), ("1",), (" 2 ",), ("",)], "node_id string")
    kept = catalog.subset(hours.scan_partitions(spark, root), ids, [(-9, 42), (-8.85, 42), (-8.85, 42.5), (-9, 42.5)])
    reports.write_subset(kept, str(tmp_path / "sub"), single_file=True)
    assert spark.read.parquet(str(tmp_path / "sub")).count() == 3
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lon" in plan
    with pytest.raises(ValueError):
        catalog.subset(items)


def test_stream_catalogs_new_hours_once(spark, tmp_path):
    root, table, state = (str(tmp_path / n) for n in ("winds", "catalog", "state"))
    hours.write_hourly(hour_rows(spark, n_hours=2), root)
    schema = hours.scan_partitions(spark, root).schema
    for _ in range(2):
        catalog_stream(spark, root, schema, table, state).awaitTermination(120)
    assert spark.read.parquet(table).count() == 2
    hours.write_hourly(hour_rows(spark, day="03", n_hours=1), root)
    catalog_stream(spark, root, schema, table, state).awaitTermination(120)
    assert {r.item_id for r in spark.read.parquet(table).collect()} == {"20250102T00", "20250102T01", "20250103T00"}
    # A second file of a cataloged hour arrives in a later batch.
    late = f"{root}/year=2025/month=01/day=03/hour=00"
    spark.read.parquet(late).limit(1).write.mode("append").parquet(late)
    catalog_stream(spark, root, schema, table, state).awaitTermination(120)
    item = {r.item_id: r for r in read_catalog(spark, table).collect()}
    assert len(item) == 3 and item["20250103T00"].n_files == 2 and item["20250103T00"].row_count == item["20250102T00"].row_count + 1


def test_cubes_are_ingested_and_grids_published(spark, tmp_path):
    from gustgrid.plans.publish import ingest_cubes, publish_grid

    cubes = spark.sql(
        "SELECT make_timestamp(2025, 1, 2, CAST(id AS INT), 0, 0) AS time, array(0D, 4D, 8D) AS x, array(10D, 14D) AS y,"
        " transform(sequence(0, 5), i -> 42D + i) AS lat, transform(sequence(0, 5), i -> -9D + i) AS lon,"
        " transform(sequence(0, 5), i -> CAST(90 AS FLOAT)) AS dir, transform(sequence(0, 5), i -> CAST(i + id AS FLOAT)) AS mod,"
        " transform(sequence(0, 5), i -> CAST(i AS FLOAT)) AS topo FROM range(2)")
    root = str(tmp_path / "winds")
    ingest_cubes(cubes, root, "wrf4km")
    rows = hours.scan_partitions(spark, root, "2025-01-02", "01").withColumn("p", geo.wkb_to_lonlat("geometry")).orderBy("wind_speed").collect()
    assert [(r.x, r.y, r.wind_speed, r.p.lon) for r in rows] == [(4.0 * (i % 3), 10.0 + 4 * (i // 3), i + 1.0, -9.0 + i) for i in range(6)]
    assert rows[0].timestamp == "2025-01-02T01:00:00Z" and rows[0].source_model == "wrf4km" and "lat" not in rows[0].asDict()
    grid = spark.sql("SELECT '2025-01-02' AS date, '05' AS hour, 'a' AS node_id, -8.5D AS lon, 43D AS lat, 1D AS u")
    side = spark.sql("SELECT '2025' AS year, '01' AS month, '02' AS day, '05' AS hour, '+proj=utm +zone=29' AS crs, 'wrf4km' AS source_model")
    out = str(tmp_path / "out")
    publish_grid(grid, out, side)
    row = hours.scan_partitions(spark, out).join(hours.read_sidecars(spark, out).select(*hours.HOUR_KEYS, "crs"), list(hours.HOUR_KEYS), "left").first()
    assert (row.node_id, row.hour, row.month, row.crs) == ("a", "05", "01", "+proj=utm +zone=29") and len(row.geometry) == 21
    checked = catalog.verify_dataset(hours.scan_partitions(spark, out), list(hours.HOUR_KEYS), hours.read_sidecars(spark, out)).first()
    assert checked.rows == 1 and checked.has_sidecar
