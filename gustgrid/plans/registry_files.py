"""Registered queries over hourly files written from the events, with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gustgrid.functions.crs import LonLat
from gustgrid.functions.geometry import lonlat_to_wkb
from gustgrid.operators import catalog, lattice
from gustgrid.operators.region_join import points_in_regions
from gustgrid.plans.registry_columns import query
from gustgrid.plans.registry_fields import BOX, ITEMS, SUBSET, _texts
from gustgrid.session import stage, stage_path
from gustgrid.sources import footers
from gustgrid.sources.hours import HOUR_KEYS, read_sidecars, scan_partitions, write_clustered, write_hourly, write_sidecars
from gustgrid.sources.reports import write_metrics, write_subset

COLUMNS = "event_id:integer,lat:number,lon:number,source_model:string,timestamp:string,user_id:integer"


def new_root(t) -> str:
    return f"{stage_path(t.spark, 'hours')}/winds"


def hourly_rows(t) -> DataFrame:
    """All events as rows of an hourly dataset."""
    keys = [F.date_format("ts", p).alias(k) for k, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))]
    return t.files.select("event_id", "user_id", "lon", "lat", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), "source_model", *keys)


@query("footer_items", f"""WITH {ITEMS} SELECT * EXCLUDE (start_ts, end_ts, path), strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS start_datetime,
 strftime(end_ts, '%Y-%m-%d %H:%M:%S') AS end_datetime, '{COLUMNS}' AS columns FROM items""", "files")
def _(t):
    root = new_root(t)
    write_hourly(hourly_rows(t), root)
    items = footers.footer_items(footers.footer_files(t.spark, root))
    listed = F.array_join(F.transform("columns", lambda c: F.concat_ws(":", c["name"], c["type"])), ",")
    return _texts(items.drop("path").withColumn("columns", listed))


def clustered_root(t) -> str:
    """The events as hourly files that each cover a strip of longitudes."""
    root = new_root(t)
    rows = hourly_rows(t)
    write_clustered(rows, root, ["lon", "lat"], rows_per_file=max(20, rows.count() // 400))
    return root


@query("subset_pruned", f"WITH {SUBSET} SELECT event_id, user_id, lon, lat FROM sub", "files")
def _(t):
    root = clustered_root(t)
    zones = footers.footer_files(t.spark, root)
    rows = footers.read_pruned(t.spark, root, zones, box=(-9.0, 42.0, -8.7, 42.2)).withColumn("node_id", F.col("user_id").cast("string"))
    nodes = t.supplier.filter("s_nationkey < 12").select(F.col("s_suppkey").alias("node_id"))
    return catalog.subset(rows, nodes, BOX).select("event_id", "user_id", "lon", "lat")


@query("zone_map_files", """SELECT max(CASE WHEN n > 0 THEN 1 ELSE 0 END) AS some, sum(n) AS row_count, min(lon0) AS min_lon, max(lon1) AS max_lon, min(lat0) AS min_lat, max(lat1) AS max_lat FROM
 (SELECT count(*) AS n, min(lon) AS lon0, max(lon) AS lon1, min(lat) AS lat0, max(lat) AS lat1 FROM files GROUP BY path)""", "files")
def _(t):
    files = footers.footer_files(t.spark, clustered_root(t))
    return files.agg(F.lit(1).alias("some"), F.sum("row_count").alias("row_count"), F.min("min_lon").alias("min_lon"), F.max("max_lon").alias("max_lon"),
                     F.min("min_lat").alias("min_lat"), F.max("max_lat").alias("max_lat"))


# Two parts, the second with a hole; on multiples of a tenth of the lattice of longitudes and latitudes.
REGION = ("MULTIPOLYGON (((-9.005 42.0005, -8.8951 42.0005, -8.8951 42.0605, -9.005 42.0605, -9.005 42.0005)), "
          "((-8.8051 42.0305, -8.6049 42.0305, -8.6049 42.2505, -8.8051 42.2505, -8.8051 42.0305), (-8.7551 42.0705, -8.6549 42.0705, -8.6549 42.1505, -8.7551 42.1505, -8.7551 42.0705)))")
IN_REGION = """SELECT event_id, user_id FROM files WHERE ((lon BETWEEN -9.005 AND -8.8951 AND lat BETWEEN 42.0005 AND 42.0605)
 OR (lon BETWEEN -8.8051 AND -8.6049 AND lat BETWEEN 42.0305 AND 42.2505 AND NOT (lon > -8.7551 AND lon < -8.6549 AND lat > 42.0705 AND lat < 42.1505)))"""


@query("subset_wkb", IN_REGION, "files")
def _(t):
    rows = stage(t.files.select("event_id", "user_id", lonlat_to_wkb("lon", "lat").alias("geometry")), "with-geometry")
    return catalog.subset_geometry(rows, REGION).select("event_id", "user_id")


@query("subset_wkt", IN_REGION + " AND user_id % 2 = 0", "files")
def _(t):
    rows = t.files.select("event_id", "user_id", F.col("user_id").cast("string").alias("node_id"), F.format_string("POINT (%s %s)", F.col("lon").cast("string"), F.col("lat").cast("string")).alias("place"))
    nodes = t.files.filter("user_id % 2 = 0").select(F.col("user_id").cast("string").alias("node_id"))
    return catalog.subset_geometry(rows, REGION, nodes, "place", "wkt").select("event_id", "user_id")


# A star of 90 edges around every nation's place.
STARS = """SELECT n_nationkey AS region, i, 0.013e0 + 4e0 * n_nationkey + (3 + (i % 3) * 9 + n_regionkey) * cos(2 * pi() * i / 90) AS vx, 0.017e0 + 2e0 * n_nationkey + (3 + (i % 3) * 9 + n_regionkey) * sin(2 * pi() * i / 90) AS vy"""


@query("points_in_regions", f"""WITH v AS ({STARS} FROM nation, range(90) r(i)),
 e AS (SELECT a.region, a.vx AS x1, a.vy AS y1, b.vx AS x2, b.vy AS y2 FROM v a JOIN v b ON a.region = b.region AND b.i = (a.i + 1) % 90)
 SELECT region, id FROM grid, e WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY region, id HAVING count(*) % 2 = 1""", "grid")
def _(t):
    corners = t.nation.select("*", F.explode(F.sequence(F.lit(0), F.lit(89))).alias("i")).selectExpr(*STARS.removeprefix("SELECT ").split(", ", 3))
    # At most 90 corners a ring.
    rings = corners.groupBy("region").agg(F.sort_array(F.collect_list(F.struct("i", "vx", "vy"))).alias("c")).select(
        "region", F.transform("c", lambda p: F.struct(p["vx"].alias("lon"), p["vy"].alias("lat"))).alias("ring"))
    return points_in_regions(t.grid, stage(rings, "stars"), [], ["id"], "region")


@query("append_unnamed_points", """WITH p AS (SELECT c_nationkey * 2e0 AS lon, c_custkey * 0.5e0 AS lat FROM customer WHERE c_custkey % 3 = 0),
 k AS (SELECT pk, min(x) AS min_x FROM tiles GROUP BY pk) SELECT pk, concat('test_point_', CAST(row_number() OVER (PARTITION BY pk ORDER BY lon, lat) AS VARCHAR)) AS node_id, lon AS x, lat AS y, lon - min_x AS x_local FROM k, p""", "tiles")
def _(t):
    points = t.customer.filter("c_custkey % 3 = 0").selectExpr("CAST(NULL AS STRING) AS name", "c_nationkey * 2e0 AS lon", "c_custkey * 0.5e0 AS lat")
    found = lattice.infer_lattice(t.tiles, ["pk"])
    out = lattice.append_points(lattice.refine_grid(found, ["pk"], 1), points, found, ["pk"], LonLat())
    return out.filter("is_test_point").select("pk", "node_id", "x", "y", "x_local")


@query("write_read_hours", """SELECT event_id, user_id, lon, lat, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour FROM files""", "files")
def _(t):
    root, rows = new_root(t), hourly_rows(t)
    write_hourly(rows, root)
    return scan_partitions(t.spark, root, schema=rows.schema).select("event_id", "user_id", "lon", "lat", "year", "month", "day", "hour")


@query("write_read_one_hour", """SELECT event_id, strftime(ts, '%H') AS hour FROM files WHERE strftime(ts, '%Y-%m-%d') = '2024-01-03' AND hour(ts) = 5""", "files")
def _(t):
    root = new_root(t)
    write_hourly(hourly_rows(t), root)
    return scan_partitions(t.spark, root, "2024-01-03", "5").select("event_id", "hour")


@query("write_read_sidecars", """SELECT strftime(ts, '%Y%m%d%H') AS at, concat('EPSG:326', CAST(min(user_id) % 20 + 20 AS VARCHAR)) AS crs, count(*) AS n, min(lon) AS lon FROM files GROUP BY 1""", "files")
def _(t):
    root = new_root(t)
    docs = hourly_rows(t).groupBy(*HOUR_KEYS).agg(
        F.concat(F.lit("EPSG:326"), (F.min("user_id") % 20 + 20).cast("string")).alias("crs"), F.count(F.lit(1)).cast("string").alias("source_model"),
        F.array(F.struct(F.lit("p").alias("name"), F.min("lon").alias("lon"), F.min("lat").alias("lat"))).alias("test_points"))
    write_sidecars(docs, root)
    return read_sidecars(t.spark, root).select(
        F.concat(*HOUR_KEYS).alias("at"), "crs", F.col("source_model").cast("bigint").alias("n"), F.col("test_points")[0]["lon"].alias("lon"))


@query("write_read_metrics", """WITH m AS (SELECT rid, obs_speed, CASE WHEN rid % 3 = 0 THEN 7 ELSE station END AS buoy_id FROM pairs)
 SELECT buoy_id, count(*) AS n, CAST(sum(rid) AS BIGINT) AS rids, round(sum(obs_speed), 4) + 0e0 AS speed, true AS bounded FROM m GROUP BY buoy_id""", "pairs")
def _(t):
    """One buoy holds a third of all rows; no file is larger than the target."""
    root, target = stage_path(t.spark, "reports"), 5000
    write_metrics({"speeds": t.pairs.selectExpr("rid", "obs_speed", "CASE WHEN rid % 3 = 0 THEN 7 ELSE station END AS buoy_id")}, root, rows_per_file=target)
    rows = t.spark.read.option("header", True).schema("rid long, obs_speed double, buoy_id int").csv(f"{root}/speeds").withColumn("file", F.expr("_metadata.file_path"))
    files = rows.groupBy("buoy_id", "file").agg(F.count(F.lit(1)).alias("n"), F.sum("rid").alias("rids"), F.sum("obs_speed").alias("speed"))
    return files.groupBy("buoy_id").agg(F.sum("n").alias("n"), F.sum("rids").alias("rids"), (F.round(F.sum("speed"), 4) + 0.0).alias("speed"), (F.max("n") <= target).alias("bounded"))


@query("write_read_subset", f"WITH {SUBSET} SELECT event_id, user_id, lon, lat FROM sub", "files")
def _(t):
    rows = t.files.withColumn("node_id", F.col("user_id").cast("string"))
    path = stage_path(t.spark, "subset")
    write_subset(catalog.subset(rows, t.supplier.filter("s_nationkey < 12").select(F.col("s_suppkey").alias("node_id")), BOX), path)
    return t.spark.read.parquet(path).select("event_id", "user_id", "lon", "lat")
