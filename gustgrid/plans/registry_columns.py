"""Registered queries: scans as expressions, scalar operators and geometry (S*, P*, G*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gustgrid.functions import crs, geometry as geo, text as tx, times as tm, wind
from gustgrid.operators import catalog, projection, regions
from gustgrid.plans.views import with_views
from gustgrid.sources import cube, inputs

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def r(c, digits=6):
    """Rounded value without a negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits) + F.lit(0.0)


def stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def query(name: str, sql: str | None = None, *views: str):
    """Register a query with its oracle."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, *views) if views else sql.strip()
        return fn
    return add


# --- scans and work lists -------------------------------------------------------------------

@query("explode_cube", """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:00:00Z') AS timestamp, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour,
       CAST(((rn - 1) % 4) AS INT) AS ix, CAST((rn - 1) // 4 AS INT) AS iy, ((rn - 1) % 4) * 4e0 AS x, ((rn - 1) // 4) * 4e0 AS y,
       round(lon, 6) + 0e0 AS lon, round(lat, 6) + 0e0 AS lat, CAST(CAST(value AS FLOAT) AS DOUBLE) AS wind_speed,
       CAST(event_id % 360 AS DOUBLE) AS wind_dir, CAST(user_id AS DOUBLE) AS topo, 'wrf4km' AS source_model
FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY event_id) AS rn FROM files)""", "files")
def _(t):
    cells = F.sort_array(F.collect_list(F.struct("event_id", "lon", "lat", "value", "user_id")))
    # One cube per hour: at most the events of one hour, four columns wide.
    cubes = t.files.groupBy("path").agg(F.date_trunc("hour", F.min("ts")).alias("time"), cells.alias("c")).select(
        "time", F.expr("transform(sequence(0, 3), i -> i * 4e0)").alias("x"),
        F.expr("transform(sequence(0, size(c) div 4), i -> i * 4e0)").alias("y"),
        F.col("c.lat").alias("lat"), F.col("c.lon").alias("lon"), F.col("c.value").alias("mod"),
        F.expr("transform(c, e -> e.event_id % 360)").alias("dir"), F.col("c.user_id").alias("topo"),
    )
    return cube.explode_cube(cubes, "wrf4km").select(
        "timestamp", "date", "hour", "ix", "iy", "x", "y", r("lon").alias("lon"), r("lat").alias("lat"),
        *(F.col(c).cast("double").alias(c) for c in ("wind_speed", "wind_dir", "topo")), "source_model",
    )


@query("read_points", """
SELECT s_name AS name, -9e0 + s_nationkey * 0.05e0 AS lon, 42e0 + s_acctbal * 0.0001e0 AS lat FROM supplier""")
def _(t):
    rows = t.supplier.selectExpr(
        "CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS name", "CASE WHEN s_suppkey % 2 = 1 THEN s_name END AS test_point",
        "CASE WHEN s_suppkey % 3 = 0 THEN CAST(-9e0 + s_nationkey * 0.05e0 AS STRING) ELSE '' END AS lon",
        "CASE WHEN s_suppkey % 3 <> 0 THEN CAST(-9e0 + s_nationkey * 0.05e0 AS STRING) END AS longitude",
        "CAST(42e0 + s_acctbal * 0.0001e0 AS STRING) AS latitude",
    )
    return inputs.points_from_rows(rows)


@query("read_regions", """
SELECT name AS region_name, CAST(p - 1 AS INT) AS pos, CASE p WHEN 1 THEN n WHEN 2 THEN n + 1 ELSE n END AS lon, CASE p WHEN 1 THEN 0e0 WHEN 2 THEN 1e0 ELSE 2.5e0 END AS lat
FROM (SELECT s_name AS name, CAST(s_nationkey AS DOUBLE) AS n FROM supplier), (VALUES (1), (2), (3)) v(p)""")
def _(t):
    rings = inputs.rings_from_geojson(_geojson(t), name=F.col("name"), first_only=True)
    return rings.select("region_name", F.posexplode("ring").alias("pos", "p")).select("region_name", "pos", "p.lon", "p.lat")


@query("read_regions_all", """
WITH s AS (SELECT s_name AS region_name, s_suppkey AS k, CAST(s_nationkey AS DOUBLE) AS n FROM supplier),
r AS (SELECT region_name, k, n, 0 AS part FROM s UNION ALL SELECT region_name, k, n, 1 FROM s WHERE k % 2 <> 0)
SELECT region_name, 0 AS feature, part, 0 AS ring_no, CAST(p - 1 AS INT) AS pos,
 CASE WHEN part = 1 THEN 10e0 - p WHEN p = 2 THEN n + 1 ELSE n END AS lon, CASE WHEN part = 1 THEN 10e0 - p WHEN p = 1 THEN 0e0 WHEN p = 2 THEN 1e0 ELSE 2.5e0 END AS lat
FROM r, (VALUES (1), (2), (3)) v(p)""")
def _(t):
    rings = inputs.rings_from_geojson(_geojson(t), name=F.col("name"))
    return rings.select("region_name", "feature", "part", "ring_no", F.posexplode("ring").alias("pos", "p")).select("region_name", "feature", "part", "ring_no", "pos", "p.lon", "p.lat")


def _geojson(t):
    ring = "concat('[[', n, ',0],[', n + 1, ',1],[', n, ',2.5]]')"
    geometry = f"CASE k % 2 WHEN 0 THEN concat('{{\"type\":\"Polygon\",\"coordinates\":[', {ring}, ']}}') ELSE concat('{{\"type\":\"MultiPolygon\",\"coordinates\":[[', {ring}, '],[[[9,9],[8,8],[7,7]]]]}}') END"
    return t.supplier.selectExpr("s_name AS name", "s_suppkey AS k", "s_nationkey AS n").selectExpr("name", "k", f"{geometry} AS g").selectExpr(
        "name", """CASE k % 3 WHEN 0 THEN g WHEN 1 THEN concat('{"type":"Feature","geometry":', g, '}')
        ELSE concat('{"type":"FeatureCollection","features":[{"type":"Feature","geometry":', g, '}]}') END AS value""")


@query("source_manifest", """
WITH spans AS (SELECT o_orderpriority AS pr, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY 1),
m(model, base, file, style) AS (VALUES
 ('wrf4km', 'https://mandeo.meteogalicia.es/thredds/fileServer/modelos/WRF_HIST/d03', 'wrf_arw_det_history_d03_', 1),
 ('wrf1_3km', 'https://mandeo.meteogalicia.es/thredds/fileServer/modelos/WRF_ARW_1KM_HIST/d05', 'wrf_arw_det1km_history_d05_', 1),
 ('wrf1km', 'https://mandeo.meteogalicia.es/thredds/fileServer/modelos/WRF_ARW_1KM_HIST_Novo', 'wrf_arw_det_history_d02_', 2)),
days AS (SELECT CASE left(pr, 1) WHEN '1' THEN 'wrf4km' WHEN '2' THEN 'wrf1_3km' ELSE 'wrf1km' END AS model, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d FROM spans)
SELECT m.model, strftime(d, '%Y-%m-%d') AS date,
 concat(base, '/', CASE style WHEN 1 THEN strftime(d, '%Y/%m') ELSE strftime(d, '%Y%m%d') END, '/', file, strftime(d, '%Y%m%d'), '_0000.nc4') AS url
FROM days JOIN m USING (model)""")
def _(t):
    spans = t.orders.groupBy("o_orderpriority").agg(F.min("o_orderdate").cast("date").alias("start_date"), F.max("o_orderdate").cast("date").alias("end_date"))
    ranges = spans.selectExpr("CASE left(o_orderpriority, 1) WHEN '1' THEN 'wrf4km' WHEN '2' THEN 'wrf1_3km' ELSE 'wrf1km' END AS model", "start_date", "end_date")
    return inputs.source_manifest(ranges, inputs.model_table(t.spark))


@query("missing_hours", """
WITH present AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour FROM events WHERE event_type = 'click'),
d AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date FROM events),
e AS (SELECT date, lpad(CAST(h AS VARCHAR), 2, '0') AS hour FROM d, generate_series(0, 23) g(h))
SELECT date, hour, concat('year=', date[1:4], '/month=', date[6:7], '/day=', date[9:10], '/hour=', hour) AS partition
FROM e ANTI JOIN present USING (date, hour)""")
def _(t):
    days = t.events.select(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.date_format("ts", "HH").alias("hour"), "event_type")
    return inputs.missing_hours(inputs.hour_manifest(days), days.filter("event_type = 'click'"))


@query("hour_manifest", """
SELECT date, lpad(CAST(h AS VARCHAR), 2, '0') AS hour,
 concat('year=', date[1:4], '/month=', date[6:7], '/day=', date[9:10], '/hour=', lpad(CAST(h AS VARCHAR), 2, '0')) AS partition
FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date FROM events), generate_series(0, 23) g(h)""")
def _(t):
    return inputs.hour_manifest(t.events.select(F.date_format("ts", "yyyy-MM-dd").alias("date")))


# --- scalar expressions -----------------------------------------------------------------------

@query("uv_from_speed_dir", """
SELECT station, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(-wind_speed * sin(radians(wind_dir % 360)), 6) + 0e0 AS u,
       round(-wind_speed * cos(radians(wind_dir % 360)), 6) + 0e0 AS v FROM obs""", "obs")
def _(t):
    u, v = wind.uv_from_speed_dir(F.col("wind_speed"), F.col("wind_dir"))
    return t.obs.select("station", stamp("ts").alias("ts"), r(u).alias("u"), r(v).alias("v"))


@query("speed_dir_from_uv", """
SELECT id, round(sqrt(u*u + v*v), 6) + 0e0 AS wind_speed,
 round(CASE WHEN degrees(atan2(-u, -v)) < 0 THEN degrees(atan2(-u, -v)) + 360 ELSE degrees(atan2(-u, -v)) END, 6) + 0e0 AS wind_dir FROM grid""", "grid")
def _(t):
    u, v = F.col("u"), F.col("v")
    return t.grid.select("id", r(wind.speed_from_uv(u, v)).alias("wind_speed"), r(wind.dir_from_uv(u, v)).alias("wind_dir"))


@query("time_columns", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour, strftime(ts, '%Y-%m-%dT%H:00:00Z') AS timestamp,
 strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day FROM events""")
def _(t):
    return t.events.select("event_id", *(c.alias(n) for n, c in tm.hour_columns(F.col("ts")).items()))


@query("height_correct", """
SELECT station, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(wind_speed * ln(10 / 0.0002e0) / ln(3 / 0.0002e0), 6) + 0e0 AS fixed,
 round(wind_speed * ln((10 + station) / 0.0002e0) / ln((3 + station) / 0.0002e0), 6) + 0e0 AS by_plan FROM obs""", "obs")
def _(t):
    s = F.col("wind_speed")
    by_plan = wind.height_correct(s, F.col("station") + 3.0, F.col("station") + 10.0, wind.ROUGHNESS)
    return t.obs.select("station", stamp("ts").alias("ts"), r(wind.height_correct(s)).alias("fixed"), r(by_plan).alias("by_plan"))


@query("clean_sentinels", """
SELECT event_id, wind_speed, wind_dir FROM raw WHERE wind_speed > -9000 AND wind_dir > -9000 AND ts IS NOT NULL""", "raw")
def _(t):
    cleaned = t.raw.select("event_id", "ts", *(wind.clean_sentinel(F.col(c)).alias(c) for c in ("wind_speed", "wind_dir")))
    return cleaned.dropna(subset=["ts", "wind_speed", "wind_dir"]).drop("ts")


@query("time_window", """
SELECT station, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(wind_speed, 6) + 0e0 AS wind_speed FROM obs
WHERE (station = 0 OR ts >= TIMESTAMP '2024-01-05 06:00:00') AND ts <= TIMESTAMP '2024-01-20 18:00:00'""", "obs")
def _(t):
    start = F.when(F.col("station") != 0, F.lit("2024-01-05 06:00:00").cast("timestamp_ntz"))
    kept = t.obs.filter(tm.in_window(F.col("ts"), start, F.lit("2024-01-20 18:00:00").cast("timestamp_ntz")))
    return kept.select("station", stamp("ts").alias("ts"), r("wind_speed").alias("wind_speed"))


@query("parse_timestamp", """
SELECT event_id, CASE event_id % 5 WHEN 1 THEN strftime(ts, '%Y-%m-%d 00:00:00') WHEN 4 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts FROM events""")
def _(t):
    text = F.expr("""CASE event_id % 5 WHEN 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'") WHEN 1 THEN date_format(ts, 'yyyy-MM-dd')
        WHEN 2 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') WHEN 3 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'") ELSE concat('bad ', event_id) END""")
    return t.events.select("event_id", stamp(tm.parse_timestamp(text)).alias("ts"))


@query("filter_nodes", """
SELECT id, round(u, 6) + 0e0 AS u FROM grid WHERE id IN (SELECT DISTINCT l_suppkey * 7 FROM lineitem)""", "grid")
def _(t):
    ids = t.lineitem.select((F.col("l_suppkey") * 7).cast("string").alias("node_id"))
    rows = t.grid.withColumn("node_id", F.col("id").cast("string"))
    return catalog.filter_nodes(rows, ids).select("id", r("u").alias("u"))


CRS_TEXT = """concat('+proj=lambert_conformal_conic +lat_1=', CAST(40 + event_id % 5 AS VARCHAR(3)), ' +lon_0=', CAST(event_id % 720 - 360 AS VARCHAR(5)),
 CASE WHEN event_id % 2 = 0 THEN ' +datum=WGS84' ELSE '' END, CASE WHEN event_id % 3 = 0 THEN ' +no_defs' ELSE '' END)"""


@query("normalize_crs", f"""
SELECT event_id, concat(regexp_replace(replace(c, 'lambert_conformal_conic', 'lcc'), '\\+lon_0=[^ ]+',
   concat('+lon_0=', CAST(((event_id % 720 - 360 + 180) % 360 + 360) % 360 - 180 AS VARCHAR))),
 CASE WHEN event_id % 3 = 0 THEN '' ELSE ' +no_defs' END, ' +ellps=WGS84', CASE WHEN event_id % 2 = 0 THEN '' ELSE ' +datum=WGS84' END) AS crs
FROM (SELECT event_id, {CRS_TEXT} AS c FROM events)""")
def _(t):
    return t.events.selectExpr("event_id", f"{CRS_TEXT} AS c").select("event_id", crs.normalize_crs(F.col("c")).alias("crs"))


@query("build_crs", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('+proj=lambert_conformal_conic +lat_1=', CAST(40 + event_id % 7 AS VARCHAR),
 CASE WHEN event_id % 2 = 0 THEN ' +lat_2=43.5' ELSE '' END, ' +lon_0=', CAST(event_id % 90 AS VARCHAR), ' +lat_0=34.8',
 CASE WHEN event_id % 3 = 0 THEN ' +x_0=0.0' ELSE '' END, CASE WHEN event_id % 4 = 0 THEN ' +units=m' ELSE ' +units=km' END) END AS crs FROM events""")
def _(t):
    attrs = F.expr("""map('grid_mapping_name', CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'lambert_conformal_conic' END,
        'standard_parallel', CASE WHEN event_id % 2 = 0 THEN concat('[', 40 + event_id % 7, ', 43.5]') ELSE CAST(40 + event_id % 7 AS STRING) END,
        'longitude_of_central_meridian', CAST(event_id % 90 AS STRING), 'latitude_of_projection_origin', '34.8',
        'false_easting', CASE WHEN event_id % 3 = 0 THEN '0.0' END, 'units', CASE WHEN event_id % 4 = 0 THEN 'm' ELSE '' END)""")
    return t.events.select("event_id", attrs.alias("a")).select("event_id", crs.build_crs(F.col("a")).alias("crs"))


@query("resolve_crs", """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'side' WHEN event_id % 5 = 0 THEN 'plain' WHEN event_id % 3 = 0 THEN 'global' WHEN event_id % 2 = 0 THEN 'column'
 WHEN event_id % 11 = 0 THEN 'EPSG:32629' ELSE NULL END AS crs FROM events""")
def _(t):
    cols = t.events.selectExpr(
        "event_id", "map('nc_proj_string', CASE WHEN event_id % 7 = 0 THEN 'side' ELSE '' END, 'crs', CASE WHEN event_id % 5 = 0 THEN 'plain' END) AS s",
        "map('proj4', CASE WHEN event_id % 3 = 0 THEN 'global' END) AS g", "CASE WHEN event_id % 2 = 0 THEN 'column' ELSE '' END AS c",
        "array('note', CASE WHEN event_id % 11 = 0 THEN 'EPSG:32629' ELSE 'none' END) AS strings")
    return cols.select("event_id", crs.resolve_crs(F.col("s"), F.col("g"), F.col("c"), F.col("strings")).alias("crs"))


@query("constant_column", """
SELECT path, min(source_model) AS source_model, min(source_model) <> max(source_model) AS conflict FROM files GROUP BY path""", "files")
def _(t):
    return catalog.constant_column(t.files, ["path"], "source_model")


@query("partition_keys", """
SELECT event_id, strftime(s, '%Y-%m-%d %H:%M:%S') AS start_ts, strftime(s + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS end_ts,
 CASE WHEN event_id % 4 = 3 THEN NULL ELSE strftime(ts, '%Y') END AS year
FROM (SELECT *, CASE event_id % 4 WHEN 0 THEN date_trunc('hour', ts) WHEN 1 THEN date_trunc('day', ts) WHEN 2 THEN date_trunc('month', ts) END AS s FROM files)""", "files")
def _(t):
    path = F.expr("""CASE event_id % 4 WHEN 0 THEN path WHEN 1 THEN regexp_replace(path, '/hour=[0-9]+', '')
        WHEN 2 THEN regexp_replace(path, '/day=.*/data', '/data') ELSE '/data/plain.parquet' END""")
    cut = t.files.select("event_id", path.alias("p"))
    return cut.select("event_id", stamp(tm.partition_start(F.col("p"))).alias("start_ts"), stamp(tm.partition_end(F.col("p"))).alias("end_ts"),
                      tm.partition_value(F.col("p"), "year").alias("year"))


@query("sidecar_path", """
SELECT event_id, concat('/data/metadata/winds/', path[13:45], '/metadata.json') AS sidecar FROM files""", "files")
def _(t):
    return t.files.select("event_id", tx.sidecar_path(F.col("path")).alias("sidecar"))


@query("slugify", """
SELECT p_partkey, lower(coalesce(nullif(trim(regexp_replace(concat(' -', p_name, '#', p_brand, '--'), '[^A-Za-z0-9]+', '_', 'g'), '_'), ''), 'buoy')) AS slug,
 CASE WHEN p_size % 2 = 0 THEN 'buoy_01' ELSE 'x' END AS empty FROM part""")
def _(t):
    return t.part.select(
        "p_partkey", tx.slugify(F.concat(F.lit(" -"), "p_name", F.lit("#"), "p_brand", F.lit("--")), F.lit("buoy")).alias("slug"),
        tx.slugify(F.when(F.col("p_size") % 2 == 0, F.when(F.col("p_size") % 4 == 0, "--").otherwise("")).otherwise("X"), F.lit("buoy_01")).alias("empty"),
    )


@query("classify_plot_file", """
SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL WHEN 3 THEN 'grid-mesh' ELSE 'variogram' END AS plot_type,
 CASE event_id % 5 WHEN 0 THEN 'u' WHEN 1 THEN 'v' WHEN 2 THEN 'u' END AS plot_component,
 CASE event_id % 5 WHEN 0 THEN 'ordinary-kriging' WHEN 1 THEN 'regression-kriging' WHEN 2 THEN 'ordinary-kriging' END AS plot_variant FROM events""")
def _(t):
    name = F.expr("""CASE event_id % 5 WHEN 0 THEN concat('variogram_u_empirical_', event_id, '.png') WHEN 1 THEN concat('Variogram_v_rkt_empirical_', event_id, '.png')
        WHEN 2 THEN 'variogram_u_empirical_.png' WHEN 3 THEN concat('grid_points_', event_id, '.png') ELSE 'other.png' END""")
    named = t.events.select("event_id", name.alias("n"))
    n = F.col("n")
    return named.select("event_id", tx.plot_type(n).alias("plot_type"), tx.plot_component(n).alias("plot_component"), tx.plot_variant(n).alias("plot_variant"))


@query("apply_overrides", """
SELECT event_id, 'fixed' AS license, CASE WHEN event_id % 2 = 0 THEN event_type END AS model, 'doi' AS doi,
 CASE WHEN event_id % 3 = 0 THEN 'given' ELSE concat('file', CAST(event_id AS VARCHAR)) END AS href FROM events""")
def _(t):
    maps = t.events.selectExpr(
        "event_id", "map('properties', map('license', 'own', 'model', CASE WHEN event_id % 2 = 0 THEN event_type END), 'data', map('href', concat('file', event_id))) AS base",
        "CASE WHEN event_id % 3 = 0 THEN map('properties', map('license', 'fixed'), 'data', map('href', 'given'), 'extra', map('doi', 'doi')) "
        "ELSE map('properties', map('license', 'fixed'), 'extra', map('doi', 'doi')) END AS o")
    m = maps.select("event_id", tx.merge_json_maps(F.col("base"), F.col("o")).alias("m"))
    return m.select("event_id", F.col("m")["properties"]["license"].alias("license"), F.col("m")["properties"]["model"].alias("model"),
                    F.col("m")["extra"]["doi"].alias("doi"), F.col("m")["data"]["href"].alias("href"))


# --- geometry -----------------------------------------------------------------------------------

LAMBERT = "+proj=lcc +lat_1=43 +lat_2=43 +lat_0=34.823 +lon_0=-14.1 +units=km +ellps=WGS84"


@query("reproject", """
SELECT id, round(lon, 6) + 0e0 AS lon_utm, round(lat, 6) + 0e0 AS lat_utm, round(lon, 6) + 0e0 AS lon_lcc, round(lat, 6) + 0e0 AS lat_lcc FROM grid""", "grid")
def _(t):
    out = t.grid.select("id", "lon", "lat")
    for name, text in (("utm", "EPSG:32629"), ("lcc", LAMBERT)):
        p = crs.projection_from_text(text)
        out = projection.project(out, p, x=f"x_{name}", y=f"y_{name}")
        out = projection.unproject(out, p, f"x_{name}", f"y_{name}", f"lon_{name}", f"lat_{name}")
    return out.select("id", *(r(c).alias(c) for c in ("lon_utm", "lat_utm", "lon_lcc", "lat_lcc")))


@query("wkb_points", "SELECT id, lon, lat, 21 AS bytes FROM grid", "grid")
def _(t):
    coded = t.grid.select("id", geo.lonlat_to_wkb("lon", "lat").alias("g"))
    return coded.select("id", F.length("g").alias("bytes"), geo.wkb_to_lonlat("g").alias("p")).select("id", "p.lon", "p.lat", "bytes")


CONCAVE = [(0.0, 0.0), (40.0, 0.0), (40.0, 60.0), (20.0, 30.0), (0.0, 60.0)]
EDGES = "e(x1, y1, x2, y2) AS (VALUES " + ", ".join(
    f"({a[0]!r}::DOUBLE, {a[1]!r}::DOUBLE, {b[0]!r}::DOUBLE, {b[1]!r}::DOUBLE)" for a, b in zip(CONCAVE, CONCAVE[1:] + CONCAVE[:1])) + ")"
INSIDE = """inside AS (SELECT id FROM grid, e GROUP BY id, x, y HAVING
 sum(CASE WHEN (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) % 2 = 1
 OR bool_or((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) = 0 AND x BETWEEN least(x1, x2) AND greatest(x1, x2) AND y BETWEEN least(y1, y2) AND greatest(y1, y2)))"""


@query("points_in_polygon", f"WITH {EDGES}, {INSIDE} SELECT id FROM inside", "grid")
def _(t):
    return regions.points_in_polygon(t.grid, CONCAVE, "x", "y").select("id")


@query("points_in_polygon_column", f"WITH {EDGES}, {INSIDE} SELECT id FROM inside", "grid")
def _(t):
    """The same with the ring as a column, as for rings read from sidecars."""
    return t.grid.withColumn("ring", geo.ring_column(CONCAVE)).filter(geo.in_ring(F.col("x"), F.col("y"), F.col("ring"))).select("id")


@query("points_near_polygon", f"""WITH {EDGES}, {INSIDE},
near AS (SELECT id, min((x - (x1 + t * (x2 - x1))) ** 2 + (y - (y1 + t * (y2 - y1))) ** 2) AS d2 FROM
 (SELECT *, greatest(0, least(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2))) AS t FROM grid, e) GROUP BY id)
SELECT id FROM near WHERE d2 <= 42.25 OR id IN (SELECT id FROM inside)""", "grid")
def _(t):
    return regions.points_near_polygon(t.grid, CONCAVE, 6.5).select("id")


@query("polygon_prep", """
SELECT pk, 4 AS n, y0 AS first_lon, x0 AS first_lat, y1 AS second_lon, x1 AS second_lat, y0 AS last_lon FROM
 (SELECT pk, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM tiles GROUP BY pk)""", "tiles")
def _(t):
    box = t.tiles.groupBy("pk").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))
    pairs = F.expr("array(array(x0, y0), array(x1, y1), array(x0, y1))")
    ring = box.select("pk", pairs.alias("pairs")).select("pk", geo.close_ring(geo.swap_ring(geo.ring_from_pairs(F.col("pairs")))).alias("r"))
    return ring.selectExpr("pk", "size(r) AS n", "r[0].lon AS first_lon", "r[0].lat AS first_lat", "r[1].lon AS second_lon", "r[1].lat AS second_lat", "r[3].lon AS last_lon")


@query("bbox", """
SELECT path, min(lon) AS min_lon, min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat FROM files GROUP BY path""", "files")
def _(t):
    return regions.bbox(t.files, ["path"])


@query("merge_bbox", """
SELECT source_model, min(lon) AS min_lon, min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat FROM files GROUP BY source_model""", "files")
def _(t):
    return regions.merge_bbox(regions.bbox(t.files, ["path", "source_model"]), ["source_model"])


@query("bbox_ring", """
SELECT pk, CAST(p AS INT) AS pos, CASE WHEN p IN (1, 2) THEN x1 ELSE x0 END AS lon, CASE WHEN p IN (2, 3) THEN y1 ELSE y0 END AS lat FROM
 (SELECT pk, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM tiles GROUP BY pk), generate_series(0, 4) g(p)""", "tiles")
def _(t):
    box = t.tiles.groupBy("pk").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))
    ring = geo.bbox_ring(*(F.col(c) for c in ("x0", "y0", "x1", "y1")))
    return box.select("pk", F.posexplode(ring).alias("pos", "p")).select("pk", "pos", "p.lon", "p.lat")


WEST, EAST = [(-9.0, 42.0), (-8.6, 42.0), (-8.6, 42.4), (-9.0, 42.4)], [(-5.0, 40.0), (-4.0, 40.0), (-4.0, 41.0)]


@query("region_report", """
SELECT pk, n AS region_name, min(lon) AS min_lon, min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat, a AS region_min_lon, b AS region_min_lat, c AS region_max_lon, d AS region_max_lat,
 CASE n WHEN 'east' THEN 0 ELSE count(*) FILTER (lon BETWEEN a AND c AND lat BETWEEN b AND d) END AS points_inside
FROM tiles, (VALUES ('west', -9e0, 42e0, -8.6e0, 42.4e0), ('east', -5e0, 40e0, -4e0, 41e0)) v(n, a, b, c, d) GROUP BY pk, n, a, b, c, d""", "tiles")
def _(t):
    return regions.region_report(t.tiles, {"west": WEST, "east": EAST}, ["pk"])


def _parsed_regions(t):
    from gustgrid.sources.hours import REGION_TYPE

    return t.raw_regions.select("event_id", F.from_json("doc", f"array<{REGION_TYPE}>").alias("regions"))


@query("edit_regions", """
SELECT event_id, concat(event_type, ',zone', CAST(user_id % 4 AS VARCHAR), ',harbour') AS added,
 concat_ws(',', CASE WHEN event_type <> 'click' THEN event_type END, CASE WHEN user_id % 4 <> 1 THEN concat('zone', CAST(user_id % 4 AS VARCHAR)) END) AS removed FROM events""")
def _(t):
    def names(c):
        return F.concat_ws(",", F.transform(c, regions.region_label))

    added = regions.add_region(F.col("regions"), "harbour", WEST)
    removed = regions.remove_region(regions.remove_region(F.col("regions"), "click"), "zone1")
    return _parsed_regions(t).select("event_id", names(added).alias("added"), names(removed).alias("removed"))


@query("pick_region", """
SELECT event_id, event_type AS first_name, CAST(event_id % 7 AS DOUBLE) AS first_lon, CAST(event_id % 7 AS DOUBLE) AS named_lon FROM events""")
def _(t):
    picked = _parsed_regions(t).withColumn("f", regions.pick_region(F.col("regions")))
    named = F.get(F.filter("regions", lambda g: regions.region_label(g) == F.col("f.region_name")), F.lit(0))
    return picked.select("event_id", F.col("f.region_name").alias("first_name"), F.col("f.polygon")[0][0].alias("first_lon"), named["polygon"][0][0].alias("named_lon"))
