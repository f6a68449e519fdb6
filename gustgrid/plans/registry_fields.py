"""Registered queries: lattices, samples, variograms, neighbours, prediction, metrics and catalogs."""

from __future__ import annotations

from pyspark.sql import functions as F

from gustgrid.functions.crs import LonLat
from gustgrid.operators import catalog, kriging, lattice, metrics, neighbors, regions, sampling, trend, variogram
from gustgrid.params import InterpolationParams
from gustgrid.plans import compare, interpolate as interp
from gustgrid.plans.registry_columns import query, r, stamp
from gustgrid.session import stage


def rounded(df, digits=6, **special):
    """All floating columns rounded."""
    return df.select(*(
        r(f.name, special.get(f.name, digits)).alias(f.name) if f.dataType.typeName() == "double" else f.name for f in df.schema
    ))


# --- lattices -----------------------------------------------------------------------------------

@query("anchor_offset", """
SELECT pk, id, round(x + first_value(x * 1.5e0 + pk) OVER w, 6) + 0e0 AS x, round(y + first_value(y * 1.5e0 - pk) OVER w, 6) + 0e0 AS y
FROM tiles WINDOW w AS (PARTITION BY pk ORDER BY y, x)""", "tiles")
def _(t):
    rows = t.tiles.selectExpr("pk", "id", "x", "y", "x * 1.5e0 + pk AS proj_x", "y * 1.5e0 - pk AS proj_y")
    return rounded(lattice.anchor_offset(rows, ["pk"]).select("pk", "id", "x", "y"))


@query("local_coords", """
SELECT pk, id, round(lon - min(lon) OVER w, 6) + 0e0 AS x_local, round(lat - min(lat) OVER w, 6) + 0e0 AS y_local FROM tiles WINDOW w AS (PARTITION BY pk)""", "tiles")
def _(t):
    return rounded(lattice.local_coords(t.tiles, ["pk"], "lon", "lat").select("pk", "id", "x_local", "y_local"))


LATTICE_SQL = """lattice AS (SELECT pk, min(gap) AS base_res, min(c) FILTER (axis = 'x') AS min_x, min(c) FILTER (axis = 'y') AS min_y,
 max(c) FILTER (axis = 'x') - min(c) FILTER (axis = 'x') AS max_x_local, max(c) FILTER (axis = 'y') - min(c) FILTER (axis = 'y') AS max_y_local,
 count(*) FILTER (axis = 'x') AS n_x, count(*) FILTER (axis = 'y') AS n_y FROM
 (SELECT *, c - lag(c) OVER (PARTITION BY pk, axis ORDER BY c) AS gap FROM (SELECT DISTINCT pk, 'x' AS axis, x AS c FROM tiles UNION ALL SELECT DISTINCT pk, 'y', y FROM tiles)) GROUP BY pk)"""
REFINED_SQL = LATTICE_SQL + """, refined AS (SELECT pk, CAST(iy * nx + ix + 1 AS BIGINT) AS node, CAST(ix AS INT) AS ix, CAST(iy AS INT) AS iy, ix * s AS x_local, iy * s AS y_local,
 min_x + ix * s AS x, min_y + iy * s AS y, ix % 2 = 0 AND iy % 2 = 0 AS is_orig FROM
 (SELECT *, base_res / 2 AS s, CAST(max_x_local / (base_res / 2) AS BIGINT) + 1 AS nx, CAST(max_y_local / (base_res / 2) AS BIGINT) + 1 AS ny FROM lattice) l,
 LATERAL (SELECT unnest(generate_series(0, l.ny - 1)) AS iy) a, LATERAL (SELECT unnest(generate_series(0, l.nx - 1)) AS ix) b)"""


@query("infer_lattice", f"WITH {LATTICE_SQL} SELECT * FROM lattice", "tiles")
def _(t):
    return lattice.infer_lattice(t.tiles, ["pk"])


# Every tile twice, the copy far away; and every tile with one node beside its lines: the step stays.
@query("infer_lattice_patches", f"""WITH {LATTICE_SQL} SELECT pk, base_res, min_x, min_y, max_x_local + 40000e0 AS max_x_local, max_y_local + 80000e0 AS max_y_local, 2 * n_x AS n_x, 2 * n_y AS n_y FROM lattice""", "tiles")
def _(t):
    both = t.tiles.select("pk", "x", "y").union(t.tiles.selectExpr("pk", "x + 40000", "y + 80000"))
    return lattice.infer_lattice(both, ["pk"])


@query("infer_lattice_stray", f"WITH {LATTICE_SQL} SELECT * FROM lattice", "tiles")
def _(t):
    stray = t.tiles.groupBy("pk").agg(F.min("x").alias("x"), F.min("y").alias("y")).selectExpr("pk", "x + 9.375 AS x", "y - 0.0625 AS y")
    return lattice.infer_lattice(t.tiles.select("pk", "x", "y").union(stray), ["pk"])


@query("off_lattice", "SELECT pk, CAST(1 AS BIGINT) AS n, min(x) + 9.375 AS x, min(y) - 0.0625 AS y FROM tiles GROUP BY pk", "tiles")
def _(t):
    low = t.tiles.groupBy("pk").agg(F.min("x").alias("x"), F.min("y").alias("y")).selectExpr("pk", "x + 9.375 AS x", "y - 0.0625 AS y")
    rows = t.tiles.select("pk", "x", "y").union(low)
    beside = lattice.off_lattice(rows, lattice.infer_lattice(rows, ["pk"]), ["pk"])
    return beside.groupBy("pk").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x"), F.min("y").alias("y"))


def _refined(t, f=2):
    return lattice.refine_grid(lattice.infer_lattice(t.tiles, ["pk"]), ["pk"], f)


@query("refine_grid", f"WITH {REFINED_SQL} SELECT * FROM refined", "tiles")
def _(t):
    return _refined(t)


@query("assign_node_id", f"""WITH {REFINED_SQL}, moved AS (SELECT pk, id, CASE WHEN id % 5 = 0 THEN x + 0.7 ELSE x END AS x, y FROM tiles)
SELECT m.pk, m.id, r.node FROM moved m LEFT JOIN refined r ON m.pk = r.pk AND m.x = r.x AND m.y = r.y""", "tiles")
def _(t):
    moved = t.tiles.withColumn("x", F.when(F.col("id") % 5 == 0, F.col("x") + 0.7).otherwise(F.col("x")))
    return lattice.assign_node_id(moved, lattice.infer_lattice(t.tiles, ["pk"]), ["pk"], 2).select("pk", "id", "node")


@query("target_nodes", f"WITH {REFINED_SQL} SELECT pk, node, x, y FROM refined WHERE NOT is_orig", "tiles")
def _(t):
    return lattice.target_nodes(_refined(t)).select("pk", "node", "x", "y")


@query("append_points", f"""WITH {REFINED_SQL} SELECT pk, CAST(node AS VARCHAR) AS node_id, x, y, x_local, is_orig, false AS is_test_point FROM refined
UNION ALL SELECT pk, r_name, r_regionkey * 9e0, r_regionkey * 7e0, r_regionkey * 9e0 - min_x, false, true FROM lattice, region""", "tiles")
def _(t):
    points = t.region.selectExpr("r_name AS name", "r_regionkey * 9e0 AS lon", "r_regionkey * 7e0 AS lat")
    lat = lattice.infer_lattice(t.tiles, ["pk"])
    out = lattice.append_points(lattice.refine_grid(lat, ["pk"], 2), points, lat, ["pk"], LonLat())
    return out.select("pk", "node_id", "x", "y", "x_local", "is_orig", "is_test_point")


@query("append_many_points", f"""WITH {REFINED_SQL} SELECT pk, CAST(node AS VARCHAR) AS node_id, x, y, x_local, is_orig, false AS is_test_point FROM refined
UNION ALL SELECT pk, concat('c', CAST(c_custkey AS VARCHAR)), c_nationkey * 2e0, c_custkey * 0.5e0, c_nationkey * 2e0 - min_x, false, true FROM lattice, customer""", "tiles")
def _(t):
    points = t.customer.selectExpr("concat('c', c_custkey) AS name", "c_nationkey * 2e0 AS lon", "c_custkey * 0.5e0 AS lat")
    lat = lattice.infer_lattice(t.tiles, ["pk"])
    out = lattice.append_points(lattice.refine_grid(lat, ["pk"], 2), points, lat, ["pk"], LonLat())
    return out.select("pk", "node_id", "x", "y", "x_local", "is_orig", "is_test_point")


# Trends over rows with gaps: every fourth topography and every fifth u is missing.
@query("ols_with_nulls", """WITH d AS (SELECT pk, x, y, CASE WHEN id % 4 <> 0 THEN topo END AS topo, CASE WHEN id % 5 <> 0 THEN u END AS u, v FROM tiles)
SELECT pk, round(regr_slope(u, topo), 6) + 0e0 AS u_t1, round(regr_intercept(u, topo), 6) + 0e0 AS u_t0, round(regr_slope(v, topo), 6) + 0e0 AS v_t1,
 round(regr_intercept(v, topo), 6) + 0e0 AS v_t0, round(regr_r2(v, topo), 6) + 0e0 AS v_r2 FROM d GROUP BY pk""", "tiles")
def _(t):
    from gustgrid.operators.trend import ols_topo

    gaps = t.tiles.selectExpr("pk", "CASE WHEN id % 4 <> 0 THEN topo END AS topo", "CASE WHEN id % 5 <> 0 THEN u END AS u", "v")
    return rounded(ols_topo(gaps, ["pk"], ["u", "v"]).select("pk", "u_t1", "u_t0", "v_t1", "v_t0", "v_r2"))


@query("assemble_grid", f"""WITH {REFINED_SQL} SELECT r.pk, CAST(r.node AS VARCHAR) AS node_id, round(CASE WHEN is_orig THEN d.u ELSE r.x_local * 0.1 END, 6) + 0e0 AS u,
 round(CASE WHEN is_orig THEN d.u ELSE r.x_local * 0.2 END, 6) + 0e0 AS u_rkt, CASE WHEN NOT is_orig THEN 0.5e0 END AS kriging_var_u,
 CASE WHEN is_orig THEN 'original' ELSE 'interpolated' END AS interpolation_source
FROM refined r LEFT JOIN tiles d ON r.pk = d.pk AND r.x = d.x AND r.y = d.y""", "tiles")
def _(t):
    lat = lattice.infer_lattice(t.tiles, ["pk"])
    grid = lattice.refine_grid(lat, ["pk"], 2).selectExpr("*", "CAST(node AS STRING) AS node_id", "false AS is_test_point")
    data = lattice.assign_node_id(t.tiles, lat, ["pk"], 2).selectExpr("pk", "CAST(node AS STRING) AS node_id", "u", "v")
    made = lattice.target_nodes(grid).selectExpr(
        "pk", "node_id", "x_local * 0.1D AS u", "0D AS v", "x_local * 0.2D AS u_rkt", "0D AS v_rkt", "0.5D AS kriging_var_u", "0.5D AS kriging_var_v")
    out = lattice.assemble_grid(grid, data, made, ["pk"])
    return rounded(out.select("pk", "node_id", "u", "u_rkt", "kriging_var_u", "interpolation_source"))


# --- samples --------------------------------------------------------------------------------------

def _ranked(seed):
    return f"(SELECT *, row_number() OVER (PARTITION BY pk ORDER BY md5(concat('{seed}:', CAST(id AS VARCHAR(20)))), id) AS rk, count(*) OVER (PARTITION BY pk) AS n FROM tiles)"


@query("holdout_split", f"SELECT pk, id, rk <= ceil(n * 10 / 100e0) AS is_test FROM {_ranked(123)}", "tiles")
def _(t):
    return sampling.holdout_split(t.tiles, ["pk"], "id").select("pk", "id", "is_test")


@query("subsample_train", f"SELECT pk, id FROM {_ranked(124)} WHERE rk <= ceil(n * 33 / 100e0)", "tiles")
def _(t):
    return sampling.subsample(t.tiles, ["pk"], "id", 33.0).select("pk", "id")


@query("kfold", f"SELECT pk, id, CAST((rk - 1) % 5 AS INT) AS fold FROM {_ranked(125)}", "tiles")
def _(t):
    return sampling.kfold(t.tiles, ["pk"], "id", 5).select("pk", "id", "fold")


# --- trends and variograms --------------------------------------------------------------------------

MOMENTS = """SELECT pk, var, avg(x) AS mx, avg(y) AS my, avg(z) AS mz, var_pop(x) AS xx, var_pop(y) AS yy, covar_pop(x, y) AS xy, covar_pop(x, z) AS xz, covar_pop(y, z) AS yz
 FROM (SELECT pk, x, y, 'u' AS var, u AS z FROM tiles UNION ALL SELECT pk, x, y, 'v', v FROM tiles) GROUP BY pk, var"""
COEF = f"coef AS (SELECT *, mz - b1 * mx - b2 * my AS b0 FROM (SELECT *, (xz * yy - yz * xy) / (xx * yy - xy * xy) AS b1, (yz * xx - xz * xy) / (xx * yy - xy * xy) AS b2 FROM ({MOMENTS})))"
TCOEF = """tcoef AS (SELECT pk, regr_slope(u, topo) AS u_t1, regr_intercept(u, topo) AS u_t0, regr_r2(u, topo) AS u_r2,
 regr_slope(v, topo) AS v_t1, regr_intercept(v, topo) AS v_t0, regr_r2(v, topo) AS v_r2 FROM tiles GROUP BY pk)"""


def _r(*names):
    return ", ".join(f"round({n}, 6) + 0e0 AS {n}" for n in names)


@query("ols_xy", f"WITH {COEF} SELECT pk, " + ", ".join(f"round(max({b}) FILTER (var = '{v}'), 6) + 0e0 AS {v}_{b}" for v in "uv" for b in ("b0", "b1", "b2")) + " FROM coef GROUP BY pk", "tiles")
def _(t):
    return rounded(trend.ols_xy(t.tiles, ["pk"], ["u", "v"]))


@query("ols_topo", f"WITH {TCOEF} SELECT pk, {_r('u_t0', 'u_t1', 'u_r2', 'v_t0', 'v_t1', 'v_r2')} FROM tcoef", "tiles")
def _(t):
    return rounded(trend.ols_topo(t.tiles, ["pk"], ["u", "v"]))


RESIDUALS = f"""{COEF}, {TCOEF}, res AS (SELECT t.pk, id, t.x, t.y, t.u - (a.b0 + a.b1 * t.x + a.b2 * t.y) AS u_res, t.v - (b.b0 + b.b1 * t.x + b.b2 * t.y) AS v_res,
 t.u - (u_t0 + u_t1 * topo) AS u_tres, t.v - (v_t0 + v_t1 * topo) AS v_tres
 FROM tiles t JOIN coef a ON a.pk = t.pk AND a.var = 'u' JOIN coef b ON b.pk = t.pk AND b.var = 'v' JOIN tcoef c ON c.pk = t.pk)"""


@query("detrend", f"WITH {RESIDUALS} SELECT pk, id, {_r('u_res', 'v_res', 'u_tres', 'v_tres')} FROM res", "tiles")
def _(t):
    return rounded(trend.detrend(t.tiles, ["pk"], ["u", "v"]).select("pk", "id", "u_res", "v_res", "u_tres", "v_tres"))


CUTOFF, WIDTH = 20.0, 2.5
BINS = f"""{RESIDUALS}, pr AS (SELECT a.pk, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d, a.u_res - b.u_res AS u_res, a.v_res - b.v_res AS v_res, a.u_tres - b.u_tres AS u_tres, a.v_tres - b.v_tres AS v_tres
 FROM res a JOIN res b ON a.pk = b.pk AND a.id < b.id WHERE (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= {CUTOFF ** 2} AND (a.x <> b.x OR a.y <> b.y)),
bins AS (SELECT pk, var, CAST(ceil(d / {WIDTH}) AS INT) AS bin, count(*) AS np, avg(d) AS dist, sum(z * z) / (2 * count(*)) AS gamma FROM
 (UNPIVOT pr ON u_res, v_res, u_tres, v_tres INTO NAME var VALUE z) GROUP BY ALL)"""


def _bins(t):
    res = trend.detrend(t.tiles, ["pk"], ["u", "v"])
    return variogram.empirical_variogram(res, ["pk"], ["u_res", "v_res", "u_tres", "v_tres"], CUTOFF, WIDTH)


@query("empirical_variogram", f"WITH {BINS} SELECT pk, var, bin, np, {_r('dist', 'gamma')} FROM bins", "tiles")
def _(t):
    return rounded(_bins(t))


def _profile_sql(source, by):
    corr = "CASE model WHEN 'Exp' THEN exp(-dist / a) WHEN 'Gau' THEN exp(-(dist / a) * (dist / a)) ELSE CASE WHEN dist < a THEN 1 - 1.5e0 * (dist / a) + 0.5e0 * (dist / a) * (dist / a) * (dist / a) ELSE 0e0 END END"
    return f"""(SELECT {by}, c0, c1, WYY AS total, WYY - 2 * (c0 * WY + c1 * WGY) + c0 * c0 * W + 2 * c0 * c1 * WG + c1 * c1 * WGG AS sse FROM
 (SELECT *, CASE WHEN c0f < 0 THEN 0e0 ELSE c0f END AS c0, CASE WHEN c0f < 0 THEN WGY / WGG ELSE c1f END AS c1 FROM
 (SELECT *, (WY - c1f * WG) / W AS c0f FROM (SELECT *, (W * WGY - WG * WY) / (W * WGG - WG * WG) AS c1f FROM
 (SELECT {by}, count(*) AS bins, max(gamma) AS top, sum(w) AS W, sum(w*g) AS WG, sum(w*g*g) AS WGG, sum(w*gamma) AS WY, sum(w*g*gamma) AS WGY, sum(w*gamma*gamma) AS WYY FROM
 (SELECT *, np / (dist * dist) AS w, 1 - ({corr}) AS g FROM {source}) GROUP BY {by})
 WHERE bins >= 3 AND top > 1e-18 AND WGG > 0 AND W * WGG - WG * WG > 1e-12 * W * WGG))) WHERE c1 > 0)"""


_LOW, _STEP = WIDTH / 2, (10 * CUTOFF / (WIDTH / 2)) ** (1 / 59)
_LAST, _MORE = variogram.last_range(CUTOFF, WIDTH), variogram.MORE


def _coarse_sql() -> str:
    """The best range of the grid, which goes on by blocks while the best is its last one and the error falls enough."""
    out = f"""tried AS MATERIALIZED {_profile_sql(f"(SELECT bins.*, model, CAST(i AS BIGINT) AS i, {_LOW!r} * pow({_STEP!r}, i) AS a FROM bins, (VALUES ('Exp'), ('Gau'), ('Sph')) m(model), generate_series(0, {_LAST}) g(i))", "pk, var, model, i, a")},
 r0 AS MATERIALIZED (SELECT pk, var, model, arg_min(i, (sse, i)) AS i, arg_min(a, (sse, i)) AS a, min(sse) AS sse, any_value(total) AS total, arg_min(i, (sse, i)) = 59 AS open FROM tried WHERE i < 60 GROUP BY ALL)"""
    top, k = 59, 0
    while top < _LAST:
        first, top, k = top + 1, min(top + _MORE, _LAST), k + 1
        better = f"open AND f.sse IS NOT NULL AND r.sse - f.sse > {variogram.FALLS!r} * r.total"
        out += f""", r{k} AS MATERIALIZED (SELECT r.pk, r.var, r.model, CASE WHEN {better} THEN f.i ELSE r.i END AS i, CASE WHEN {better} THEN f.a ELSE r.a END AS a, CASE WHEN {better} THEN f.sse ELSE r.sse END AS sse, r.total,
 {better} AND f.i = {top} AS open FROM r{k - 1} r LEFT JOIN (SELECT pk, var, model, arg_min(i, (sse, i)) AS i, arg_min(a, (sse, i)) AS a, min(sse) AS sse FROM tried WHERE i BETWEEN {first} AND {top} GROUP BY ALL) f USING (pk, var, model))"""
    return f"{out}, coarse AS (SELECT pk, var, model, i, a FROM r{k})"


FITS = f"""{BINS}, {_coarse_sql()},
fits AS (SELECT pk, var, model, arg_min(c0, (sse, j)) AS nugget, arg_min(c1, (sse, j)) AS psill, arg_min(a, (sse, j)) AS range FROM
 {_profile_sql(f"(SELECT bins.*, model, i, j, c.a * pow({_STEP!r}, j / 20e0) AS a FROM bins JOIN coarse c USING (pk, var), generate_series(-20, 20) g(j))", "pk, var, model, i, j, a")} GROUP BY ALL)"""


@query("empirical_variogram_one_cell", """WITH pr AS (SELECT sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d, a.u - b.u AS u, a.v - b.v AS v FROM grid a JOIN grid b ON a.id < b.id
 WHERE (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 1e6 AND (a.x <> b.x OR a.y <> b.y))
 SELECT var, CAST(ceil(d / 50) AS INT) AS bin, count(*) AS np, round(avg(d), 6) + 0e0 AS dist, round(sum(z * z) / (2 * count(*)), 6) + 0e0 AS gamma FROM (UNPIVOT pr ON u, v INTO NAME var VALUE z) GROUP BY ALL""", "grid")
def _(t):
    """All points of one key lie within one cutoff, in a few cells."""
    return rounded(variogram.empirical_variogram(t.grid, [], ["u", "v"], 1e3, 50.0))


@query("fit_variogram", f"WITH {FITS} SELECT pk, var, model, {_r('nugget', 'psill')}, round(range, 4) + 0e0 AS range FROM fits", "tiles")
def _(t):
    fits = variogram.fit_variogram(stage(_bins(t), "bins"), ["pk"], CUTOFF, WIDTH)
    return rounded(fits.select("pk", "var", "model", "nugget", "psill", "range"), range=4)


# Variograms that still rise at the cutoff: exponential with ranges of 10 to 60 cutoffs, and a straight line.
@query("fit_variogram_rising", f"""WITH {BINS}
 SELECT DISTINCT pk, var, true AS range_found, false AS at_edge, 0.25e0 AS nugget FROM bins WHERE var = 'u_res' UNION ALL
 SELECT DISTINCT pk, 'line', true, true, 0.5e0 FROM bins WHERE var = 'v_res'""", "tiles")
def _(t):
    bins = stage(_bins(t), "bins")
    curve, line = bins.filter("var = 'u_res'"), bins.filter("var = 'v_res'")
    rising = curve.withColumn("gamma", F.expr("0.25D + (2 + pk) * (1 - exp(-dist / (200D * (1 + pk % 6))))")).unionByName(
        line.withColumns({"var": F.lit("line"), "gamma": F.expr("0.5D + dist")}))
    fits = variogram.fit_variogram(rising, ["pk"], CUTOFF, WIDTH).filter("model = 'Exp'")
    return fits.selectExpr("pk", "var", f"CASE WHEN var = 'line' THEN range >= 100 * {CUTOFF} ELSE abs(range / (200D * (1 + pk % 6)) - 1) < 0.05 END AS range_found",
                           "range_at_edge AS at_edge", "round(nugget, 2) + 0D AS nugget")


@query("first_valid_model", f"WITH {FITS} SELECT pk, var, arg_min(model, model) AS model, round(arg_min(psill, model), 6) + 0e0 AS psill FROM fits GROUP BY pk, var", "tiles")
def _(t):
    first = variogram.first_valid_model(variogram.fit_variogram(stage(_bins(t), "bins"), ["pk"], CUTOFF, WIDTH), ["pk"])
    return rounded(first.select("pk", "var", "model", "psill"))


# Scores derived from the fits stand in for cross-validation: the larger the nugget, the worse.
SCORES = "scores AS (SELECT pk, var, model, CASE WHEN (pk + length(model) + ascii(model)) % 3 = 0 THEN NULL ELSE round(nugget, 3) END AS rsr FROM fits)"
CHOSEN = f"""{FITS}, {SCORES}, chosen AS (SELECT k.pk, k.var, coalesce(b.model, 'IDW') AS model, b.nugget, b.psill, b.range FROM
 (SELECT DISTINCT pk, var FROM bins UNION ALL SELECT DISTINCT pk, 'none' FROM bins) k LEFT JOIN
 (SELECT f.*, row_number() OVER (PARTITION BY pk, var ORDER BY rsr, model) AS rk FROM fits f JOIN scores USING (pk, var, model) WHERE rsr IS NOT NULL) b ON b.pk = k.pk AND b.var = k.var AND rk = 1)"""


def _chosen(t, bins):
    fits = stage(variogram.fit_variogram(bins, ["pk"], CUTOFF, WIDTH), "fits")
    scores = fits.selectExpr("pk", "var", "model", "CASE WHEN (pk + length(model) + ascii(model)) % 3 = 0 THEN NULL ELSE round(nugget, 3) END AS rsr", "0D AS bias")
    every = bins.select("pk", "var").distinct().unionByName(bins.selectExpr("pk", "'none' AS var").distinct())
    return variogram.select_model(every, fits, scores, ["pk"])


@query("select_model", f"WITH {CHOSEN} SELECT pk, var, model FROM chosen", "tiles")
def _(t):
    return _chosen(t, stage(_bins(t), "bins")).select("pk", "var", "model")


@query("variogram_params", f"WITH {CHOSEN} SELECT pk, var, model, {_r('nugget')}, round(nugget + psill, 6) + 0e0 AS sill, round(range, 4) + 0e0 AS range FROM chosen", "tiles")
def _(t):
    return rounded(variogram.variogram_params(_chosen(t, stage(_bins(t), "bins")), ["pk"]), range=4)


@query("variogram_curve", f"""WITH {CHOSEN} SELECT b.pk, b.var, model, bin, np, round(gamma, 6) + 0e0 AS gamma, round(nugget + psill * (1 - CASE model WHEN 'Exp' THEN exp(-dist / range)
 WHEN 'Gau' THEN exp(-(dist / range) * (dist / range)) ELSE CASE WHEN dist < range THEN 1 - 1.5 * dist / range + 0.5 * (dist / range) ** 3 ELSE 0 END END), 6) + 0e0 AS fitted
FROM bins b JOIN chosen c ON b.pk = c.pk AND b.var = c.var WHERE model <> 'IDW'""", "tiles")
def _(t):
    bins = stage(_bins(t), "bins")
    return rounded(variogram.variogram_curve(bins, _chosen(t, bins), ["pk"]).drop("dist"))


# --- neighbours and prediction ------------------------------------------------------------------------

TARGETS = "targets AS (SELECT pk, id, x + 1.3e0 AS x, y + 0.9e0 AS y FROM tiles)"
KNN = f"""{TARGETS}, knn AS (SELECT * FROM (SELECT q.pk, q.id AS q_id, t.id AS t_id, t.u, t.topo, d2, row_number() OVER (PARTITION BY q.pk, q.id ORDER BY d2, t.id) AS rank FROM
 (SELECT q.pk, q.id, t.id AS tid, (q.x - t.x) * (q.x - t.x) + (q.y - t.y) * (q.y - t.y) AS d2 FROM targets q JOIN tiles t ON q.pk = t.pk) q JOIN tiles t ON t.pk = q.pk AND t.id = q.tid) WHERE rank <= 16)"""


def _targets(t):
    return t.tiles.selectExpr("pk", "id", "x + 1.3e0 AS x", "y + 0.9e0 AS y")


def _knn(t, k=16, **kw):
    return neighbors.knn_join(_targets(t), t.tiles, k, ["pk"], train_cols=["u", "v", "topo"], **kw)


@query("knn_join", f"WITH {KNN} SELECT pk, q_id, t_id, CAST(rank AS INT) AS rank, round(d2, 6) + 0e0 AS d2 FROM knn", "tiles")
def _(t):
    return rounded(_knn(t).select("pk", "q_id", "t_id", "rank", "d2"))


# One dense cluster and one far outlier per key, and keys a million units apart.
CLUSTERED = "clustered AS (SELECT id % 2 AS pk, id, CASE WHEN id < 2 THEN 1e6 ELSE x * 0.01e0 END + (id % 2) * 1e6 AS x, CASE WHEN id < 2 THEN 1e6 ELSE y * 0.01e0 END AS y FROM grid)"


@query("knn_join_clustered", f"""WITH {CLUSTERED}, near AS (SELECT q.pk, q.id AS q_id, t.id AS t_id, (q.x - t.x) * (q.x - t.x) + (q.y - t.y) * (q.y - t.y) AS d2
 FROM clustered q JOIN clustered t ON q.pk = t.pk)
SELECT pk, q_id, t_id, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY pk, q_id ORDER BY d2, t_id) AS rank FROM near) WHERE rank <= 5""", "grid")
def _(t):
    far = t.grid.selectExpr("id % 2 AS pk", "id", "CASE WHEN id < 2 THEN 1e6 ELSE x * 0.01e0 END + (id % 2) * 1e6 AS x", "CASE WHEN id < 2 THEN 1e6 ELSE y * 0.01e0 END AS y")
    return neighbors.knn_join(far, far, 5, ["pk"]).select("pk", "q_id", "t_id", "rank")


@query("knn_join_maxdist", f"WITH {KNN} SELECT pk, q_id, t_id, CAST(rank AS INT) AS rank FROM knn WHERE d2 <= 56.25 AND rank <= 9", "tiles")
def _(t):
    return _knn(t, 9, maxdist=7.5, spread="query").select("pk", "q_id", "t_id", "rank")


RANGE = f"{TARGETS}, near AS (SELECT q.pk, q.id AS q_id, t.u, t.v, t.id AS t_id, (q.x - t.x) ** 2 + (q.y - t.y) ** 2 AS d2 FROM targets q JOIN tiles t ON q.pk = t.pk WHERE (q.x - t.x) ** 2 + (q.y - t.y) ** 2 <= 81)"


@query("range_join", f"WITH {RANGE} SELECT pk, q_id, t_id, round(d2, 6) + 0e0 AS d2 FROM near", "tiles")
def _(t):
    return rounded(neighbors.range_join(_targets(t), t.tiles.withColumn("t_id", F.col("id")), 9.0, ["pk"], train_cols=["t_id"]).select("pk", "q_id", "t_id", "d2"))


@query("range_join_one_cell", """SELECT a.id AS q_id, count(*) AS n, sum((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d2, min(b.id) AS low_id
 FROM grid a JOIN grid b ON (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 1e6 GROUP BY a.id""", "grid")
def _(t):
    """All points of one key lie in four cells."""
    near = neighbors.range_join(t.grid, t.grid.withColumn("t_id", F.col("id")), 1e3, [], train_cols=["t_id"])
    return near.groupBy("q_id").agg(F.count(F.lit(1)).alias("n"), F.sum("d2").alias("d2"), F.min("t_id").alias("low_id"))


@query("idw", f"WITH {RANGE} SELECT pk, q_id, round(sum(u / d2) / sum(1 / d2), 6) + 0e0 AS u, round(sum(v / d2) / sum(1 / d2), 6) + 0e0 AS v FROM near GROUP BY pk, q_id", "tiles")
def _(t):
    return rounded(neighbors.idw_within(_targets(t), t.tiles, 9.0, ["pk"], ["u", "v"]))


@query("idw_nearest", f"WITH {KNN} SELECT pk, q_id, round(sum(topo / d2) / sum(1 / d2), 6) + 0e0 AS topo FROM knn GROUP BY pk, q_id", "tiles")
def _(t):
    return rounded(neighbors.idw_nearest(_knn(t), ["pk"], ["topo"]))


@query("neighbor_stats", f"WITH {KNN} SELECT pk, q_id, round(sqrt(min(d2)), 6) + 0e0 AS nearest_distance, CAST(count(*) FILTER (d2 <= 64) AS INT) AS neighbors_used FROM knn GROUP BY pk, q_id", "tiles")
def _(t):
    return rounded(neighbors.neighbor_stats(_knn(t), ["pk"], 8.0))


def _solved(t, value, drift, k=16, train=None, model="Exp", nugget=0.0, psill=1.5, rng=12.0):
    nb = neighbors.knn_join(_targets(t), train if train is not None else t.tiles, k, ["pk"], train_cols=[value])
    p = F.struct(F.lit(model).alias("model"), F.lit(nugget).alias("nugget"), F.lit(psill).alias("psill"), F.lit(rng).alias("range"))
    rows = kriging.gather_neighbors(nb, ["pk"], [value]).withColumn("p", p)
    return kriging.krige(rows, [kriging.Task("pred", "p", value, drift)], ["pk", "q_id"])


@query("universal_kriging", "SELECT pk, id AS q_id, round(3e0 + 0.5e0 * (x + 1.3e0) - 0.25e0 * (y + 0.9e0), 4) + 0e0 AS pred FROM tiles", "tiles")
def _(t):
    """A plane is reproduced exactly by a linear drift."""
    plane = t.tiles.selectExpr("pk", "id", "x", "y", "3e0 + 0.5e0 * x - 0.25e0 * y AS z")
    return rounded(_solved(t, "z", "xy", train=plane).select("pk", "q_id", "pred"), 4)


@query("universal_kriging_at_data", "SELECT pk, id AS q_id, round(u, 5) + 0e0 AS pred, 0e0 AS pred_var FROM tiles", "tiles")
def _(t):
    """Kriging is exact at data locations, with variance 0."""
    nb = neighbors.knn_join(t.tiles, t.tiles, 12, ["pk"], train_cols=["u"])
    p = F.struct(F.lit("Sph").alias("model"), F.lit(0.1).alias("nugget"), F.lit(0.8).alias("psill"), F.lit(15.0).alias("range"))
    rows = kriging.gather_neighbors(nb, ["pk"], ["u"]).withColumn("p", p)
    return rounded(kriging.krige(rows, [kriging.Task("pred", "p", "u")], ["pk", "q_id"]), 5)


@query("ordinary_kriging", "SELECT pk, id AS q_id, round(7.25e0 + pk, 5) + 0e0 AS pred FROM tiles", "tiles")
def _(t):
    """A constant field is reproduced: the weights sum to one."""
    flat = t.tiles.selectExpr("pk", "id", "x", "y", "7.25e0 + pk AS z")
    return rounded(_solved(t, "z", "const", train=flat, model="Gau", nugget=0.05).select("pk", "q_id", "pred"), 5)


@query("ordinary_kriging_one_neighbor", f"WITH {KNN} SELECT pk, q_id, round(u, 6) + 0e0 AS pred, round(2 * 1.5e0 * (1 - exp(-sqrt(d2) / 12)), 6) + 0e0 AS pred_var FROM knn WHERE rank = 1", "tiles")
def _(t):
    """With one neighbour ordinary kriging is that neighbour's value, its variance 2 * gamma(d)."""
    return rounded(_solved(t, "u", "const", k=1))


PARAMS = InterpolationParams(res_factor=2, cutoff=20.0, width=2.5, subsample_pct=75.0, nfold=5, nmax=12)


def _interpolated(t, **kw):
    return interp.interpolate(t.tiles.select("pk", "x", "y", "topo", "u", "v"), ["pk"], PARAMS, **kw)


@query("interpolate")
def _(t):
    points = t.region.selectExpr("r_name AS name", "3.3e0 + r_regionkey AS lon", "5.7e0 + r_regionkey AS lat")
    return _interpolated(t, points=points).grid


@query("interpolate_originals", f"""WITH {REFINED_SQL} SELECT r.pk, CAST(r.node AS VARCHAR) AS node_id, is_orig, CASE WHEN is_orig THEN 'original' ELSE 'interpolated' END AS interpolation_source,
 CASE WHEN is_orig THEN round(d.u, 6) + 0e0 END AS u_orig, CASE WHEN is_orig THEN round(d.v, 6) + 0e0 END AS v_rkt_orig, true AS filled,
 CAST(count(d.id) OVER (PARTITION BY r.pk) AS INT) AS input_count, CAST(count(*) FILTER (NOT is_orig) OVER (PARTITION BY r.pk) AS INT) AS interpolated_count
FROM refined r LEFT JOIN tiles d ON r.pk = d.pk AND r.x = d.x AND r.y = d.y""", "tiles")
def _(t):
    """Every grid node is present and filled, originals keep their data, counts are right."""
    g = _interpolated(t).grid
    return rounded(g.select(
        "pk", "node_id", "is_orig", "interpolation_source", F.when(F.col("is_orig"), F.col("u")).alias("u_orig"),
        F.when(F.col("is_orig"), F.col("v_rkt")).alias("v_rkt_orig"),
        (F.col("u").isNotNull() & F.col("v").isNotNull() & F.col("u_rkt").isNotNull() & (F.col("wind_speed") >= 0)).alias("filled"),
        "input_count", "interpolated_count",
    ))


@query("enrich_output", """SELECT '2024-01-01' AS date, lpad(CAST(pk % 24 AS VARCHAR), 2, '0') AS hour, id, concat('2024-01-01T', lpad(CAST(pk % 24 AS VARCHAR), 2, '0'), ':00:00Z') AS timestamp,
 round(sqrt(u * u + v * v), 6) + 0e0 AS wind_speed, round((degrees(atan2(-u, -v)) + 360) % 360, 6) + 0e0 AS wind_dir, CAST(count(*) OVER (PARTITION BY pk % 24) AS INT) AS input_count FROM tiles""", "tiles")
def _(t):
    rows = t.tiles.selectExpr("'2024-01-01' AS date", "lpad(CAST(pk % 24 AS STRING), 2, '0') AS hour", "id", "u", "v")
    counts = rows.groupBy("date", "hour").agg(F.count(F.lit(1)).cast("int").alias("input_count"))
    return rounded(interp.enrich_output(rows, counts, ["date", "hour"]).select("date", "hour", "id", "timestamp", "wind_speed", "wind_dir", "input_count"))


@query("cv_score", """SELECT station, round(sqrt(avg((obs_speed - pred_speed) ** 2)) / stddev_samp(obs_speed), 6) + 0e0 AS rsr, round(avg(obs_speed - pred_speed), 6) + 0e0 AS bias FROM pairs GROUP BY station""", "pairs")
def _(t):
    return rounded(metrics.cv_score(t.pairs, ["station"], "obs_speed", "pred_speed"))


@query("interpolation_status", "SELECT DISTINCT pk, 'ok' AS status FROM tiles", "tiles")
def _(t):
    return _interpolated(t).status.select("pk", "status")


@query("holdout_metrics")
def _(t):
    return _interpolated(t).diagnostics.select("pk", *(f"{k}_{m}_{v}" for k in ("cv", "test") for m in ("model", "rsr", "bias") for v in "uv"))


RING = [(10.0, 10.0), (50.0, 10.0), (50.0, 60.0), (10.0, 60.0)]


@query("count_columns", f"""WITH {REFINED_SQL}, i AS (SELECT pk, count(*) AS n FROM tiles WHERE greatest(10 - x, x - 50, 0) ** 2 + greatest(10 - y, y - 60, 0) ** 2 <= 36 GROUP BY pk),
c AS (SELECT pk, count(*) FILTER (NOT is_orig) AS n FROM refined WHERE x BETWEEN 10 AND 50 AND y BETWEEN 10 AND 60 GROUP BY pk)
SELECT pk, CAST(i.n AS INT) AS input_count, CAST(coalesce(c.n, 0) AS INT) AS interpolated_count FROM i LEFT JOIN c USING (pk)""", "tiles")
def _(t):
    inputs = regions.points_near_polygon(t.tiles, RING, 6.0)
    return lattice.output_counts(inputs, regions.points_in_polygon(_refined(t), RING, "x", "y"), ["pk"])


# --- metrics and comparison -------------------------------------------------------------------------

def _aligned(t):
    """Stations of the observation and prediction views, aligned, with components."""
    o, p = t.obs, t.pred
    from gustgrid.functions.wind import uv_from_speed_dir

    cols = {}
    for frame, s in ((o, "obs"), (p, "pred")):
        u, v = uv_from_speed_dir(F.col("wind_speed"), F.col("wind_dir"))
        cols[s] = frame.dropna(subset=["wind_speed"]).select(
            "station", "ts", F.col("wind_speed").alias(f"wind_speed_{s}"), F.col("wind_dir").alias(f"wind_dir_{s}"), u.alias(f"u_{s}"), v.alias(f"v_{s}"))
    return metrics.align_series(cols["pred"], cols["obs"], ["station"])


ALIGNED = """aligned AS (SELECT o.station, o.ts, o.wind_speed AS so, p.wind_speed AS sp, o.wind_dir AS do_, p.wind_dir AS dp,
 -o.wind_speed * sin(radians(o.wind_dir)) AS uo, -o.wind_speed * cos(radians(o.wind_dir)) AS vo, -p.wind_speed * sin(radians(p.wind_dir)) AS up, -p.wind_speed * cos(radians(p.wind_dir)) AS vp
 FROM obs o JOIN pred p USING (station, ts) WHERE o.wind_speed IS NOT NULL)"""
SPEED = """count(*) AS samples, sqrt(avg((sp - so) ** 2)) AS rmse_speed, avg(abs(sp - so)) AS mae_speed, avg(sp - so) AS bias_speed, corr(sp, so) AS corr_speed,
 1 - sum((sp - so) ** 2) / (var_pop(so) * count(*)) AS r2_speed, stddev_pop(sp - so) / avg(abs(so)) AS si_speed, stddev_pop(sp - so) / max(abs(so)) AS si_speed_max"""
DIRECTION = """degrees(avg(dd)) AS eam_dir, degrees(avg(abs(dd))) AS eaam_dir, degrees(sqrt(avg(dd * dd))) AS rmse_dir, sqrt(avg(cos(dd)) ** 2 + avg(sin(dd)) ** 2) AS compcorr_dir"""
DD = "atan2(sin(radians(dp) - radians(do_)), cos(radians(dp) - radians(do_))) AS dd"
SPEED_NAMES = ("rmse_speed", "mae_speed", "bias_speed", "corr_speed", "r2_speed", "si_speed", "si_speed_max")
DIR_NAMES = ("eam_dir", "eaam_dir", "rmse_dir", "compcorr_dir")


@query("align_series", f"WITH {ALIGNED} SELECT station, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(sp, 6) + 0e0 AS wind_speed_pred, round(uo, 6) + 0e0 AS u_obs FROM aligned", "obs", "pred")
def _(t):
    return rounded(_aligned(t).select("station", stamp("ts").alias("ts"), "wind_speed_pred", "u_obs"))


COMPONENT = """component AS (SELECT station, variable, sqrt(avg((p - o) ** 2)) AS rmse, sqrt(avg((p - o) ** 2)) / stddev_samp(o) AS rsr, avg(p - o) AS bias, count(*) AS samples FROM
 (SELECT station, 'Wind speed (m/s)' AS variable, sp AS p, so AS o FROM aligned UNION ALL SELECT station, 'U component (m/s)', up, uo FROM aligned
  UNION ALL SELECT station, 'V component (m/s)', vp, vo FROM aligned) GROUP BY station, variable)"""


@query("component_metrics", f"WITH {ALIGNED}, {COMPONENT} SELECT station, variable, {_r('rmse', 'rsr', 'bias')}, samples FROM component", "obs", "pred")
def _(t):
    return rounded(metrics.component_metrics(_aligned(t), ["station"]))


@query("speed_metrics", f"WITH {ALIGNED}, m AS (SELECT station, {SPEED}, {DIRECTION} FROM (SELECT *, {DD} FROM aligned) GROUP BY station) SELECT station, samples, {_r(*SPEED_NAMES, *DIR_NAMES)} FROM m", "obs", "pred")
def _(t):
    return rounded(metrics.speed_metrics(_aligned(t), ["station"]))


PAIRS = "aligned AS (SELECT station, obs_speed AS so, pred_speed AS sp, obs_dir AS do_, pred_dir AS dp FROM pairs)"


def _pairs(t):
    return t.pairs.selectExpr("station", "obs_speed AS wind_speed_obs", "pred_speed AS wind_speed_pred", "obs_dir AS wind_dir_obs", "pred_dir AS wind_dir_pred")


@query("pair_metrics", f"WITH {PAIRS}, m AS (SELECT station, {SPEED} FROM aligned GROUP BY station) SELECT station, samples, {_r(*SPEED_NAMES)} FROM m", "pairs")
def _(t):
    return rounded(metrics.speed_metrics(_pairs(t), ["station"]).drop(*DIR_NAMES))


# Opposite directions differ by exactly half a turn, whose sign is a matter of rounding: the signed
# mean is checked where no pair is opposite (speed_metrics), the other measures here.
@query("direction_metrics", f"WITH {PAIRS}, m AS (SELECT station, {DIRECTION} FROM (SELECT *, {DD} FROM aligned) GROUP BY station) SELECT station, {_r('eaam_dir', 'rmse_dir', 'compcorr_dir')} FROM m", "pairs")
def _(t):
    return rounded(metrics.direction_metrics(_pairs(t), ["station"]).drop("eam_dir"))


@query("union_metrics", f"WITH {ALIGNED}, {COMPONENT} SELECT station, variable, round(rmse, 6) + 0e0 AS rmse, NULL::DOUBLE AS eaam_dir FROM component UNION ALL "
       f"SELECT station, NULL, NULL, round(degrees(avg(abs(dd))), 6) + 0e0 FROM (SELECT *, {DD} FROM aligned) GROUP BY station", "obs", "pred")
def _(t):
    a = _aligned(t)
    parts = metrics.component_metrics(a, ["station"]).select("station", "variable", "rmse")
    return rounded(metrics.union_metrics(parts, metrics.direction_metrics(a, ["station"]).select("station", "eaam_dir")))


def _plan(t):
    """One plan entry per region, as JSON text would give it."""
    fields = {
        "idx": "r_regionkey + 1", "label": "CASE WHEN r_regionkey % 2 = 0 THEN concat(r_name, ' buoy') ELSE '' END", "id": "r_name", "catalog": "'catalog.json'",
        "item_id": "concat('item', r_regionkey)", "node_id": "CASE WHEN r_regionkey < 4 THEN concat('node', r_regionkey) END", "prediction_node_id": "'node4'",
        "obs_start": "CASE WHEN r_regionkey = 1 THEN '2024-01-05' END", "observation_start": "CASE WHEN r_regionkey = 2 THEN '2024-01-03T06:00:00Z' END",
        "pred_end": "CASE WHEN r_regionkey = 3 THEN '2024-01-20T18:00:00Z' END", "buoy_height_correction": "CASE WHEN r_regionkey >= 3 THEN 'Yes' END",
        "source_height": "CASE WHEN r_regionkey = 4 THEN '4' END",
    }
    exprs = [f"{fields.get(f, 'CAST(NULL AS STRING)')} AS {f}" for f in compare.PLAN_FIELDS]
    return compare.buoy_plan(t.region.selectExpr(f"{fields['idx']} AS idx", *exprs), {"prediction_path": "winds", "output_dir": "reports"})


PLAN = """plan AS (SELECT r_regionkey AS k, lower(regexp_replace(r_name, '[^A-Za-z0-9]+', '_', 'g')) AS buoy_id,
 CASE WHEN r_regionkey % 2 = 0 THEN concat(r_name, ' buoy') ELSE r_name END AS label, concat('item', CAST(r_regionkey AS VARCHAR)) AS item_id, concat('node', CAST(r_regionkey AS VARCHAR)) AS node_id,
 CASE r_regionkey WHEN 1 THEN TIMESTAMP '2024-01-05 00:00:00' WHEN 2 THEN TIMESTAMP '2024-01-03 06:00:00' END AS obs_start, CASE r_regionkey WHEN 3 THEN TIMESTAMP '2024-01-20 18:00:00' END AS pred_end,
 r_regionkey >= 3 AS corrected, CASE r_regionkey WHEN 4 THEN 4e0 ELSE 3e0 END AS source_height FROM region)"""


@query("buoy_plan", f"""WITH {PLAN} SELECT buoy_id, label, item_id, node_id, 'winds' AS prediction_path, concat('reports/', buoy_id) AS output_dir, concat(buoy_id, '_report.md') AS report_name,
 strftime(obs_start, '%Y-%m-%d %H:%M:%S') AS obs_start, strftime(pred_end, '%Y-%m-%d %H:%M:%S') AS pred_end, corrected, source_height, 10e0 AS target_height, 0.0002e0 AS roughness FROM plan""")
def _(t):
    p = _plan(t)
    return p.select("buoy_id", "label", "item_id", "node_id", "prediction_path", "output_dir", "report_name", stamp("obs_start").alias("obs_start"),
                    stamp("pred_end").alias("pred_end"), "corrected", "source_height", "target_height", "roughness")


def _raw_obs(t):
    return t.raw.selectExpr("concat('item', station) AS item_id", "date_trunc('hour', ts) AS ts", "wind_speed", "wind_dir")


def _raw_pred(t):
    from gustgrid.functions.wind import uv_from_speed_dir

    u, v = uv_from_speed_dir(F.col("wind_speed"), F.col("wind_dir"))
    return t.pred.select(
        F.expr("concat('node', station)").alias("node_id"), F.when(F.hour("ts") % 11 == 0, "interpolated").otherwise("test_point").alias("interpolation_source"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), "wind_speed", "wind_dir", u.alias("u"), v.alias("v"))


LOADED = PLAN + """, lo AS (SELECT buoy_id, date_trunc('hour', ts) AS ts, wind_speed * CASE WHEN corrected THEN ln(10 / 0.0002e0) / ln(source_height / 0.0002e0) ELSE 1 END AS so, wind_dir AS do_
 FROM raw JOIN plan ON station = k WHERE wind_speed > -9000 AND wind_dir > -9000 AND (obs_start IS NULL OR date_trunc('hour', ts) >= obs_start)),
lp AS (SELECT buoy_id, ts, wind_speed AS sp, wind_dir AS dp FROM pred JOIN plan ON station = k WHERE hour(ts) % 11 <> 0 AND (pred_end IS NULL OR ts <= pred_end)),
aligned AS (SELECT buoy_id, ts, so, do_, sp, dp, -so * sin(radians(do_)) AS uo, -so * cos(radians(do_)) AS vo, -sp * sin(radians(dp)) AS up, -sp * cos(radians(dp)) AS vp FROM lo JOIN lp USING (buoy_id, ts))"""


@query("load_observations", f"WITH {LOADED} SELECT buoy_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(so, 6) + 0e0 AS wind_speed_obs, round(-so * sin(radians(do_)), 6) + 0e0 AS u_obs FROM lo", "raw", "pred")
def _(t):
    return rounded(compare.load_observations(_raw_obs(t), _plan(t)).select("buoy_id", stamp("ts").alias("ts"), "wind_speed_obs", "u_obs"))


@query("load_predictions", f"WITH {LOADED} SELECT buoy_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, round(sp, 6) + 0e0 AS wind_speed_pred, round(dp, 6) + 0e0 AS wind_dir_pred FROM lp", "raw", "pred")
def _(t):
    return rounded(compare.load_predictions(_raw_pred(t), _plan(t)).select("buoy_id", stamp("ts").alias("ts"), "wind_speed_pred", "wind_dir_pred"))


BUOY = COMPONENT.replace("station", "buoy_id")
COMBINED = f"""WITH {LOADED}, {BUOY}, sm AS (SELECT buoy_id, 'wind_speed' AS variable, {SPEED}, {DIRECTION} FROM (SELECT *, {DD} FROM aligned) GROUP BY buoy_id),
combined AS (SELECT buoy_id, variable, samples, rmse_speed, mae_speed, bias_speed, corr_speed, r2_speed, si_speed, si_speed_max, eaam_dir, rmse_dir, compcorr_dir, NULL AS rmse, NULL AS rsr, NULL AS bias FROM sm
 UNION ALL SELECT buoy_id, variable, samples, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, rmse, rsr, bias FROM component)"""


def _combined(t):
    return compare.compare(_raw_obs(t), _raw_pred(t), _plan(t))


@query("compare", f"""{COMBINED} SELECT buoy_id, variable, samples, {_r(*SPEED_NAMES, 'eaam_dir', 'rmse_dir', 'compcorr_dir', 'rmse', 'rsr', 'bias')},
 label AS buoy_label, CASE WHEN corrected THEN 10e0 ELSE source_height END AS obs_height_m FROM combined JOIN plan USING (buoy_id)""", "raw", "pred")
def _(t):
    return rounded(_combined(t).select("buoy_id", "variable", "samples", *SPEED_NAMES, "eaam_dir", "rmse_dir", "compcorr_dir", "rmse", "rsr", "bias", "buoy_label", "obs_height_m"))


@query("multi_buoy_summary", f"""{COMBINED} SELECT buoy_id, label AS buoy_label, samples, {_r('rmse_speed', 'mae_speed', 'bias_speed')} FROM combined JOIN plan USING (buoy_id) WHERE variable = 'wind_speed'""", "raw", "pred")
def _(t):
    return rounded(_combined(t).filter("variable = 'wind_speed'").select("buoy_id", "buoy_label", "samples", "rmse_speed", "mae_speed", "bias_speed"))


@query("report_rows", f"""{COMBINED} SELECT buoy_id, variable, concat('| ', variable, ' | ', printf('%.3f', rmse), ' | ', printf('%.3f', rsr), ' | ', printf('%.3f', bias), ' | ', CAST(samples AS VARCHAR), ' |') AS line
FROM combined WHERE variable <> 'wind_speed'""", "raw", "pred")
def _(t):
    return compare.report_rows(_combined(t)).filter("variable <> 'wind_speed'")


@query("report_speed_rows", f"""{COMBINED} SELECT buoy_id, concat('| ', CAST(samples AS VARCHAR), ' | ', printf('%.3f', rmse_speed), ' | ', printf('%.3f', mae_speed)) AS head FROM combined WHERE variable = 'wind_speed'""", "raw", "pred")
def _(t):
    rows = compare.report_rows(_combined(t)).filter("variable = 'wind_speed'")
    return rows.select("buoy_id", F.regexp_extract("line", r"^(\| [^|]+ \| [^|]+ \| [^ |]+)", 1).alias("head"))


@query("report_windows", f"WITH {LOADED} SELECT buoy_id, strftime(min(ts), '%Y-%m-%d %H:%MZ') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%MZ') AS last_ts, count(*) AS matched FROM aligned GROUP BY buoy_id", "raw", "pred")
def _(t):
    p = _plan(t)
    return compare.report_windows(metrics.align_series(compare.load_predictions(_raw_pred(t), p), compare.load_observations(_raw_obs(t), p), ["buoy_id"]))


# --- catalogs ----------------------------------------------------------------------------------------

def _stamped(t):
    return t.files.withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))


ITEMS = """items AS (SELECT strftime(min(ts), '%Y%m%dT%H') AS item_id, path, min(lon) AS min_lon, min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat,
 date_trunc('second', min(ts)) AS start_ts, date_trunc('second', max(ts)) AS end_ts, count(*) AS row_count, min(source_model) AS source_model, 1 AS n_files FROM files GROUP BY path)"""


def _texts(items):
    return items.withColumn("start_datetime", stamp("start_datetime")).withColumn("end_datetime", stamp("end_datetime"))


@query("catalog_items", f"WITH {ITEMS} SELECT * EXCLUDE (start_ts, end_ts), strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS start_datetime, strftime(end_ts, '%Y-%m-%d %H:%M:%S') AS end_datetime FROM items", "files")
def _(t):
    return _texts(catalog.catalog_items(_stamped(t)))


PARTS = """items AS (SELECT strftime(min(ts), '%Y%m%dT%H') AS item_id, min(replace(path, 'data.', concat('part-', CAST(event_id % 3 AS VARCHAR), '.'))) AS path, min(lon) AS min_lon,
 min(lat) AS min_lat, max(lon) AS max_lon, max(lat) AS max_lat, date_trunc('second', min(ts)) AS start_ts, date_trunc('second', max(ts)) AS end_ts, count(*) AS row_count,
 min(source_model) AS source_model, count(DISTINCT event_id % 3) AS n_files FROM files GROUP BY path)"""


def _parts(t):
    return _stamped(t).withColumn("path", F.expr("replace(path, 'data.', concat('part-', CAST(event_id % 3 AS STRING), '.'))"))


@query("catalog_items_multi_file", f"WITH {PARTS} SELECT * EXCLUDE (start_ts, end_ts), strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS start_datetime, strftime(end_ts, '%Y-%m-%d %H:%M:%S') AS end_datetime FROM items", "files")
def _(t):
    return _texts(catalog.catalog_items(_parts(t)))


@query("item_id", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN concat('my-file', CAST(event_id AS VARCHAR)) ELSE strftime(ts, '%Y%m%dT%H') END AS item_id FROM files", "files")
def _(t):
    path = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("/data/My.File"), F.col("event_id").cast("string"), F.lit(".parquet"))).otherwise(F.col("path"))
    from gustgrid.functions.text import item_id

    return t.files.select("event_id", item_id(path).alias("item_id"))


@query("time_bounds", """SELECT path, strftime(CASE WHEN hour(min(ts)) % 2 = 0 THEN min(ts) ELSE date_trunc('hour', min(ts)) END, '%Y-%m-%d %H:%M:%S') AS start_datetime,
 strftime(CASE WHEN hour(min(ts)) % 2 = 0 THEN max(ts) ELSE date_trunc('hour', min(ts)) + INTERVAL 1 HOUR END, '%Y-%m-%d %H:%M:%S') AS end_datetime FROM files GROUP BY path""", "files")
def _(t):
    rows = t.files.select("path", F.when(F.hour("ts") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("unknown").alias("timestamp"))
    return _texts(catalog.time_bounds(rows))


@query("column_catalog", """SELECT * FROM (VALUES ('l_orderkey', 'integer', 'Order of the line.'), ('l_quantity', 'number', 'l_quantity column with values of type number.'),
 ('l_shipdate', 'datetime', 'l_shipdate column with values of type datetime.'), ('l_returnflag', 'string', 'l_returnflag column with values of type string.'),
 ('l_linenumber', 'integer', 'l_linenumber column with values of type integer.')) v(name, type, description)""")
def _(t):
    described = t.spark.createDataFrame([("l_orderkey", "Order of the line.")], "name string, description string")
    return catalog.column_catalog(t.lineitem.select("l_orderkey", "l_quantity", "l_shipdate", "l_returnflag", "l_linenumber"), described)


@query("column_profile", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS name, count(*) AS n_rows, count(*) - count({c}) AS n_null, {f'CAST(min({c}) AS DOUBLE)' if number else 'CAST(NULL AS DOUBLE)'} AS min_value, "
    f"{f'CAST(max({c}) AS DOUBLE)' if number else 'CAST(NULL AS DOUBLE)'} AS max_value FROM lineitem"
    for c, number in (("l_orderkey", True), ("l_quantity", True), ("l_shipdate", False), ("l_returnflag", False), ("l_linenumber", True))) + ")")
def _(t):
    return catalog.column_profile(t.lineitem.select("l_orderkey", "l_quantity", "l_shipdate", "l_returnflag", "l_linenumber"))


@query("incremental_items_multi_file", f"""WITH {PARTS} SELECT item_id, row_count, n_files, CASE WHEN substr(item_id, 7, 2) < '11' THEN 'old' ELSE 'new' END AS origin FROM items
UNION ALL SELECT '2019-other', 7, 1, 'old'""", "files")
def _(t):
    items = catalog.catalog_items(_parts(t)).select("item_id", "row_count", "n_files")
    old = items.filter(F.substring("item_id", 7, 2) < "11").union(t.spark.sql("SELECT '2019-other', 7L, 1L")).withColumn("origin", F.lit("old"))
    found = items.union(t.spark.sql("SELECT '2019-late', 9L, 1L")).withColumn("origin", F.lit("new"))
    return catalog.incremental_items(old, found, ["2024"])


@query("incremental_items", f"""WITH {ITEMS} SELECT item_id, row_count, CASE WHEN substr(item_id, 10, 2) < '12' THEN 'old' ELSE 'new' END AS origin FROM items""", "files")
def _(t):
    items = catalog.catalog_items(_stamped(t)).select("item_id", "row_count")
    old = items.filter(F.substring("item_id", 10, 2) < "12").withColumn("origin", F.lit("old"))
    return catalog.incremental_items(old, items.withColumn("origin", F.lit("new")), ["2024"])


@query("collection_extent", f"""WITH {ITEMS} SELECT min(min_lon) AS min_lon, min(min_lat) AS min_lat, max(max_lon) AS max_lon, max(max_lat) AS max_lat,
 strftime(least(min(start_ts), TIMESTAMP '2024-01-02'), '%Y-%m-%dT%H:%M:%SZ') AS extent_start, strftime(max(end_ts), '%Y-%m-%dT%H:%M:%SZ') AS extent_end,
 '2024-01-02T00:00:00Z' AS period_start, strftime(max(end_ts), '%Y-%m-%dT%H:%M:%SZ') AS period_end, string_agg(DISTINCT source_model, ',' ORDER BY source_model) AS source_models FROM items""", "files")
def _(t):
    return catalog.collection_extent(catalog.catalog_items(_stamped(t)), start="2024-01-02")


@query("link_sidecars", f"""WITH {ITEMS} SELECT item_id, CASE WHEN row_count % 2 = 0 THEN concat('/data/metadata/winds/', path[13:45], '/metadata.json') END AS describedby,
 CASE WHEN row_count % 2 = 0 THEN concat(item_id, '-metadata') END AS metadata_id FROM items""", "files")
def _(t):
    from gustgrid.functions.text import sidecar_path

    items = catalog.catalog_items(_stamped(t))
    present = items.filter("row_count % 2 = 0").select(sidecar_path(F.col("path")).alias("path"))
    return catalog.link_sidecars(items, present).select("item_id", "describedby", "metadata_id")


@query("link_plots", f"""WITH {ITEMS} SELECT item_id, p AS plot, CASE p WHEN 'grid_points.png' THEN 'grid-mesh' WHEN 'variogram_v_rkt_empirical_1.png' THEN 'variogram' END AS plot_type
FROM items LEFT JOIN (VALUES ('grid_points.png'), ('variogram_v_rkt_empirical_1.png')) v(p) ON row_count % 2 = 0""", "files")
def _(t):
    items = catalog.catalog_items(_stamped(t))
    names = F.explode(F.array(F.lit("grid_points.png"), F.lit("variogram_v_rkt_empirical_1.png")))
    plots = items.filter("row_count % 2 = 0").select("path", names.alias("n")).select(F.expr("replace(path, 'data.parquet', n)").alias("path"))
    return catalog.link_plots(items, plots).select("item_id", "plot", "plot_type")


@query("year_completeness", """WITH f AS (SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS present, count(*) FILTER (o_orderkey % 2 = 0 OR year(o_orderdate) % 2 = 0) AS cataloged FROM orders GROUP BY 1)
SELECT year, cataloged, present, cataloged = present AS complete FROM f""")
def _(t):
    path = F.date_format("o_orderdate", "'/d/year='yyyy'/month='MM'/day='dd'/hour=00/data.parquet'")
    files = t.orders.select("o_orderkey", "o_orderdate", path.alias("path"))
    items = files.filter((F.col("o_orderkey") % 2 == 0) | (F.year("o_orderdate") % 2 == 0)).select(F.date_format("o_orderdate", "yyyyMMdd'T00'").alias("item_id"))
    return catalog.year_completeness(items, files)


SUBSET = "sub AS (SELECT * FROM files WHERE user_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12) AND lon BETWEEN -9e0 AND -8.7e0 AND lat BETWEEN 42e0 AND 42.2e0)"
BOX = [(-9.0, 42.0), (-8.7, 42.0), (-8.7, 42.2), (-9.0, 42.2)]


def _subset(t):
    rows = t.files.withColumn("node_id", F.col("user_id").cast("string"))
    return rows, catalog.subset(rows, t.supplier.filter("s_nationkey < 12").select(F.col("s_suppkey").alias("node_id")), BOX)


@query("subset", f"WITH {SUBSET} SELECT event_id, user_id, lon, lat FROM sub", "files")
def _(t):
    return _subset(t)[1].select("event_id", "user_id", "lon", "lat")


@query("subset_summary", f"""WITH {SUBSET} SELECT (SELECT count(*) FROM files) AS dataset_rows, (SELECT strftime(min(ts), '%Y-%m-%dT%H:00:00Z') FROM files) AS dataset_start,
 (SELECT strftime(max(ts), '%Y-%m-%dT%H:00:00Z') FROM files) AS dataset_end, count(*) AS subset_rows, strftime(min(ts), '%Y-%m-%dT%H:00:00Z') AS subset_start, strftime(max(ts), '%Y-%m-%dT%H:00:00Z') AS subset_end FROM sub""", "files")
def _(t):
    return catalog.subset_summary(*_subset(t))


@query("verify_dataset", """SELECT pk, count(*) AS rows, 4 AS columns, count(*) FILTER (id % 3 = 0) AS promoted_nulls, 29 AS promoted_missing, 1 AS deprecated_present, pk % 2 = 0 AS has_sidecar FROM tiles GROUP BY pk""", "tiles")
def _(t):
    rows = t.tiles.selectExpr("pk", "id", "CASE WHEN id % 3 <> 0 THEN 'x' END AS cv_model_u", "'[]' AS regions")
    return catalog.verify_dataset(rows, ["pk"], t.tiles.filter("pk % 2 = 0").select("pk").distinct())
