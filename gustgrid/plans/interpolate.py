"""Interpolation of many hours in one job (K4-K6).

Every step is keyed by the partition key, so an hour is a group of rows and not a job. The grid is
clipped to the region before anything is predicted. One neighbour search over the grid serves the
topography, both wind components, the regression residuals and the neighbour statistics; one
search serves all cross-validated models, one the hold-out.

Tables that are read several times are written to the shared folder: the nodes with their split,
and small per-hour tables, which the planner can then broadcast by their measured size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gustgrid.functions.crs import ByRow, LonLat, Utm
from gustgrid.functions.geometry import in_box, in_ring, python_bounds
from gustgrid.functions.times import parse_timestamp
from gustgrid.functions.wind import dir_from_uv, speed_from_uv, uv_from_speed_dir
from gustgrid.operators.kriging import Task, krige
from gustgrid.operators.lattice import PROJECTION, append_points, assign_node_id, infer_lattice, output_counts, refine_grid, source_tag
from gustgrid.operators.metrics import cv_score
from gustgrid.operators.neighbors import idw_of, idw_within, knn_arrays, neighbor_counts
from gustgrid.operators.projection import project, unproject
from gustgrid.operators.region_join import points_in_regions
from gustgrid.operators.regions import points_near_polygon
from gustgrid.operators.sampling import hash_rank, sample_size
from gustgrid.operators.trend import add_residuals, ols_topo, ols_xy
from gustgrid.operators.variogram import MODELS, NO_MODEL, empirical_variogram, first_valid_model, fit_variogram, select_model
from gustgrid.params import InterpolationParams
from gustgrid.session import by_shuffle, stage

VARS = ("u", "v")


@dataclass(frozen=True)
class Interpolation:
    """Lazy results: the enriched grid, one row of diagnostics per key, and the status of every key."""

    grid: DataFrame
    diagnostics: DataFrame
    status: DataFrame
    variograms: DataFrame
    fits: DataFrame


def prepare_nodes(raw: DataFrame, ring: Sequence | None = None, buffer_m: float = 0.0, zone: int = 29) -> DataFrame:
    """Input rows with wind components, kept inside the region widened by ``buffer_m`` metres.

    The buffer is measured in UTM metres; a cheap degree box reaches the scan first.
    """
    if not {"u", "v"} <= set(raw.columns):
        if not {"wind_speed", "wind_dir"} <= set(raw.columns):
            raise ValueError("input needs u and v, or wind_speed and wind_dir")
        u, v = uv_from_speed_dir(F.col("wind_speed").cast("double"), F.col("wind_dir").cast("double"))
        raw = raw.withColumns({"u": u, "v": v})
    if ring is None:
        return raw
    utm = Utm(zone)


    flat = [utm.forward(float(a), float(b), math) for a, b in ring]
    x0, y0, x1, y1 = python_bounds(ring)
    # One degree of latitude is at least 110 km; longitudes shrink with the cosine.
    lat_room = buffer_m / 110000.0 + 0.01
    lon_room = lat_room / max(0.01, math.cos(math.radians(min(89.0, max(abs(y0), abs(y1)) + lat_room))))
    boxed = raw.filter(in_box(F.col("lon"), F.col("lat"), x0 - lon_room, y0 - lat_room, x1 + lon_room, y1 + lat_room))
    return points_near_polygon(project(boxed, utm, x="_ux", y="_uy"), flat, buffer_m, "_ux", "_uy").drop("_ux", "_uy")


def split_nodes(nodes: DataFrame, keys: Sequence[str], id_col: str, p: InterpolationParams) -> DataFrame:
    """Hold-out flag, subsample flag and fold from one exact rank in hash order.

    The first ranks are held out, the next ones are the subsample of the rest, dealt into folds.
    """
    r, n = F.col("_r"), F.col("_t")
    held = sample_size(n, p.test_pct)
    sub = sample_size(n - held, p.subsample_pct)
    return (
        hash_rank(nodes, keys, id_col, p.seed, "_r", "_t")
        .withColumns({
            "is_test": r <= held,
            "is_sub": (r > held) & (r <= held + sub),
            "fold": F.when((r > held) & (r <= held + sub), F.pmod(r - held - 1, F.lit(p.nfold))).cast("int"),
        })
        .drop("_r", "_t")
    )


def _model_struct(*more: str) -> Column:
    return F.struct("model", "nugget", "psill", "range", *more)


def _per_key(models: DataFrame, keys: Sequence[str], columns: dict[str, Column], item: Column) -> DataFrame:
    """One row per key with a struct column per condition."""
    return models.groupBy(*keys).agg(*(F.max(F.when(cond, item)).alias(name) for name, cond in columns.items()))




def cross_validate(sub: DataFrame, fits: DataFrame, keys: Sequence[str], nmax: int) -> DataFrame:
    """RSR and bias of every fitted model: keys, var, model, rsr, bias.

    Each row is predicted from the nearest rows of the other folds; all models of both components
    share the neighbours.
    """
    keys = list(keys)
    obs = [f"obs_{v}" for v in VARS]
    rows = knn_arrays(
        sub.withColumns({f"obs_{v}": F.col(v) for v in VARS}), sub, nmax, keys, "node_key", "node_key", "x_local", "y_local",
        fold="fold", train_cols=VARS, query_cols=obs,
    )
    wanted = {f"p_{v}_{m}": (F.col("var") == v) & (F.col("model") == m) for v in VARS for m in MODELS}
    # A row per key, written so that the planner knows how small it is; the neighbours are not shuffled again.
    params = stage(_per_key(fits, keys, wanted, _model_struct()), "models")
    rows = rows.join(params, keys)
    tasks = [Task(f"{v}_{m}", f"p_{v}_{m}", v) for v in VARS for m in MODELS]
    solved = krige(rows, tasks, [*keys, *obs])
    long = F.array(*(
        F.struct(F.lit(v).alias("var"), F.lit(m).alias("model"), F.col(f"obs_{v}").alias("obs"), F.col(f"{v}_{m}").alias("pred"))
        for v in VARS for m in MODELS
    ))
    return cv_score(solved.select(*keys, F.inline(long)), [*keys, "var", "model"])


def holdout_metrics(nodes: DataFrame, chosen: DataFrame, keys: Sequence[str], nmax: int) -> DataFrame:
    """RSR and bias of the chosen models on the held-out rows: keys, var, rsr, bias."""
    keys = list(keys)
    obs = [f"obs_{v}" for v in VARS]
    test = nodes.filter("is_test").withColumns({f"obs_{v}": F.col(v) for v in VARS})
    rows = knn_arrays(
        test, nodes.filter("NOT is_test"), nmax, keys, "node_key", "node_key", "x_local", "y_local",
        train_cols=VARS, query_cols=obs, spread="query",
    )
    idw = [f"idw_{v}" for v in VARS]
    rows = rows.select("*", *(idw_of("nb", v).alias(f"idw_{v}") for v in VARS))
    rows = rows.join(stage(_per_key(chosen, keys, {f"p_{v}": F.col("var") == v for v in VARS}, _model_struct()), "models"), keys)
    rows = rows.withColumns({f"is_idw_{v}": F.col(f"p_{v}.model") == NO_MODEL for v in VARS})
    flags = [f"is_idw_{v}" for v in VARS]
    solved = krige(rows, [Task(v, f"p_{v}", v) for v in VARS], [*keys, *obs, *idw, *flags])
    long = F.array(*(
        F.struct(
            F.lit(v).alias("var"), F.col(f"obs_{v}").alias("obs"),
            F.when(F.col(f"is_idw_{v}"), F.col(f"idw_{v}")).otherwise(F.col(v)).alias("pred"),
        )
        for v in VARS
    ))
    return cv_score(solved.select(*keys, F.inline(long)), [*keys, "var"])


def predict_grid(
    grid: DataFrame, nodes: DataFrame, chosen: DataFrame, rk_models: DataFrame, topo_trend: DataFrame,
    keys: Sequence[str], p: InterpolationParams, carry: Sequence[str],
) -> DataFrame:
    """Values at every grid node: components, variances, regression kriging and neighbour statistics."""
    keys, carry = list(keys), list(carry)
    rows = knn_arrays(
        grid, nodes, p.nmax, keys, "node_id", "node_key", "x_local", "y_local",
        train_cols=[*VARS, "topo"], query_cols=carry,
    )
    rows = rows.select("*", idw_of("nb", "topo").alias("topo"), *neighbor_counts("nb", p.cutoff))

    main = _per_key(chosen, keys, {f"p_{v}": F.col("var") == v for v in VARS}, _model_struct())
    trends = F.array(*(F.struct(F.lit(v).alias("var"), F.col(f"{v}_t0").alias("t0"), F.col(f"{v}_t1").alias("t1")) for v in VARS))
    rk = by_shuffle(topo_trend.select(*keys, F.inline(trends))).join(rk_models, [*keys, "var"], "left")
    rk = _per_key(rk, keys, {f"r_{v}": F.col("var") == v for v in VARS}, _model_struct("t0", "t1"))
    params = stage(main.join(rk, keys, "left"), "models")
    rows = rows.join(params, keys)

    # A data row on the node itself is its nearest neighbour; originals take its values.
    first = F.get("nb", F.lit(0))
    here = F.when(first["d2"] <= F.pow(F.col("spacing") * 1e-6, F.lit(2.0)), first)
    rows = rows.withColumns({f"own_{v}": here[v] for v in VARS})
    rows = rows.withColumns({f"trend_{v}": F.col(f"r_{v}.t0") + F.col(f"r_{v}.t1") * F.col("topo") for v in VARS})
    rows = rows.withColumns({f"model_{v}": F.col(f"p_{v}.model") for v in VARS})
    keep = [
        *keys, "q_id", *carry, "topo", "nearest_distance", "neighbors_used",
        *(f"{k}_{v}" for v in VARS for k in ("own", "trend", "model")),
    ]
    tasks = [Task(f"k_{v}", f"p_{v}", v) for v in VARS]
    tasks += [Task(f"e_{v}", f"r_{v}", v, "const", trend=True) for v in VARS]
    out = krige(rows, tasks, keep, p.cutoff)

    # Only hours without a usable model need all rows within the cutoff; for the others these tables are empty.
    fallback = chosen.filter(F.col("model") == NO_MODEL).select(*keys).distinct()
    near = idw_within(
        grid.filter("NOT is_orig").join(fallback, keys, "left_semi"), nodes.join(fallback, keys, "left_semi"),
        p.cutoff, keys, VARS, "node_id", "x_local", "y_local",
    ).withColumnsRenamed({v: f"w_{v}" for v in VARS})
    out = by_shuffle(out).join(near, [*keys, "q_id"], "left")

    def value(v):
        made = F.when(F.col(f"model_{v}") == NO_MODEL, F.col(f"w_{v}")).otherwise(F.col(f"k_{v}"))
        return F.when(F.col("is_orig"), F.col(f"own_{v}")).otherwise(made)

    def rkt(v):
        return F.when(F.col("is_orig"), F.col(f"own_{v}")).otherwise(F.col(f"trend_{v}") + F.col(f"e_{v}"))

    return out.select(
        *keys, F.col("q_id").alias("node_id"), *carry,
        *(value(v).alias(v) for v in VARS), *(rkt(v).alias(f"{v}_rkt") for v in VARS),
        *(F.when(~F.col("is_orig"), F.col(f"k_{v}_var")).alias(f"kriging_var_{v}") for v in VARS),
        F.col("nearest_distance").alias("nearest_distance_km"), "neighbors_used",
        source_tag(F.col("is_orig"), F.col("is_test_point")).alias("interpolation_source"),
    )


def interpolate(
    nodes: DataFrame, keys: Sequence[str], params: InterpolationParams, projection=LonLat(),
    points: DataFrame | None = None, ring: Sequence | None = None, settings: DataFrame | None = None,
) -> Interpolation:
    """Interpolate all keys of ``nodes`` (keys, x, y, topo, u, v; x and y in projection units).

    ``points`` (name, lon, lat) are predicted too, for all keys or, with key columns, for their own; ``ring`` clips
    the output. ``settings`` (keys, projection, ring) gives each key its own projection constants and ring (NULL: no
    clip) instead. Keys that cannot be interpolated yield no rows and are explained in ``status``.
    """
    keys, p = list(keys), params
    if settings is not None:
        projection = ByRow(F.col(PROJECTION))
    data = nodes.select(*keys, *(F.col(c).cast("double").alias(c) for c in ("x", "y", "topo", *VARS)))
    data = data.dropna(subset=list(VARS))
    lattice = stage(infer_lattice(data, keys), "lattice")
    lattice = lattice.withColumn("_nodes", F.expr(f"(max_x_local * {p.res_factor} / base_res + 1) * (max_y_local * {p.res_factor} / base_res + 1)"))
    lattice = lattice.withColumn("_fits", F.col("_nodes") <= p.max_nodes).drop("_nodes")
    usable = lattice.filter("base_res > 0 AND _fits").drop("_fits")
    if settings is not None:
        usable = usable.join(settings.select(*keys, F.col("projection").alias(PROJECTION)), keys)
    data = (
        assign_node_id(data, usable, keys, p.res_factor)
        .join(usable.select(*keys, "min_x", "min_y"), keys)
        .withColumns({
            "x_local": F.col("x") - F.col("min_x"), "y_local": F.col("y") - F.col("min_y"),
            # Rows off the lattice still train; their key is a hash below zero.
            "node_key": F.coalesce(F.col("node"), -F.abs(F.xxhash64("x", "y") % F.lit(2**62)) - 1),
        })
        .drop("min_x", "min_y")
    )
    data = stage(split_nodes(data, keys, "node_key", p), "nodes")
    sub = data.filter("is_sub")

    # Trends: both on the subsample for the variograms, topography on all rows for prediction.
    topo_all = stage(ols_topo(data, keys, VARS), "trend")
    coefs = stage(ols_xy(sub, keys, VARS).join(ols_topo(sub, keys, VARS), keys), "coefs")
    residuals = add_residuals(sub.join(coefs, keys), VARS, "x_local", "y_local")
    names = [f"{v}_{r}" for v in VARS for r in ("res", "tres")]
    bins = stage(empirical_variogram(residuals, keys, names, p.cutoff, p.width, "x_local", "y_local"), "bins")
    fits = stage(fit_variogram(bins, keys, p.cutoff, p.width), "fits")

    def component(frame, suffix):
        return frame.filter(F.col("var").endswith(suffix)).withColumn("var", F.regexp_replace("var", f"{suffix}$", ""))

    main_fits, rk_models = component(fits, "_res"), first_valid_model(component(fits, "_tres"), keys)
    every = usable.select(*keys, F.explode(F.array(*map(F.lit, VARS))).alias("var"))
    scores = cross_validate(sub, main_fits, keys, p.nmax)
    chosen = stage(select_model(every, main_fits, scores, keys), "chosen")
    held = holdout_metrics(data, chosen, keys, p.nmax)

    grid = refine_grid(usable, keys, p.res_factor)
    if points is not None:
        grid = append_points(grid, points, usable, keys, projection)
    else:
        grid = grid.withColumns({"node_id": F.col("node").cast("string"), "is_test_point": F.lit(False)})
    if settings is not None:
        grid = unproject(grid.drop(PROJECTION).join(usable.select(*keys, PROJECTION), keys), projection).drop(PROJECTION)
        grid = _clipped(grid, settings, keys)
    else:
        grid = unproject(grid, projection)
    if ring is not None:
        grid = grid.filter(in_ring(F.col("lon"), F.col("lat"), ring))
    spacing = usable.select(*keys, (F.col("base_res") / float(p.res_factor)).alias("spacing"))
    grid = grid.join(spacing, keys)

    diagnostics = stage(_diagnostics(output_counts(data, grid, keys), chosen, held, keys), "diagnostics")
    carry = ["x", "y", "x_local", "y_local", "lon", "lat", "spacing", "is_orig", "is_test_point"]
    predicted = predict_grid(grid, data, chosen, rk_models, topo_all, keys, p, carry)
    return Interpolation(
        enrich_output(predicted, diagnostics, keys), diagnostics, _status(lattice, diagnostics, rk_models, keys), bins, fits
    )


def _clipped(grid: DataFrame, settings: DataFrame, keys: list[str]) -> DataFrame:
    """Grid nodes inside the ring of their key; keys without a ring keep all nodes."""
    rings = settings.filter("ring IS NOT NULL").select(*keys, "ring", F.lit("ring").alias("region"))
    inside = points_in_regions(grid, rings, keys, ["node_id"], "region", "lon", "lat").withColumn("_inside", F.lit(True)).drop("region")
    bounded = rings.select(*keys, F.lit(True).alias("_bounded"))
    return grid.join(bounded, keys, "left").join(inside, [*keys, "node_id"], "left").filter("_inside OR _bounded IS NULL").drop("_inside", "_bounded")


def _diagnostics(counts, chosen, held, keys) -> DataFrame:
    """Per key: counts, chosen models with scores and parameters, hold-out scores."""
    models = by_shuffle(chosen).join(held.withColumnsRenamed({"rsr": "test_rsr", "bias": "test_bias"}), [*keys, "var"], "left")
    wide = []
    for v in VARS:
        def pick(c):
            return F.max(F.when(F.col("var") == v, F.col(c)))

        wide += [
            pick("model").alias(f"vgm_model_{v}"), pick("range").alias(f"vgm_range_{v}"),
            pick("sill").alias(f"vgm_sill_{v}"), pick("nugget").alias(f"vgm_nugget_{v}"),
            pick("model").alias(f"cv_model_{v}"), pick("rsr").alias(f"cv_rsr_{v}"), pick("bias").alias(f"cv_bias_{v}"),
            pick("range_at_edge").alias(f"vgm_at_edge_{v}"),
            pick("model").alias(f"test_model_{v}"), pick("test_rsr").alias(f"test_rsr_{v}"), pick("test_bias").alias(f"test_bias_{v}"),
        ]
    return counts.join(models.groupBy(*keys).agg(*wide), keys, "left")


def _status(lattice, diagnostics, rk_models, keys) -> DataFrame:
    """One row per key: ``ok`` or why (part of) its output is missing."""
    fitted = rk_models.groupBy(*keys).agg(F.count(F.lit(1)).alias("rk"))
    return (
        lattice.select(*keys, "base_res", "_fits")
        .join(diagnostics.select(*keys, "interpolated_count", *(f"vgm_at_edge_{v}" for v in VARS)), keys, "left")
        .join(fitted, keys, "left")
        .select(
            *keys,
            F.when(F.coalesce(F.col("base_res") <= 0, F.lit(True)), "no lattice")
            .when(~F.col("_fits"), "lattice too large")
            .when(F.col("interpolated_count") == 0, "no target in region")
            .when(F.coalesce("rk", F.lit(0)) < len(VARS), "no regression variogram")
            .otherwise("ok").alias("status"),
            # A variogram that still rises, or is flat, over all ranges tried: its range is only a bound.
            F.coalesce(F.greatest(*(f"vgm_at_edge_{v}" for v in VARS)), F.lit(False)).alias("range_at_edge"),
        )
    )


def enrich_output(grid: DataFrame, diagnostics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Speed, direction, time columns and the key's diagnostics on every output row (K6)."""
    out = grid.withColumns({
        "wind_speed": speed_from_uv(F.col("u"), F.col("v")), "wind_dir": dir_from_uv(F.col("u"), F.col("v")),
    })
    if {"date", "hour"} <= set(keys):
        out = out.withColumn("timestamp", F.concat("date", F.lit("T"), F.lpad("hour", 2, "0"), F.lit(":00:00Z")))
    return out.join(diagnostics, list(keys)).drop("spacing", "is_test_point")


def hours_of(ts: Column) -> dict[str, Column]:
    """The usual partition key of a timestamp or its text."""
    parsed = ts if not isinstance(ts, str) else parse_timestamp(F.col(ts))
    return {"date": F.date_format(parsed, "yyyy-MM-dd"), "hour": F.date_format(parsed, "HH")}
