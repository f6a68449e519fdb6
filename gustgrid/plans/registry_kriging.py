"""Kriging queries whose oracle solves every local system by elimination in SQL.

The systems are lists of rows; each step of Gauss-Jordan elimination is one nested list expression.
The covariance block is positive definite and the drift block's Schur complement negative definite,
so the diagonal can be the pivot.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gustgrid.operators import kriging, neighbors
from gustgrid.params import InterpolationParams
from gustgrid.plans import interpolate as interp
from gustgrid.plans.registry_columns import query
from gustgrid.plans.registry_fields import FITS as FITTED_SQL, PARAMS, REFINED_SQL, rounded

# Model, nugget, partial sill and range of each solved variable; not fitted, so that one thing is tested at a time.
FITS = [("u", "Exp", 0.05, 1.2, 14.0), ("u", "Gau", 0.2, 0.9, 9.0), ("u", "Sph", 0.1, 1.0, 25.0),
        ("v", "Exp", 0.0, 0.8, 11.0), ("v", "Gau", 0.3, 1.1, 8.0), ("v", "Sph", 0.05, 0.7, 18.0)]
FITS_SQL = "fits(var, model, nugget, psill, range) AS (VALUES " + ", ".join(f"('{v}', '{m}', {n}e0, {p}e0, {r}e0)" for v, m, n, p, r in FITS) + ")"


def _fits(t):
    rows = F.array(*(F.struct(*(F.lit(x).alias(n) for n, x in zip(("var", "model", "nugget", "psill", "range"), fit))) for fit in FITS))
    return t.tiles.select("pk").distinct().select("pk", F.inline(rows))


def _corr(h: str) -> str:
    r = f"({h} / range)"
    return f"CASE model WHEN 'Exp' THEN exp(-{r}) WHEN 'Gau' THEN exp(-{r} * {r}) ELSE CASE WHEN {r} < 1 THEN 1 - 1.5e0 * {r} + 0.5e0 * {r} * {r} * {r} ELSE 0 END END"


def kriged(source: str, k: int, drift: int) -> str:
    """CTEs from ``source`` (kept columns, model, nugget, psill, range, lists dx, dy, z of k neighbours) to
    ``solved`` with ``pred`` and ``pred_var``; ``drift`` is 1 (constant) or 3 (constant, x, y)."""
    n = k + drift
    apart = "sqrt((dx[i] - dx[j]) ** 2 + (dy[i] - dy[j]) ** 2)"
    cov = f"psill * ({_corr(apart)}) + CASE WHEN {apart} = 0 THEN nugget ELSE 0 END"
    to = "sqrt(dx[i] ** 2 + dy[i] ** 2)"
    right = f"CASE WHEN i <= {k} THEN psill * ({_corr(to)}) + CASE WHEN {to} = 0 THEN nugget ELSE 0 END WHEN i = {k + 1} THEN 1e0 ELSE 0e0 END"
    base = f"CASE {{b}} - {k} WHEN 1 THEN 1e0 WHEN 2 THEN dx[{{a}}] ELSE dy[{{a}}] END"
    entry = (f"CASE WHEN j = {n + 1} THEN {right} WHEN i <= {k} AND j <= {k} THEN {cov} WHEN i <= {k} THEN {base.format(a='i', b='j')} "
             f"WHEN j <= {k} THEN {base.format(a='j', b='i')} ELSE 0e0 END")
    steps = [f"s0 AS MATERIALIZED (SELECT *, list_transform(range(1, {n + 1}), lambda i: list_transform(range(1, {n + 2}), lambda j: {entry})) AS m, "
             f"list_transform(range(1, {n + 1}), lambda i: {right}) AS rhs FROM {source})"]
    for p in range(1, n + 1):
        steps.append(
            f"s{p} AS MATERIALIZED (SELECT * REPLACE (list_transform(m, lambda r, i: CASE WHEN i = {p} THEN list_transform(r, lambda x: x / m[{p}][{p}]) "
            f"ELSE list_transform(r, lambda x, j: x - r[{p}] / m[{p}][{p}] * m[{p}][j]) END) AS m) FROM s{p - 1})")
    weights = f"list_transform(m, lambda r: r[{n + 1}])"
    steps.append(f"solved AS (SELECT * EXCLUDE (m, rhs), list_dot_product({weights}[1:{k}], z) AS pred, nugget + psill - list_dot_product({weights}, rhs) AS pred_var FROM s{n})")
    return ", ".join(steps)


def nearest(queries: str, train: str, k: int, where: str = "true", more: str = "") -> str:
    """CTE ``nb``: pk, q_id, ``more`` and the lists dx, dy, u, v, topo, d2 of the k nearest training rows."""
    return f"""pairs AS (SELECT q.pk, q.id AS q_id{more}, t.x - q.x AS dx, t.y - q.y AS dy, t.u AS tu, t.v AS tv, t.topo AS tt, (q.x - t.x) * (q.x - t.x) + (q.y - t.y) * (q.y - t.y) AS d2,
 row_number() OVER (PARTITION BY q.pk, q.id ORDER BY (q.x - t.x) * (q.x - t.x) + (q.y - t.y) * (q.y - t.y), t.id) AS rank FROM {queries} q JOIN {train} t ON q.pk = t.pk AND {where}),
nb AS (SELECT * EXCLUDE (dx, dy, tu, tv, tt, d2, rank), list(dx ORDER BY rank) AS dx, list(dy ORDER BY rank) AS dy, list(tu ORDER BY rank) AS u, list(tv ORDER BY rank) AS v,
 list(tt ORDER BY rank) AS topo, list(d2 ORDER BY rank) AS d2 FROM pairs WHERE rank <= {k} GROUP BY ALL)"""


TARGETS = "targets AS (SELECT pk, id, x + 1.3e0 AS x, y + 0.9e0 AS y FROM tiles)"


def _solved(t, k, drift, model):
    nb = neighbors.knn_join(t.tiles.selectExpr("pk", "id", "x + 1.3e0 AS x", "y + 0.9e0 AS y"), t.tiles, k, ["pk"], train_cols=["u", "v", "topo"])
    rows = kriging.gather_neighbors(nb, ["pk"], ["u", "v", "topo"])
    tasks = []
    for var, name, nugget, psill, rng in FITS:
        if name == model:
            rows = rows.withColumn(f"p_{var}", F.struct(F.lit(name).alias("model"), F.lit(nugget).alias("nugget"), F.lit(psill).alias("psill"), F.lit(rng).alias("range")))
            tasks.append(kriging.Task(var, f"p_{var}", var, drift))
    return rounded(kriging.krige(rows, tasks, ["pk", "q_id"]), 5)


def _kriging_sql(k, drift, model):
    source = f"src AS (SELECT nb.* EXCLUDE (u, v), var, model, nugget, psill, range, CASE var WHEN 'u' THEN u ELSE v END AS z FROM nb, fits WHERE model = '{model}')"
    wide = ", ".join(f"round(max({c}) FILTER (var = '{v}'), 5) + 0e0 AS {v}{s}" for v in "uv" for c, s in (("pred", ""), ("pred_var", "_var")))
    return f"WITH {TARGETS}, {FITS_SQL}, {nearest('targets', 'tiles', k)}, {source}, {kriged('src', k, drift)} SELECT pk, q_id, {wide} FROM solved GROUP BY pk, q_id"


@query("universal_kriging_solved", _kriging_sql(8, 3, "Exp"), "tiles")
def _(t):
    """Predictions and variances with a linear drift."""
    return _solved(t, 8, "xy", "Exp")


@query("universal_kriging_gauss", _kriging_sql(6, 3, "Gau"), "tiles")
def _(t):
    return _solved(t, 6, "xy", "Gau")


@query("ordinary_kriging_solved", _kriging_sql(7, 1, "Sph"), "tiles")
def _(t):
    """Predictions and variances with a constant drift."""
    return _solved(t, 7, "const", "Sph")


# Scores: RSR is the error's root mean square over the sample deviation, bias observed minus predicted.
SCORE = "round(sqrt(avg((obs - pred) ** 2)) / nullif(stddev_samp(obs), 0), 5) + 0e0 AS rsr, round(avg(obs - pred), 5) + 0e0 AS bias"


def _score_sql(queries, k, where, fits):
    source = f"src AS (SELECT nb.* EXCLUDE (u, v), f.*, CASE var WHEN 'u' THEN ou ELSE ov END AS obs, CASE var WHEN 'u' THEN u ELSE v END AS z FROM nb, {fits} f)"
    return f"{nearest(queries, 'tiles', k, where, ', q.u AS ou, q.v AS ov')}, {source}, {kriged('src', k, 3)}"


@query("cross_validate", f"WITH {FITS_SQL}, {_score_sql('tiles', 7, 'q.id % 4 <> t.id % 4', 'fits')} SELECT pk, var, model, {SCORE} FROM solved GROUP BY pk, var, model", "tiles")
def _(t):
    """Scores of every model, each row predicted from the other folds."""
    sub = t.tiles.selectExpr("pk", "id AS node_key", "x AS x_local", "y AS y_local", "u", "v", "CAST(id % 4 AS INT) AS fold")
    return rounded(interp.cross_validate(sub, _fits(t), ["pk"], 7).select("pk", "var", "model", "rsr", "bias"), 5)


CHOSEN = "chosen AS (SELECT * FROM fits WHERE (var = 'u' AND model = 'Sph') OR (var = 'v' AND model = 'Exp'))"


def _chosen(t):
    return _fits(t).filter("(var = 'u' AND model = 'Sph') OR (var = 'v' AND model = 'Exp')")


@query("holdout_scores", f"WITH {FITS_SQL}, {CHOSEN}, {_score_sql('tiles', 8, 'q.id % 10 = 3 AND t.id % 10 <> 3', 'chosen')} SELECT pk, var, {SCORE} FROM solved GROUP BY pk, var", "tiles")
def _(t):
    """Scores of the chosen models on held-out rows."""
    nodes = t.tiles.selectExpr("pk", "id AS node_key", "x AS x_local", "y AS y_local", "u", "v", "id % 10 = 3 AS is_test")
    return rounded(interp.holdout_metrics(nodes, _chosen(t), ["pk"], 8).select("pk", "var", "rsr", "bias"), 5)


TREND = {"u": (1.5, 0.02), "v": (-0.7, -0.01)}


@query("regression_kriging_solved", f"""WITH {TARGETS}, {FITS_SQL}, {CHOSEN}, {nearest('targets', 'tiles', 8)},
r AS (SELECT nb.* EXCLUDE (u, v), c.*, CASE var WHEN 'u' THEN u ELSE v END AS z0, CASE var WHEN 'u' THEN 1.5e0 ELSE -0.7e0 END AS t0, CASE var WHEN 'u' THEN 0.02e0 ELSE -0.01e0 END AS t1,
 list_sum(list_transform(topo, lambda x, i: x / d2[i])) / list_sum(list_transform(d2, lambda x: 1 / x)) AS here FROM nb, chosen c),
src AS (SELECT * EXCLUDE (z0), list_transform(z0, lambda x, i: x - (t0 + t1 * topo[i])) AS z FROM r), {kriged('src', 8, 1)}
SELECT pk, q_id, {", ".join(f"round(max(t0 + t1 * here + pred) FILTER (var = '{v}'), 5) + 0e0 AS {v}_rkt" for v in "uv")}, round(max(sqrt(d2[1])), 5) + 0e0 AS nearest_distance_km FROM solved GROUP BY pk, q_id""", "tiles")
def _(t):
    """The prediction step of the whole job: topographic trend plus kriged residuals, with more than one neighbour."""
    grid = t.tiles.selectExpr("pk", "id AS node_id", "x + 1.3e0 AS x_local", "y + 0.9e0 AS y_local", "4e0 AS spacing", "false AS is_orig", "false AS is_test_point")
    nodes = t.tiles.selectExpr("pk", "id AS node_key", "x AS x_local", "y AS y_local", "u", "v", "topo")
    trend = t.tiles.select("pk").distinct().selectExpr("pk", *(f"{a!r}D AS {v}_t0" for v, (a, _) in TREND.items()), *(f"{b!r}D AS {v}_t1" for v, (_, b) in TREND.items()))
    p = InterpolationParams(res_factor=2, cutoff=1000.0, width=2.5, subsample_pct=75.0, nfold=5, nmax=8)
    chosen = _chosen(t)
    out = interp.predict_grid(grid, nodes, chosen, chosen, trend, ["pk"], p, ["spacing", "is_orig", "is_test_point"])
    return rounded(out.selectExpr("pk", "node_id AS q_id", "u_rkt", "v_rkt", "nearest_distance_km"), 5)


def _whole_job_sql(p: InterpolationParams) -> str:
    """Targets of the refined lattice by the whole job: split, trends, variograms, fits, cross-validated choice, both predictions."""
    data = f"""{REFINED_SQL}, data AS (SELECT t.pk, r.node AS id, t.x, t.y, t.topo, t.u, t.v FROM tiles t JOIN refined r ON r.pk = t.pk AND r.x = t.x AND r.y = t.y),
ranked AS (SELECT *, row_number() OVER (PARTITION BY pk ORDER BY md5(concat('{p.seed}:', CAST(id AS VARCHAR))), id) AS rk, ceil(n * {p.test_pct} / 100e0) AS held
 FROM (SELECT *, count(*) OVER (PARTITION BY pk) AS n FROM data)),
sub AS MATERIALIZED (SELECT pk, id, x, y, topo, u, v, CAST((rk - held - 1) % {p.nfold} AS INT) AS fold FROM ranked WHERE rk > held AND rk <= held + ceil((n - held) * {p.subsample_pct} / 100e0))"""
    # Each kriging step has its own neighbours and systems, so it is a query within the query.
    scores = f"""scores AS MATERIALIZED (WITH {nearest('sub', 'sub', p.nmax, 'q.fold <> t.fold', ', q.u AS ou')},
 src AS (SELECT nb.* EXCLUDE (u, v), f.* EXCLUDE (pk), nb.u AS z FROM nb JOIN fits f USING (pk) WHERE f.var = 'u_res'), {kriged('src', p.nmax, 3)}
 SELECT pk, model, sqrt(avg((ou - pred) ** 2)) / nullif(stddev_samp(ou), 0) AS rsr FROM solved GROUP BY pk, model)"""
    models = """best AS (SELECT * FROM (SELECT f.*, row_number() OVER (PARTITION BY pk ORDER BY rsr, model) AS place FROM fits f JOIN scores USING (pk, model) WHERE f.var = 'u_res' AND rsr IS NOT NULL) WHERE place = 1),
first AS (SELECT pk, var[1] AS var, arg_min(model, model) AS model, arg_min(nugget, model) AS nugget, arg_min(psill, model) AS psill, arg_min(range, model) AS range FROM fits WHERE var IN ('u_tres', 'v_tres') GROUP BY pk, var),
trends AS (SELECT pk, unnest(['u', 'v']) AS var, unnest([regr_intercept(u, topo), regr_intercept(v, topo)]) AS t0, unnest([regr_slope(u, topo), regr_slope(v, topo)]) AS t1 FROM data GROUP BY pk),
targets AS (SELECT pk, node AS id, x, y FROM refined WHERE NOT is_orig)"""
    near = f"""near AS MATERIALIZED (WITH {nearest('targets', 'data', p.nmax)} SELECT * FROM nb),
inverse AS (SELECT pk, id AS q_id, sum(u / w) / sum(1 / w) AS u FROM (SELECT q.pk, q.id, t.u, (q.x - t.x) ** 2 + (q.y - t.y) ** 2 AS w FROM targets q JOIN data t ON q.pk = t.pk WHERE q.pk NOT IN (SELECT pk FROM best)) WHERE w <= {p.cutoff ** 2} GROUP BY ALL)"""
    main = f"""main AS MATERIALIZED (WITH src AS (SELECT near.* EXCLUDE (u, v), model, nugget, psill, range, near.u AS z FROM near JOIN best USING (pk)), {kriged('src', p.nmax, 3)} SELECT pk, q_id, model, pred FROM solved)"""
    residual = f"""residual AS MATERIALIZED (WITH r AS (SELECT near.* EXCLUDE (u, v), f.* EXCLUDE (pk), t0, t1, CASE f.var WHEN 'u' THEN near.u ELSE near.v END AS z0,
  list_sum(list_transform(topo, lambda x, i: x / d2[i])) / list_sum(list_transform(d2, lambda x: 1 / x)) AS here FROM near JOIN first f USING (pk) JOIN trends t ON t.pk = near.pk AND t.var = f.var),
 src AS (SELECT * EXCLUDE (z0), list_transform(z0, lambda x, i: x - (t0 + t1 * topo[i])) AS z FROM r), {kriged('src', p.nmax, 1)} SELECT pk, q_id, var, t0 + t1 * here + pred AS rkt FROM solved)"""
    return f"""WITH {data}, {FITTED_SQL.replace('tiles', 'sub')}, {scores}, {models}, {near}, {main}, {residual},
wide AS (SELECT pk, q_id, max(rkt) FILTER (var = 'u') AS u_rkt, max(rkt) FILTER (var = 'v') AS v_rkt FROM residual GROUP BY pk, q_id)
SELECT n.pk, CAST(n.q_id AS VARCHAR) AS node_id, round(CASE WHEN m.model IS NULL THEN i.u ELSE m.pred END, 5) + 0e0 AS u, round(u_rkt, 5) + 0e0 AS u_rkt, round(v_rkt, 5) + 0e0 AS v_rkt,
 round(sqrt(d2[1]), 5) + 0e0 AS nearest_distance_km, CAST(len(list_filter(d2, lambda x: x <= {p.cutoff ** 2})) AS INT) AS neighbors_used, coalesce(m.model, 'IDW') AS vgm_model_u
FROM near n LEFT JOIN main m USING (pk, q_id) LEFT JOIN inverse i USING (pk, q_id) LEFT JOIN wide w USING (pk, q_id)"""


@query("regression_kriging", _whole_job_sql(PARAMS), "tiles")
def _(t):
    """The whole job: fitted and cross-validated models, universal and regression kriging from all neighbours."""
    g = interp.interpolate(t.tiles.select("pk", "x", "y", "topo", "u", "v"), ["pk"], PARAMS).grid.filter("NOT is_orig")
    return rounded(g.select("pk", "node_id", "u", "u_rkt", "v_rkt", "nearest_distance_km", "neighbors_used", "vgm_model_u"), 5)
