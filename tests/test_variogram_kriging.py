import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from gustgrid.operators import kriging as K, neighbors as N, trend, variogram as V


def brute_variogram(df, value, cutoff, width):
    x, y, z = df.x.to_numpy(), df.y.to_numpy(), df[value].to_numpy()
    i, j = np.triu_indices(len(df), 1)
    d = np.hypot(x[i] - x[j], y[i] - y[j])
    keep = (d > 0) & (d <= cutoff)
    b = np.ceil(d[keep] / width).astype(int)
    sq = (z[i] - z[j])[keep] ** 2
    out = {}
    for u in np.unique(b):
        m = b == u
        out[u] = (m.sum(), d[keep][m].mean(), sq[m].sum() / (2 * m.sum()))
    return out


def field(rng, n=250, copies=40):
    df = pd.DataFrame({"pk": 0, "id": np.arange(n), "x": rng.random(n) * 60 - 20, "y": rng.random(n) * 60})
    df.loc[n - copies :, ["x", "y"]] = df.loc[0, ["x", "y"]].values
    df["topo"] = rng.random(n) * 10
    df["u"] = np.sin(df.x / 15) + 0.1 * df.y + 0.2 * rng.normal(size=n)
    df["v"] = np.cos(df.y / 11) - 0.03 * df.topo + 0.1 * rng.normal(size=n)
    return df


def test_trends_match_numpy(spark):
    df = field(np.random.default_rng(0))
    sdf = spark.createDataFrame(df)
    a = np.column_stack([np.ones(len(df)), df.x, df.y])
    r = trend.ols_xy(sdf, ["pk"], ["u", "v"]).first()
    for v in ("u", "v"):
        assert np.allclose([r[f"{v}_b{i}"] for i in range(3)], np.linalg.lstsq(a, df[v], rcond=None)[0])
    t = trend.ols_topo(sdf, ["pk"], ["v"]).first()
    slope, icept = np.polyfit(df.topo, df.v, 1)
    assert np.allclose([t.v_t0, t.v_t1], [icept, slope])
    res = trend.detrend(sdf, ["pk"], ["u"]).agg(F.sum("u_res"), F.sum("u_tres")).first()
    assert np.allclose(res, [0, 0], atol=1e-9)


def test_variogram_with_copies_matches_all_pairs(spark):
    df = field(np.random.default_rng(1))
    got = V.empirical_variogram(spark.createDataFrame(df), ["pk"], ["u", "v"], 12.0, 2.0).toPandas()
    for v in ("u", "v"):
        want = brute_variogram(df, v, 12.0, 2.0)
        g = got[got["var"] == v].set_index("bin")
        assert set(g.index) == set(want)
        for b, (n, dist, gamma) in want.items():
            assert g.np[b] == n and np.isclose(g.dist[b], dist) and np.isclose(g.gamma[b], gamma)


def test_fit_recovers_models(spark):
    h = np.arange(1, 21) * 1.0
    shapes = {
        "Exp": 0.2 + 1.5 * (1 - np.exp(-h / 6)), "Gau": 0.1 + 2 * (1 - np.exp(-((h / 8) ** 2))),
        "Sph": 0.3 + np.where(h < 12, 1.5 * h / 12 - 0.5 * (h / 12) ** 3, 1.0),
    }
    rows = [(m, "u", int(i + 1), 100, float(d), float(g)) for m, gs in shapes.items() for i, (d, g) in enumerate(zip(h, gs))]
    rows += [("flat", "u", i, 10, float(i), 0.0) for i in range(1, 9)] + [("short", "u", i, 10, float(i), 1.0 * i) for i in (1, 2)]
    bins = spark.createDataFrame(rows, "pk string, var string, bin int, np long, dist double, gamma double")
    fits = V.fit_variogram(bins, ["pk"], 20.0, 1.0).toPandas()
    assert not {"flat", "short"} & set(fits.pk)
    best = fits.loc[fits.groupby("pk").sse.idxmin()].set_index("pk")
    for m, (c0, c1, a) in {"Exp": (0.2, 1.5, 6), "Gau": (0.1, 2, 8), "Sph": (0.3, 1, 12)}.items():
        assert best.model[m] == m
        assert np.allclose([best.nugget[m], best.psill[m], best.range[m]], [c0, c1, a], rtol=0.03)


def dense_kriging(q, nb, model, c0, c1, a, drift, value="z"):
    """One system, solved densely."""
    def cov(h):
        rho = {"Exp": np.exp(-h / a), "Gau": np.exp(-((h / a) ** 2)), "Sph": np.where(h < a, 1 - 1.5 * h / a + 0.5 * (h / a) ** 3, 0)}[model]
        return c1 * rho + np.where(h == 0, c0, 0)
    xy = nb[["x", "y"]].to_numpy()
    f = np.column_stack([np.ones(len(nb)), xy - [q.x, q.y]]) if drift == "xy" else np.ones((len(nb), 1))
    m = f.shape[1]
    h = np.hypot(*(xy[:, None, :] - xy[None]).transpose(2, 0, 1))
    big = np.block([[cov(h), f], [f.T, np.zeros((m, m))]])
    rhs = np.append(cov(np.hypot(xy[:, 0] - q.x, xy[:, 1] - q.y)), [1] + [0] * (m - 1))
    w = np.linalg.solve(big, rhs)
    return w[: len(nb)] @ nb[value].to_numpy(), c0 + c1 - w @ rhs


def krige_frame(spark, q, t, k, model, drift, params=(0.05, 1.2, 9.0), maxdist=None):
    nb = N.knn_join(spark.createDataFrame(q), spark.createDataFrame(t), k, ["pk"], train_cols=["z"])
    p = F.struct(F.lit(model).alias("model"), *(F.lit(v).alias(n) for n, v in zip(("nugget", "psill", "range"), params)))
    rows = K.gather_neighbors(nb, ["pk"], ["z"]).withColumn("p", p)
    return K.krige(rows, [K.Task("pred", "p", "z", drift)], ["pk", "q_id"], maxdist).toPandas().set_index("q_id")


def test_kriging_matches_dense_solve(spark):
    rng = np.random.default_rng(2)
    t = field(rng, 120, 0).rename(columns={"u": "z"})
    q = pd.DataFrame({"pk": 0, "id": np.arange(12), "x": rng.random(12) * 60 - 20, "y": rng.random(12) * 60})
    for model, drift in (("Exp", "xy"), ("Gau", "const"), ("Sph", "xy")):
        out = krige_frame(spark, q, t, 10, model, drift)
        for r in q.itertuples():
            nb = t.assign(d=(t.x - r.x) ** 2 + (t.y - r.y) ** 2).nsmallest(10, "d")
            pred, var = dense_kriging(r, nb, model, 0.05, 1.2, 9.0, drift)
            assert np.isclose(out.pred[r.id], pred, atol=1e-8) and np.isclose(out.pred_var[r.id], var, atol=1e-8)


def test_kriging_exact_at_data_and_null_cases(spark):
    t = pd.DataFrame({"pk": 0, "id": range(4), "x": [0.0, 4.0, 0.0, 4.0], "y": [0.0, 0.0, 4.0, 4.0], "z": [1.0, 2.0, 3.0, 9.0]})
    q = pd.DataFrame({"pk": 0, "id": range(2), "x": [4.0, 2.0], "y": [4.0, 2.0]})
    out = krige_frame(spark, q, t, 4, "Sph", "xy", (0.1, 1.0, 6.0))
    assert np.isclose(out.pred[0], 9.0) and np.isclose(out.pred_var[0], 0.0, atol=1e-9)
    line = t.assign(x=[0.0, 1.0, 2.0, 3.0], y=0.0)
    assert krige_frame(spark, q, line, 4, "Exp", "xy").pred.isna().all()
    assert krige_frame(spark, q, line, 4, "Exp", "const").pred.notna().all()
    assert krige_frame(spark, q.assign(x=90.0), t, 4, "Exp", "const", maxdist=5.0).pred.isna().all()


def test_select_model_falls_back(spark):
    fits = spark.createDataFrame(
        [(1, "u", m, 0.0, 1.0, 1.0, 5.0) for m in V.MODELS] + [(2, "u", "Gau", 0.0, 1.0, 1.0, 5.0)],
        "pk int, var string, model string, nugget double, psill double, sill double, range double")
    scores = spark.createDataFrame(
        [(1, "u", "Exp", 0.4, 0.0), (1, "u", "Gau", 0.3, 0.0), (1, "u", "Sph", 0.3, 0.0), (2, "u", "Gau", float("nan"), 0.0)],
        "pk int, var string, model string, rsr double, bias double")
    every = spark.createDataFrame([(1, "u"), (2, "u"), (3, "u")], "pk int, var string")
    got = {r.pk: r.model for r in V.select_model(every, fits, scores, ["pk"]).collect()}
    assert got == {1: "Gau", 2: "IDW", 3: "IDW"}
    first = {r.pk: r.model for r in V.first_valid_model(fits, ["pk"]).collect()}
    assert first == {1: "Exp", 2: "Gau"}
