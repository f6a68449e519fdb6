import numpy as np
import pandas as pd
import pytest

from gustgrid.operators import neighbors as N


def brute(q, t, k, maxdist=None, fold=False):
    rows = []
    for r in q.itertuples():
        c = t[t.pk == r.pk]
        if fold:
            c = c[c.fold != r.fold]
        d2 = (r.x - c.x) ** 2 + (r.y - c.y) ** 2
        c = c.assign(d2=d2)
        if maxdist is not None:
            c = c[c.d2 <= maxdist**2]
        c = c.sort_values(["d2", "id"]).head(k)
        rows += [(r.pk, r.id, i, rank) for rank, i in enumerate(c.id, start=1)]
    return set(rows)


def points(rng, n, pks=2, spread=100.0):
    return pd.DataFrame({
        "pk": rng.integers(0, pks, n), "id": np.arange(n), "x": rng.random(n) * spread,
        "y": rng.random(n) * spread, "fold": rng.integers(0, 5, n), "z": rng.normal(size=n),
    })


def skewed(rng, n):
    """A third of the rows in one tiny spot, a tenth copies of one place, some far away."""
    df = points(rng, n)
    df.loc[: n // 3, ["x", "y"]] = 50 + rng.random((n // 3 + 1, 2)) * 0.05
    df.loc[n // 3 : n // 3 + n // 10, ["x", "y"]] = 7.0
    df.loc[n - 5 :, ["x", "y"]] += 5000
    return df


@pytest.mark.parametrize("spread", ["train", "query"])
@pytest.mark.parametrize("make", [points, skewed])
@pytest.mark.parametrize("k,maxdist,fold", [(5, None, None), (16, 8.0, None), (4, None, "fold"), (1000, None, None)])
def test_knn_matches_brute_force(spark, spread, make, k, maxdist, fold):
    rng = np.random.default_rng(1)
    t, q = make(rng, 400), make(rng, 150)
    q.loc[0, ["x", "y"]] = [-300.0, 900.0]
    out = N.knn_join(
        spark.createDataFrame(q), spark.createDataFrame(t), k, ["pk"], maxdist=maxdist, fold=fold, spread=spread
    ).toPandas()
    got = set(zip(out.pk, out.q_id, out.t_id, out["rank"]))
    assert len(got) == len(out)
    assert got == brute(q, t, k, maxdist, fold is not None)


def test_knn_on_lattice_with_ties(spark):
    g = pd.DataFrame([(0, 20 * j + i, 4.0 * i, 4.0 * j) for j in range(20) for i in range(20)], columns=["pk", "id", "x", "y"])
    df = spark.createDataFrame(g)
    out = N.knn_join(df, df, 9, ["pk"], unique_locations=True).toPandas()
    assert set(zip(out.pk, out.q_id, out.t_id, out["rank"])) == brute(g, g, 9)


def test_fixture_case_of_four_points(spark):
    t = spark.createDataFrame([(0, i, float(i), float(i)) for i in range(4)], "pk int, id int, x double, y double")
    q = spark.createDataFrame([(0, 0, 0.5, 0.5), (0, 1, 2.5, 2.5)], "pk int, id int, x double, y double")
    out = N.knn_join(q, t, 2, ["pk"]).toPandas()
    assert len(out) == 4 and np.allclose(out.d2, 0.5)


def test_range_join_and_idw(spark):
    rng = np.random.default_rng(3)
    t, q = skewed(rng, 300), points(rng, 80)
    q.loc[0, ["pk", "x", "y"]] = t.loc[150, ["pk", "x", "y"]].values
    q.loc[1, ["x", "y"]] = [-999.0, 0.0]
    got = N.idw_within(spark.createDataFrame(q), spark.createDataFrame(t), 9.0, ["pk"], ["z"]).toPandas().set_index("q_id").z
    for r in q.itertuples():
        c = t[t.pk == r.pk]
        d2 = (r.x - c.x) ** 2 + (r.y - c.y) ** 2
        c, d2 = c[d2 <= 81], d2[d2 <= 81]
        if not len(c):
            assert np.isnan(got[r.id])
        elif (d2 == 0).any():
            assert np.isclose(got[r.id], c.z[d2 == 0].mean())
        else:
            assert np.isclose(got[r.id], (c.z / d2).sum() / (1 / d2).sum())


def test_no_pairwise_join_in_plans(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame(points(rng, 50))
    for out in (N.knn_join(df, df, 3, ["pk"]), N.range_join(df, df, 5.0, ["pk"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
