"""Many small pairs of blocks are summed together, with the sums of each alone; keys meet by shuffle."""

import numpy as np
import pyarrow as pa

from gustgrid.operators import variogram as V


def places(rng, sizes):
    def item():
        n = rng.integers(0, 3)
        return {"px": float(rng.integers(0, 9)), "py": float(rng.random() * 9), "n_z": int(n), "m_z": rng.random() if n else None, "s_z": rng.random() if n > 1 else 0.0 if n else None}

    kind = pa.list_(pa.struct([("px", pa.float64()), ("py", pa.float64()), ("n_z", pa.int64()), ("m_z", pa.float64()), ("s_z", pa.float64())]))
    return V._Places(pa.array([[item() for _ in range(n)] for n in sizes], kind), ["z"])


def test_small_pairs_are_summed_together():
    rng = np.random.default_rng(7)
    sizes = rng.integers(1, 30, 60)
    a, other = places(rng, sizes), places(rng, rng.integers(1, 30, 60))
    for b, same in ((a, np.ones(60, bool)), (other, np.zeros(60, bool))):
        runs = list(V._runs(np.diff(a.offsets) * np.diff(b.offsets)))
        assert len(runs) < 3 and runs[0].start == 0 and runs[-1].stop == 60
        for rows in runs:
            at, bins, totals = V._run_sums(a, b, same, rows, 16.0, 1.5)
            for i in range(rows.start, rows.stop):
                found, want = V._pair_sums(a.of(i), b.of(i), same[i], 16.0, 1.5)
                assert np.array_equal(bins[at == i], found)
                for got, exact in zip(totals, want):
                    assert np.allclose(got[at == i], exact, rtol=1e-12, atol=1e-12)


def test_large_pairs_stay_alone():
    assert [(r.start, r.stop) for r in V._runs(np.array([10, V.CHUNK, 5, 5, V.CHUNK + 1]))] == [(0, 1), (1, 2), (2, 4), (4, 5)]
    assert list(V._runs(np.zeros(0, int))) == []


def test_fits_meet_by_shuffle(spark):
    rows = [(k, v, i, 50, float(i), 1 - np.exp(-i / 3).item()) for k in range(3) for v in "uv" for i in range(1, 9)]
    bins = spark.createDataFrame(rows, "pk int, var string, bin int, np long, dist double, gamma double")
    fits = V.fit_variogram(bins, ["pk"], 8.0, 1.0)
    scores = fits.selectExpr("pk", "var", "model", "0.5D AS rsr", "0D AS bias")
    every = bins.select("pk", "var").distinct()
    for df in (fits, V.select_model(every, fits, scores, ["pk"])):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
