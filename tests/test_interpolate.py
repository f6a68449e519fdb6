import math

import numpy as np
import pytest

from gustgrid.functions.crs import Utm
from gustgrid.params import InterpolationParams
from gustgrid.plans.interpolate import interpolate


@pytest.fixture(scope="module")
def hours(spark):
    """Two hours of a smooth 8x8 field, one hour with u = 0, one hour with a single node."""
    rows = []
    for hour in ("00", "01", "02"):
        for j in range(8):
            for i in range(8):
                xs, ys = i / 7, j / 7
                u = 0.0 if hour == "02" else 4.5 + 0.8 * math.sin(math.pi * xs) + 0.3 * math.cos(math.pi * ys) + 0.1 * int(hour)
                v = -1.2 + 0.5 * math.cos(math.pi * xs) + 0.4 * math.sin(math.pi * ys)
                rows.append(("2025-01-02", hour, 500000 + 150.0 * i, 4800000 + 150.0 * j, 8 + 4 * xs + 2 * ys, u, v))
    rows.append(("2025-01-02", "03", 500000.0, 4800000.0, 8.0, 1.0, 1.0))
    return spark.createDataFrame(rows, "date string, hour string, x double, y double, topo double, u double, v double")


def test_interpolation_of_several_hours(spark, hours):
    utm = Utm(29)
    lon0, lat0 = utm.inverse(500000.0, 4800000.0, math)
    lon1, lat1 = utm.inverse(500900.0, 4800900.0, math)
    ring = [(lon0, lat0), (lon1, lat0), (lon1, lat1), (lon0, lat1)]
    points = spark.createDataFrame([("buoy", (lon0 + lon1) / 2, (lat0 + lat1) / 2)], "name string, lon double, lat double")
    params = InterpolationParams(2, 500.0, 100.0, 75.0, 2, 5)
    result = interpolate(hours, ["date", "hour"], params, utm, points, ring)
    out = result.grid.toPandas()
    assert set(out.hour) == {"00", "01", "02"}
    status = {r.hour: r.status for r in result.status.collect()}
    assert status["00"] == "ok" and status["03"] == "no lattice"
    assert set(out.vgm_model_u) <= {"Exp", "Gau", "Sph", "IDW"}
    assert (out[out.hour == "02"].vgm_model_u == "IDW").all() and (out[out.hour == "02"].u.abs() < 1e-9).all()
    one = out[out.hour == "00"]
    assert one.node_id.is_unique and (one.node_id == "buoy").sum() == 1
    orig = one[one.interpolation_source == "original"]
    assert len(orig) and np.allclose(orig.u, orig.u_rkt) and orig.kriging_var_u.isna().all()
    made = one[one.interpolation_source == "interpolated"]
    xs, ys = made.x_local / 1050, made.y_local / 1050
    want = 4.5 + 0.8 * np.sin(np.pi * xs) + 0.3 * np.cos(np.pi * ys)
    assert made.u.notna().all() and np.abs(made.u - want).max() < 0.1
    assert np.abs(made.u_rkt - want).max() < 0.3
    assert (made.neighbors_used == 5).all() and (made.nearest_distance_km <= 150).all()
    assert (one.input_count == 64).all() and (one.interpolated_count == (~one.is_orig).sum()).all()
    assert one.cv_rsr_u.notna().all() and one.test_rsr_u.notna().all() and (one.timestamp == "2025-01-02T00:00:00Z").all()


def test_parameters_are_checked():
    for bad in ({"res_factor": 0}, {"res_factor": 1.5}, {"nmax": 0}, {"subsample_pct": 0}, {"subsample_pct": 101}, {"nfold": 1}, {"width": 0}):
        with pytest.raises(ValueError):
            InterpolationParams(**bad)
