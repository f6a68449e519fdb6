"""Regression kriging as the whole job: as many neighbours as the other queries of the job, models that are fitted and chosen."""

import duckdb
import pytest

import __spark_entry__ as entry
from gustgrid.plans import interpolate as interp
from gustgrid.plans.registry_fields import PARAMS

ROWS = "SELECT CAST(i AS BIGINT) AS p_partkey, 1 + (i * 37) % 50 AS p_size FROM range(1, 400) r(i)"


class Given(Exception):
    pass


def test_query_gives_the_job_its_parameters(spark, tmp_path, monkeypatch):
    def interpolate(nodes, keys, params, *args, **kw):
        raise Given(params)

    monkeypatch.setattr(interp, "interpolate", interpolate)
    duckdb.sql(f"COPY ({ROWS}) TO '{tmp_path}/part.parquet'")
    with pytest.raises(Given) as given:
        entry.queries()["regression_kriging"](spark, str(tmp_path))
    assert given.value.args == (PARAMS,) and PARAMS.nmax > 4


def test_sql_solves_the_whole_job():
    con = duckdb.connect()
    con.execute(f"CREATE TABLE part AS {ROWS}")
    cur = con.execute(entry.oracle_sql()["regression_kriging"])
    names = [d[0] for d in cur.description]
    rows = [dict(zip(names, row)) for row in cur.fetchall()]
    assert len(rows) == 39 * 39 - 400 and len({r["node_id"] for r in rows}) == len(rows)
    assert {r["neighbors_used"] for r in rows} == {PARAMS.nmax} and all(r["vgm_model_u"] in ("Exp", "Gau", "Sph") for r in rows)
    # With one neighbour the residual is that neighbour's and the sum its own value, one of 399.
    assert len({r["u_rkt"] for r in rows}) > 1000 and all(None not in r.values() for r in rows)
