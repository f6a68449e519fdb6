"""Least-squares trends per key and their residuals (A1-A3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gustgrid.session import by_shuffle

# A 2x2 moment matrix with a relative determinant below this is taken as singular.
SINGULAR = 1e-12


def ols_xy(df: DataFrame, keys: Sequence[str], values: Sequence[str], x="x", y="y") -> DataFrame:
    """``z ~ 1 + x + y`` per key: ``<v>_b0, <v>_b1, <v>_b2``, NULL where x and y are collinear.

    One aggregation of centred moments, combined map-side, so a large hour costs no large group.
    """
    moments = []
    for v in values:
        # Rows with a NULL in any of the three take no part in any moment.
        whole = F.col(v).isNotNull() & F.col(x).isNotNull() & F.col(y).isNotNull()
        mx, my, mz = (F.when(whole, F.col(c)) for c in (x, y, v))
        moments += [
            F.avg(mx).alias(f"{v}_mx"), F.avg(my).alias(f"{v}_my"), F.avg(mz).alias(f"{v}_mz"),
            F.var_pop(mx).alias(f"{v}_xx"), F.var_pop(my).alias(f"{v}_yy"), F.covar_pop(mx, my).alias(f"{v}_xy"),
            F.covar_pop(mx, mz).alias(f"{v}_xz"), F.covar_pop(my, mz).alias(f"{v}_yz"),
        ]
    out = df.groupBy(*keys).agg(*moments)
    for v in values:
        xx, yy, xy, xz, yz = (F.col(f"{v}_{m}") for m in ("xx", "yy", "xy", "xz", "yz"))
        det = F.when(xx * yy - xy * xy > SINGULAR * xx * yy, xx * yy - xy * xy)
        out = out.withColumns({f"{v}_b1": (xz * yy - yz * xy) / det, f"{v}_b2": (yz * xx - xz * xy) / det})
        out = out.withColumn(f"{v}_b0", F.col(f"{v}_mz") - F.col(f"{v}_b1") * F.col(f"{v}_mx") - F.col(f"{v}_b2") * F.col(f"{v}_my"))
    return out.select(*keys, *(f"{v}_b{i}" for v in values for i in range(3)))


def ols_topo(df: DataFrame, keys: Sequence[str], values: Sequence[str], topo="topo") -> DataFrame:
    """``z ~ 1 + topo`` per key: ``<v>_t0, <v>_t1, <v>_r2``; a constant topo gives slope 0.

    Only rows that have both values count, as in :func:`ols_xy`.
    """
    aggs = []
    for v in values:
        whole = F.col(v).isNotNull() & F.col(topo).isNotNull()
        t, z = F.when(whole, F.col(topo)), F.when(whole, F.col(v))
        slope = F.coalesce(F.covar_pop(t, z) / F.nullif(F.var_pop(t), F.lit(0.0)), F.lit(0.0))
        aggs += [
            slope.alias(f"{v}_t1"), (F.avg(z) - slope * F.avg(t)).alias(f"{v}_t0"),
            (F.pow(F.covar_pop(t, z), F.lit(2.0)) / F.nullif(F.var_pop(t) * F.var_pop(z), F.lit(0.0))).alias(f"{v}_r2"),
        ]
    return df.groupBy(*keys).agg(*aggs)


def detrend(df: DataFrame, keys: Sequence[str], values: Sequence[str], x="x", y="y", topo="topo") -> DataFrame:
    """Add ``<v>_res`` (residual of x, y) and ``<v>_tres`` (residual of topo)."""
    coefs = ols_xy(df, keys, values, x, y).join(ols_topo(df, keys, values, topo), list(keys))
    return add_residuals(by_shuffle(df).join(coefs, list(keys)), values, x, y, topo).select(
        *df.columns, *(f"{v}_{s}" for v in values for s in ("res", "tres"))
    )


def add_residuals(df: DataFrame, values: Sequence[str], x="x", y="y", topo="topo") -> DataFrame:
    """Residual columns of a frame that already carries the coefficients."""
    return df.withColumns({
        **{f"{v}_res": F.col(v) - (F.col(f"{v}_b0") + F.col(f"{v}_b1") * F.col(x) + F.col(f"{v}_b2") * F.col(y)) for v in values},
        **{f"{v}_tres": F.col(v) - (F.col(f"{v}_t0") + F.col(f"{v}_t1") * F.col(topo)) for v in values},
    })
