"""Local kriging solves (K2, K3) over neighbour arrays bounded by ``nmax``.

Spark finds and gathers the neighbours; the only Python here is the batched solve of the small
local systems, a row-wise map over Arrow batches.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gustgrid.operators.neighbors import neighbor_group

# The solver travels with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Task:
    """One variable to predict.

    ``params`` names the struct column with (model, nugget, psill, range) of the row, ``value`` the
    neighbour field to interpolate. ``drift`` is ``xy`` (1, x, y) or ``const`` (1). With ``trend``
    the neighbour values are first reduced by ``t0 + t1 * topo`` taken from ``params``.
    """

    name: str
    params: str
    value: str
    drift: str = "xy"
    trend: bool = False


def gather_neighbors(
    neighbors: DataFrame, keys: Sequence[str], fields: Sequence[str], query_cols: Sequence[str] = (), extra: Sequence[Column] = ()
) -> DataFrame:
    """One row per query with its neighbours in rank order (at most k of them).

    ``query_cols`` are carried along, ``extra`` are further aggregates over the neighbours.
    """
    item = F.struct("rank", "t_x", "t_y", "d2", *fields)
    group = neighbor_group(neighbors, keys)
    out = neighbors.groupBy(*group).agg(
        F.sort_array(F.collect_list(item)).alias("nb"),
        *(F.first(c).alias(c) for c in ("q_x", "q_y", *query_cols)), *extra,
    )
    return out.drop(*(c for c in group if c not in (*keys, "q_id")))


def krige(rows: DataFrame, tasks: Sequence[Task], keep: Sequence[str], maxdist: float | None = None) -> DataFrame:
    """Solve every task for every row: adds ``<name>`` and ``<name>_var``.

    NULL where the row has no model, no neighbour within ``maxdist``, or a drift its neighbours
    cannot determine.
    """
    schema = T.StructType(
        [rows.schema[c] for c in keep]
        + [T.StructField(f"{t.name}{s}", T.DoubleType()) for t in tasks for s in ("", "_var")]
    )
    needed = list(dict.fromkeys([*keep, "q_x", "q_y", "nb", *(t.params for t in tasks)]))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = _Neighbors(batch, maxdist)
            columns = [batch.column(c) for c in keep]
            for t in tasks:
                for values in _solve_task(block, batch.column(t.params), t):
                    columns.append(pa.array(values, mask=~np.isfinite(values)))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.select(*needed).mapInArrow(solve, schema)


def _numbers(array: pa.Array) -> np.ndarray:
    """Floats of an Arrow array, NaN for NULL."""
    return array.cast(pa.float64()).to_numpy(zero_copy_only=False)


class _Neighbors:
    """Neighbour arrays of a batch, padded to the longest row."""

    def __init__(self, batch: pa.RecordBatch, maxdist: float | None):
        nested = batch.column("nb")
        counts = np.diff(nested.offsets.to_numpy())
        self.rows, self.width = batch.num_rows, int(counts.max(initial=0))
        self.mask = np.arange(self.width)[None, :] < counts[:, None]
        items = nested.flatten()
        self.columns = {}
        for name, values in zip((f.name for f in items.type), items.flatten()):
            padded = np.zeros((self.rows, self.width))
            padded[self.mask] = _numbers(values)
            self.columns[name] = padded
        if maxdist is not None:
            self.mask = self.mask & (self.columns["d2"] <= float(maxdist) ** 2)
        self.dx = self.columns["t_x"] - _numbers(batch.column("q_x"))[:, None]
        self.dy = self.columns["t_y"] - _numbers(batch.column("q_y"))[:, None]
        # Distances are the same for every variable and model of the batch.
        self.apart = np.hypot(self.dx[:, :, None] - self.dx[:, None, :], self.dy[:, :, None] - self.dy[:, None, :])


def _corr(model: str, h: np.ndarray, a: np.ndarray) -> np.ndarray:
    r = h / a
    if model == "Exp":
        return np.exp(-r)
    if model == "Gau":
        return np.exp(-r * r)
    return np.where(r < 1, 1 - 1.5 * r + 0.5 * r**3, 0.0)


def _solve_task(block: _Neighbors, params: pa.StructArray, task: Task) -> tuple[np.ndarray, np.ndarray]:
    pred, var = np.full(block.rows, np.nan), np.full(block.rows, np.nan)
    if not block.width:
        return pred, var
    parts = dict(zip((f.name for f in params.type), params.flatten()))
    models = parts["model"].to_numpy(zero_copy_only=False)
    z = block.columns[task.value]
    if task.trend:
        z = z - (_numbers(parts["t0"])[:, None] + _numbers(parts["t1"])[:, None] * block.columns["topo"])
    used = block.mask & ~np.isnan(z)
    z = np.where(used, z, 0.0)
    nugget, psill, rng = (_numbers(parts[n]) for n in ("nugget", "psill", "range"))
    for model in ("Exp", "Gau", "Sph"):
        pick = np.flatnonzero(models == model)
        if len(pick):
            pred[pick], var[pick] = solve_local(
                block.dx[pick], block.dy[pick], block.apart[pick], z[pick], used[pick], model,
                nugget[pick], psill[pick], rng[pick], task.drift,
            )
    return pred, var


def solve_local(dx, dy, apart, z, used, model, nugget, psill, rng, drift):
    """Kriging systems of a batch. Unused neighbours become identity rows with zero weight.

    Coordinates are relative to the target and scaled by the neighbourhood's radius, which keeps
    the linear drift well conditioned.
    """
    rows, k = dx.shape
    scale = np.maximum(np.sqrt(np.max(np.where(used, dx**2 + dy**2, 0.0), axis=1)), 1e-300)
    sx, sy = dx / scale[:, None], dy / scale[:, None]
    one = used.astype(float)
    f = np.stack([one, sx * one, sy * one], axis=2) if drift == "xy" else one[:, :, None]
    m = f.shape[2]
    # A drift the neighbours cannot determine (too few, or on one line) has no prediction.
    gram = np.einsum("rki,rkj->rij", f, f)
    ok = used.sum(axis=1) >= m
    ok &= np.linalg.eigvalsh(gram)[:, 0] > 1e-9 * np.maximum(np.trace(gram, axis1=1, axis2=2), 1e-300)

    cov = psill[:, None, None] * _corr(model, apart, rng[:, None, None])
    cov += np.where(apart == 0, nugget[:, None, None], 0.0)
    both = used[:, :, None] & used[:, None, :]
    cov = np.where(both, cov, 0.0) + np.where(used, 0.0, 1.0)[:, :, None] * np.eye(k)
    h0 = np.sqrt(dx**2 + dy**2)
    c0 = psill[:, None] * _corr(model, h0, rng[:, None]) + np.where(h0 == 0, nugget[:, None], 0.0)
    c0 = np.where(used, c0, 0.0)

    system = np.zeros((rows, k + m, k + m))
    system[:, :k, :k], system[:, :k, k:], system[:, k:, :k] = cov, f, f.transpose(0, 2, 1)
    right = np.zeros((rows, k + m))
    right[:, :k], right[:, k] = c0, 1.0
    system[~ok] = np.eye(k + m)
    weights = _solve(system, right)
    weights[~ok] = np.nan
    pred = np.einsum("rk,rk->r", weights[:, :k], z)
    var = nugget + psill - np.einsum("rk,rk->r", weights, right)
    return pred, np.where(np.isfinite(var), np.maximum(var, 0.0), np.nan)


def _solve(system: np.ndarray, right: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(system, right[:, :, None])[:, :, 0]
    except np.linalg.LinAlgError:
        out = np.full(right.shape, np.nan)
        for i in range(len(system)):
            try:
                out[i] = np.linalg.solve(system[i], right[i])
            except np.linalg.LinAlgError:
                pass
        return out
