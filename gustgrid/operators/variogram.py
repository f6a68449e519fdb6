"""Empirical variograms, model fits and model choice.

The weights of a fit are ``pairs / distance**2``. For a fixed range the model is linear in nugget
and partial sill, so a fit is a search over ranges whose normal equations are grouped sums: a log
grid first, then a finer one around its best range. The nugget is kept non-negative. A fit whose
range ends on the edge of the searched interval is kept and flagged.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gustgrid.operators.blocks import packed_pairs
from gustgrid.session import by_shuffle, stage

# The sums of a block pair travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Candidate models in order of preference, and the name used without any.
MODELS = ("Exp", "Gau", "Sph")
NO_MODEL = "IDW"
# Ranges tried: a log grid from half a lag to ten times the cutoff, then a refinement. Where the best range is the last
# one, the grid goes on by ``MORE`` ranges at a time while the error falls by more than ``FALLS`` of the weighted squares;
# at a million cutoffs every model is a straight line.
COARSE, FINE, RANGE_TOP, MORE, FALLS, RANGE_END = 60, 20, 10.0, 30, 1e-9, 1e6
MIN_BINS = 3
# Pairs of places taken at a time: their numbers stay in a core's cache.
CHUNK = 1 << 16
ZERO_VARIANCE = 1e-18


def empirical_variogram(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], cutoff: float, width: float, x="x", y="y"
) -> DataFrame:
    """Pairs with ``0 < d <= cutoff`` binned by ``ceil(d / width)``: keys, var, bin, np, dist, gamma.

    Rows at one location are reduced to count, mean and spread first, so copies never form pairs;
    all variables share one pass over the pairs. Cells have side ``cutoff`` and every pair of cells
    is met once (own cell and half of its neighbours); crowded cells are cut into blocks. Spark brings
    blocks together as arrays, the sums of a pair of blocks are numpy's, so no pair of places is ever a
    row. The places are written to the shared folder, because they are counted and joined.
    """
    keys, c = list(keys), float(cutoff)
    stats = []
    for v in values:
        stats += [F.count(v).alias(f"n_{v}"), F.avg(v).alias(f"m_{v}"), (F.var_pop(v) * F.count(v)).alias(f"s_{v}")]
    places = df.groupBy(*keys, F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py")).agg(*stats)
    places = stage(places.selectExpr("*", f"floor(px / {c!r}D) AS _cx", f"floor(py / {c!r}D) AS _cy"), "places")
    met = packed_pairs(places, keys, ["_cx", "_cy"])
    sums = [f"{s}_{v}" for v in values for s in ("np", "d", "g")]
    schema = T.StructType(
        [met.schema[k] for k in keys] + [T.StructField("bin", T.IntegerType())]
        + [T.StructField(n, T.LongType() if n.startswith("np_") else T.DoubleType()) for n in sums]
    )
    names, c2, lag = list(values), c * c, float(width)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _Places(batch.column("a"), names), _Places(batch.column("b"), names)
            same = batch.column("same").to_numpy(zero_copy_only=False)
            at, bins, out = [np.zeros(0, int)], [np.zeros(0, int)], [[np.zeros(0)] for _ in sums]
            for rows in _runs(np.diff(a.offsets) * np.diff(b.offsets)):
                if rows.stop - rows.start == 1:
                    found, totals = _pair_sums(a.of(rows.start), b.of(rows.start), same[rows.start], c2, lag)
                    at.append(np.full(len(found), rows.start))
                else:
                    where, found, totals = _run_sums(a, b, same, rows, c2, lag)
                    at.append(where)
                bins.append(found)
                for column, total in zip(out, totals):
                    column.append(total)
            take = pa.array(np.concatenate(at))
            columns = [batch.column(k).take(take) for k in keys] + [pa.array(np.concatenate(bins), pa.int32())]
            for name, column in zip(sums, out):
                whole = np.concatenate(column)
                columns.append(pa.array(np.rint(whole).astype(np.int64)) if name.startswith("np_") else pa.array(whole))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    pairs = met.mapInArrow(solve, schema)
    rows = ", ".join(
        f"named_struct('var', '{v}', 'np', np_{v}, 'dist', d_{v} / nullif(np_{v}, 0), 'gamma', g_{v} / nullif(2 * np_{v}, 0))" for v in values
    )
    return (
        pairs.groupBy(*keys, "bin").agg(*(F.sum(n).alias(n) for n in sums))
        .selectExpr(*keys, "bin", f"inline(array({rows}))")
        .filter("np > 0")
        .selectExpr(*keys, "var", "bin", "np", "dist", "gamma")
    )


class _Places:
    """Arrays of places of a batch: position, and count, mean and spread of every variable."""

    def __init__(self, column: pa.ListArray, names: Sequence[str]):
        items = column.flatten()
        fields = dict(zip((f.name for f in items.type), items.flatten()))
        self.offsets = column.offsets.to_numpy() - column.offsets[0].as_py()
        self.place = [_floats(fields[n]) for n in ("px", "py")]
        self.values = []
        for name in names:
            n, m, s = (_floats(fields[f"{k}_{name}"]) for k in ("n", "m", "s"))
            # Without a value there is no mean; its weight is zero.
            self.values.append((n, np.where(n == 0, 0.0, m), np.where(n == 0, 0.0, s)))

    def of(self, i: int):
        part = slice(self.offsets[i], self.offsets[i + 1])
        return [p[part] for p in self.place], [tuple(x[part] for x in v) for v in self.values]


def _floats(array: pa.Array) -> np.ndarray:
    return array.cast(pa.float64()).to_numpy(zero_copy_only=False)


def _runs(pairs: np.ndarray) -> Iterator[slice]:
    """Consecutive rows of up to about ``CHUNK`` pairs together; a row of more is alone."""
    start = held = 0
    for i, n in enumerate(pairs.tolist()):
        if held + n > CHUNK and i > start:
            yield slice(start, i)
            start, held = i, 0
        held += n
    if start < len(pairs):
        yield slice(start, len(pairs))


def _run_sums(a: _Places, b: _Places, same: np.ndarray, rows: slice, c2: float, width: float) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """:func:`_pair_sums` of many small pairs of blocks at once; also the row of every bin."""
    size = math.ceil(math.sqrt(c2) / width) + 2
    na, nb = np.diff(a.offsets)[rows], np.diff(b.offsets)[rows]
    pairs = na * nb
    row = np.repeat(np.arange(len(pairs)), pairs)
    place = np.arange(len(row)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    i = place // nb[row]
    j = place - i * nb[row]
    meets = ~same[rows][row] | (j > i)
    i, j = i + a.offsets[:-1][rows][row], j + b.offsets[:-1][rows][row]
    dx, dy = a.place[0][i] - b.place[0][j], a.place[1][i] - b.place[1][j]
    d2 = dx * dx + dy * dy
    near = np.flatnonzero((d2 > 0) & (d2 <= c2) & meets)
    i, j, d = i[near], j[near], np.sqrt(d2[near])
    at = row[near] * size + np.ceil(d / width).astype(np.int64)
    found = np.flatnonzero(np.bincount(at, minlength=1))

    def total(weights):
        return np.bincount(at, weights, minlength=1)[found] if len(found) else np.zeros(0)

    totals = []
    for (n_a, m_a, s_a), (n_b, m_b, s_b) in zip(a.values, b.values):
        ni, nj, diff = n_a[i], n_b[j], m_a[i] - m_b[j]
        weight = ni * nj
        totals += [total(weight), total(weight * d), total(weight * diff * diff + nj * s_a[i] + ni * s_b[j])]
    return found // size + rows.start, found % size, totals


def _pair_sums(a, b, same: bool, c2: float, width: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bins of the pairs of two blocks, and for every variable the sums over each bin: pairs, distance, square."""
    (ax, ay), va = a
    (bx, by), vb = b
    size = math.ceil(math.sqrt(c2) / width) + 2
    totals = [np.zeros(size) for _ in range(3 * len(va))]
    seen = np.zeros(size)
    single = [bool((na == 1).all() and (nb == 1).all() and not sa.any() and not sb.any()) for (na, _, sa), (nb, _, sb) in zip(va, vb)]
    step = max(1, CHUNK // max(1, len(bx)))
    for start in range(0, len(ax), step):
        rows = slice(start, min(start + step, len(ax)))
        # Within one block each pair is taken once, and a place does not meet itself.
        first = start + 1 if same else 0
        dx, dy = ax[rows, None] - bx[first:], ay[rows, None] - by[first:]
        d2 = dx * dx + dy * dy
        near = (d2 > 0) & (d2 <= c2)
        if same:
            near &= np.arange(first, len(bx)) > np.arange(rows.start, rows.stop)[:, None]
        i, j = np.nonzero(near)
        if not len(i):
            continue
        d = np.sqrt(d2[i, j])
        bins = np.ceil(d / width).astype(np.int64)
        i, j = i + start, j + first
        number = np.bincount(bins, minlength=size)
        length = np.bincount(bins, d, size)
        seen += number
        for v, (na, ma, sa) in enumerate(va):
            nb, mb, sb = vb[v]
            diff = ma[i] - mb[j]
            if single[v]:
                add = number, length, np.bincount(bins, diff * diff, size)
            else:
                ni, nj = na[i], nb[j]
                add = (np.bincount(bins, ni * nj, size), np.bincount(bins, ni * nj * d, size),
                       np.bincount(bins, ni * nj * diff * diff + nj * sa[i] + ni * sb[j], size))
            for k in range(3):
                totals[3 * v + k] += add[k]
    found = np.flatnonzero(seen)
    return found, [t[found] for t in totals]


def correlation(model: str, h: str, a: str) -> str:
    """SQL of the correlation function of each model."""
    return (
        f"CASE {model} WHEN 'Exp' THEN exp(-{h} / {a}) WHEN 'Gau' THEN exp(-({h} / {a}) * ({h} / {a})) "
        f"ELSE CASE WHEN {h} < {a} THEN 1 - 1.5D * ({h} / {a}) + 0.5D * ({h} / {a}) * ({h} / {a}) * ({h} / {a}) ELSE 0D END END"
    )


def model_gamma(model="model", nugget="nugget", psill="psill", range_="range", h="dist") -> Column:
    """Semivariance of a fitted model at distance ``h``; 0 at distance 0."""
    return F.expr(f"CASE WHEN {h} = 0 THEN 0D ELSE {nugget} + {psill} * (1 - ({correlation(model, h, range_)})) END")


def _profile(candidates: DataFrame, by: list[str]) -> DataFrame:
    """Best nugget and partial sill of every candidate range, with the weighted squared error."""
    w, g = "np / (dist * dist)", f"(1 - ({correlation('model', 'dist', 'a')}))"
    sums = candidates.selectExpr(*by, "gamma AS gy", f"{w} AS w", f"{g} AS g").groupBy(*by).agg(
        F.expr("count(1)").alias("bins"), F.expr("max(gy)").alias("top"),
        F.expr("sum(w)").alias("W"), F.expr("sum(w * g)").alias("WG"), F.expr("sum(w * g * g)").alias("WGG"),
        F.expr("sum(w * gy)").alias("WY"), F.expr("sum(w * g * gy)").alias("WGY"), F.expr("sum(w * gy * gy)").alias("WYY"),
    )
    return (
        sums.filter(f"bins >= {MIN_BINS} AND top > {ZERO_VARIANCE!r}D AND WGG > 0 AND W * WGG - WG * WG > 1e-12D * W * WGG")
        .selectExpr("*", "(W * WGY - WG * WY) / (W * WGG - WG * WG) AS c1f")
        .selectExpr("*", "(WY - c1f * WG) / W AS c0f")
        .selectExpr(*by, "W", "WG", "WGG", "WY", "WGY", "WYY",
                    "CASE WHEN c0f < 0 THEN 0D ELSE c0f END AS c0", "CASE WHEN c0f < 0 THEN WGY / WGG ELSE c1f END AS c1")
        .filter("c1 > 0")
        .selectExpr(*by, "c0", "c1", "WYY AS total",
                    "WYY - 2 * (c0 * WY + c1 * WGY) + c0 * c0 * W + 2 * c0 * c1 * WG + c1 * c1 * WGG AS sse")
    )


def last_range(cutoff: float, width: float) -> int:
    """Number of the last range of the search, for which a fit counts as a straight line."""
    low, high = float(width) / 2, RANGE_TOP * float(cutoff)
    step = (high / low) ** (1.0 / (COARSE - 1))
    return COARSE - 1 + math.ceil(math.log(RANGE_END / RANGE_TOP) / math.log(step))


def fit_variogram(bins: DataFrame, keys: Sequence[str], cutoff: float, width: float) -> DataFrame:
    """Fit every model to every variogram: keys, var, model, nugget, psill, sill, range, sse, range_at_edge.

    The search for the range goes on, for all variograms at once, where the best range is the last one tried; each
    stops by itself. A model that cannot be fitted (fewer than three bins, no variance, no positive sill) has no row.
    """
    group = [*keys, "var"]
    low, high = float(width) / 2, RANGE_TOP * float(cutoff)
    step, last = (high / low) ** (1.0 / (COARSE - 1)), last_range(cutoff, width)
    # The searches read the bins again and again, so they are made once. One small shuffle brings a variogram's bins
    # together; both searches stay in that partition.
    bins = stage(bins.select(*group, "bin", "np", "dist", "gamma"), "bins").repartition(*group)
    models = ", ".join(f"'{m}'" for m in MODELS)

    def search(some: DataFrame, first: int, end: int) -> DataFrame:
        """Best of the ranges numbered ``first`` to ``end`` for every variogram and model."""
        tried = some.selectExpr("*", f"explode(sequence({first}, {end})) AS i").selectExpr("*", f"{low!r}D * pow({step!r}D, i) AS a")
        return _profile(tried, [*group, "model", "i", "a"]).groupBy(*group, "model").agg(F.expr("min(struct(sse, i, a, total))").alias("b"))

    top = COARSE - 1
    best = search(bins.selectExpr("*", f"explode(array({models})) AS model"), 0, top)
    best = stage(best.selectExpr("*", f"b.i = {top} AS open", "b.i = 0 AS edge"), "ranges")
    while top < last:
        rising = best.filter("open").select(*group, "model")
        if rising.isEmpty():
            break
        first, top = top + 1, min(top + MORE, last)
        further = search(by_shuffle(bins).join(rising, group), first, top).withColumnRenamed("b", "f")
        # Better by enough: go on from there. Better by less: the range is a bound. Not better: it was the best.
        better = f"open AND f IS NOT NULL AND b.sse - f.sse > {FALLS!r}D * b.total"
        best = stage(by_shuffle(best).join(further, [*group, "model"], "left").selectExpr(
            *group, "model", f"CASE WHEN {better} THEN f ELSE b END AS b", f"{better} AND f.i = {top} AS open",
            f"CASE WHEN {better} THEN f.i = {last} WHEN open THEN coalesce(f.sse < b.sse, true) ELSE edge END AS edge"), "ranges")
    fine = by_shuffle(bins).join(best, group).selectExpr("*", f"explode(sequence({-FINE}, {FINE})) AS j")
    fine = _profile(
        fine.selectExpr("*", "b.i AS i", f"b.a * pow({step!r}D, j / {FINE}D) AS a"), [*group, "model", "i", "edge", "j", "a"]
    )
    return (
        fine.groupBy(*group, "model")
        .agg(F.expr("min_by(struct(i, edge, j, a, c0, c1, sse), struct(sse, j))").alias("b"))
        .selectExpr(
            *group, "model", "b.c0 AS nugget", "b.c1 AS psill", "b.c0 + b.c1 AS sill", "b.a AS range", "b.sse AS sse",
            "b.edge AND IF(b.i = 0, b.j <= 0, b.j >= 0) AS range_at_edge",
        )
    )


def _model_order(model: str = "model") -> Column:
    return F.array_position(F.array(*map(F.lit, MODELS)), F.col(model))


def first_valid_model(fits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First model, in order of preference, that could be fitted."""
    group, cols = [*keys, "var"], ["model", "nugget", "psill", "sill", "range"]
    best = fits.groupBy(*group).agg(F.min_by(F.struct(*cols), _model_order()).alias("b"))
    return best.select(*group, *(f"b.{c}" for c in cols))


def select_model(all_vars: DataFrame, fits: DataFrame, scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fitted model with the smallest finite cross-validation RSR; ``IDW`` if there is none.

    ``all_vars`` lists every (keys, var); ``scores`` has (keys, var, model, rsr, bias).
    """
    group, cols = [*keys, "var"], ["model", "nugget", "psill", "sill", "range", "rsr", "bias", "range_at_edge"]
    if "range_at_edge" not in fits.columns:
        fits = fits.withColumn("range_at_edge", F.lit(None).cast("boolean"))
    usable = scores.filter(F.col("rsr").isNotNull() & ~F.isnan("rsr") & (F.abs("rsr") != float("inf")))
    best = (
        by_shuffle(fits).join(usable, [*group, "model"])
        .groupBy(*group).agg(F.min_by(F.struct(*cols), F.struct("rsr", _model_order())).alias("b"))
    )
    return by_shuffle(all_vars).join(best, group, "left").select(
        *group, F.coalesce("b.model", F.lit(NO_MODEL)).alias("model"), *(F.col(f"b.{c}").alias(c) for c in cols[1:])
    )


def variogram_params(chosen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reported parameters of the chosen models; all NULL for ``IDW``."""
    real = F.col("model") != NO_MODEL
    return chosen.select(*keys, "var", "model", *(F.when(real, F.col(c)).alias(c) for c in ("nugget", "sill", "range")))


def variogram_curve(bins: DataFrame, chosen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Empirical and fitted semivariance per bin: the data of a variogram plot."""
    group = [*keys, "var"]
    fitted = chosen.filter(F.col("model") != NO_MODEL).select(*group, "model", "nugget", "psill", "range")
    return bins.join(fitted, group).select(
        *group, "model", "bin", "np", "dist", "gamma", model_gamma().alias("fitted")
    )
