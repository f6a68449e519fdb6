"""Exact nearest-neighbour and range joins on planar coordinates.

Distances never drive the join: points are bucketed into square cells and cells are equi-joined.
For k nearest neighbours the cell size follows the local density. Row counts of nested cells
(cell sides ``c0 * 2**level``) give, for every query, the finest level whose 3x3 block around the
query holds k rows. Those k rows lie within ``2*sqrt(2)`` cell sides, so this bounds the k-th
distance, and the 3x3 block of the level whose cells are at least as wide as that bound contains every
row that can be among the k nearest. No row is dropped by a guess, and dense spots get small cells
instead of large groups.

Rows are copied into cells here, which the planner's estimates do not see (nor the compression of the
files they come from), so tables of rows are joined by shuffle (:func:`gustgrid.session.by_shuffle`)
and never collected for a broadcast.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from gustgrid.operators.blocks import blocked_join
from gustgrid.session import by_shuffle, stage

# The choice of the nearest travels with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Cells are halved until none holds more than CROWD * k rows, however dense a spot is: the depths
# tried below the average-density cell, and the bits a cell number may have (a double has no more).
DEPTHS, CELL_BITS, CROWD = (0, 1, 2, 3, 5, 8, 12, 18, 26, 36, 48), 50, 4
# Extra room when the nearest rows of a query's own fold are not eligible.
FOLD_ROOM = 1.6
# Queries of a cell that meet its block in one row, and pairs taken at a time.
PACK_ROWS, CHUNK = 1000, 1 << 16
# Cells of 2**NEAR_BITS by as many lie in one task when counts are copied to the cells around.
NEAR_BITS = 3


def _into_block(df: DataFrame, radius: int) -> DataFrame:
    """Copy each row into every cell of the block around its own cell."""
    kept, side = [c for c in df.columns if c not in ("_cx", "_cy")], 2 * radius + 1
    return df.selectExpr("*", f"explode(sequence(0, {side * side - 1})) AS _o").selectExpr(
        *kept, f"_cx + _o % {side} - {radius} AS _cx", f"_cy + _o div {side} - {radius} AS _cy"
    )


def limit_copies(train: DataFrame, keys: Sequence[str], k: int, fold: str | None) -> DataFrame:
    """Keep the k first ids of each location (and fold); later copies can never be among k nearest.

    Copies with one id are ordered by their other columns, so reruns keep the same ones.

    Spark applies the group limit before the shuffle, so a location with a third of all rows
    sends k rows per input task.
    """
    where = [*keys, "t_x", "t_y"] + (["t_fold"] if fold else [])
    rank = F.row_number().over(Window.partitionBy(*where).orderBy("t_id", *(c for c in train.columns if c not in (*where, "t_id"))))
    return train.withColumn("_copy", rank).filter(F.col("_copy") <= k).drop("_copy")


@dataclass(frozen=True)
class _Grid:
    """Extent of the training rows, the cell side at level 0 (the average density), and how many
    levels are above and below it."""

    x0: float
    x1: float
    y0: float
    y1: float
    side: float
    top: int
    finer: int = 0

    @property
    def fine(self) -> float:
        return self.side / 2.0**self.finer

    def cell(self, x: str, y: str) -> list[str]:
        """Finest cell of the position moved into the extent, and the squared move."""
        px = f"greatest({self.x0!r}D, least({x}, {self.x1!r}D))"
        py = f"greatest({self.y0!r}D, least({y}, {self.y1!r}D))"
        return [
            f"CAST(floor(({px} - {self.x0!r}D) / {self.fine!r}D) AS BIGINT) AS _fx",
            f"CAST(floor(({py} - {self.y0!r}D) / {self.fine!r}D) AS BIGINT) AS _fy",
            f"({x} - {px}) * ({x} - {px}) + ({y} - {py}) * ({y} - {py}) AS _off2",
        ]

    def farthest_in_block(self) -> str:
        """Distance from the (moved) query to the farthest corner of its 3x3 block at ``_level``."""
        def axis(fine_cell: str) -> str:
            cells = f"pow(2D, _level + {self.finer})"
            inside = f"({fine_cell} / {cells} - floor({fine_cell} / {cells}))"
            # The position lies between the finest cell's two edges.
            return f"greatest(1 + {inside} + 1 / {cells}, 2 - {inside}) * {self.fine!r}D * {cells}"

        return f"sqrt(pow({axis('_fx')}, 2) + pow({axis('_fy')}, 2))"

    def near_cell(self) -> str:
        """Whether the cell (``_cx``, ``_cy``) of ``_l`` holds positions within the bound of the query."""
        def axis(cell: str, q: str, low: float) -> str:
            # A millionth of a side covers the rounding of the cells' edges.
            edge = f"({low!r}D + {cell} * pow(2D, _l) * {self.side!r}D)"
            return f"greatest({edge} - {q}, {q} - {edge} - pow(2D, _l) * {self.side!r}D, 0D) - {1e-6 * self.side!r}D * pow(2D, _l)"

        def square(a: str) -> str:
            return f"pow(greatest({a}, 0D), 2)"

        return f"(_bound2 IS NULL OR {square(axis('_cx', 'q_x', self.x0))} + {square(axis('_cy', 'q_y', self.y0))} <= _bound2)"

    def inside(self) -> str:
        """Whether the cell of ``_l`` lies in the extent."""
        last = [f"floor({high - low!r}D / {self.fine!r}D) / pow(2D, _l + {self.finer})" for low, high in ((self.x0, self.x1), (self.y0, self.y1))]
        return f"_cx BETWEEN 0 AND {last[0]} AND _cy BETWEEN 0 AND {last[1]}"

    @property
    def levels(self) -> str:
        return f"explode(sequence({-self.finer}, {self.top})) AS _l"


def _grid_of(train: DataFrame, keys: list[str], k: float) -> _Grid | None:
    """A few small jobs: extent and average density of all training rows, then the depth at which no
    cell is crowded. Most tables need none, so deeper cells are counted only where the ones before are
    crowded. A dozen numbers reach the driver."""
    row = (
        train.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), F.min("t_x").alias("x0"), F.max("t_x").alias("x1"),
             F.min("t_y").alias("y0"), F.max("t_y").alias("y1"))
        .agg(F.max("n"), F.min("x0"), F.max("x1"), F.min("y0"), F.max("y1"))
        .first()
    )
    n, x0, x1, y0, y1 = row
    if n is None:
        return None
    w, h = x1 - x0, y1 - y0
    side = 1.05 * max(math.sqrt(w * h * k / (9.0 * n)), max(w, h) * k / (3.0 * n))
    side = min(side, max(w, h)) or 1.0
    top = max(0, math.ceil(math.log2(max(w, h, side) / side)))
    depths = [d for d in DEPTHS if d + top <= CELL_BITS] or [0]
    finer = depths[-1]
    for tried in filter(None, (depths[:1], depths[1:4], depths[4:])):
        deepest = _Grid(x0, x1, y0, y1, side, top, tried[-1])
        counts = train.selectExpr(*keys, *deepest.cell("t_x", "t_y")).selectExpr(
            *keys, "_fx", "_fy", f"explode(array({', '.join(map(str, tried))})) AS _d"
        ).selectExpr(*keys, "_d", f"shiftright(_fx, {tried[-1]} - _d) AS _cx", f"shiftright(_fy, {tried[-1]} - _d) AS _cy")
        crowds = counts.groupBy(*keys, "_d", "_cx", "_cy").agg(F.count(F.lit(1)).alias("n")).groupBy("_d").agg(F.max("n").alias("n")).collect()
        enough = [r["_d"] for r in crowds if r["n"] <= CROWD * k]
        if enough:
            finer = min(enough)
            break
    return _Grid(x0, x1, y0, y1, side, top, finer)


def _at_level(df: DataFrame, grid: _Grid) -> DataFrame:
    """Replace the finest cell by the cell at level ``_l``."""
    kept = [c for c in df.columns if c not in ("_fx", "_fy")]
    return df.selectExpr(
        *kept, f"shiftright(_fx, _l + {grid.finer}) AS _cx", f"shiftright(_fy, _l + {grid.finer}) AS _cy"
    )


def _query_levels(train: DataFrame, query: DataFrame, grid: _Grid, keys: list[str], k: int, fold: str | None) -> DataFrame:
    """Finest level whose 3x3 block holds k eligible rows, per distinct finest cell of the queries."""
    by = [*keys, "_l", "_cx", "_cy"]
    fold_col = ["t_fold"] if fold else []
    nested = (
        _at_level(train.selectExpr(*keys, *fold_col, "_fx", "_fy", grid.levels), grid)
        .groupBy(*by, *fold_col).agg(F.count(F.lit(1)).alias("n"))
    )
    if fold:
        # Rows outside the largest fold of a cell are eligible for a query of any fold.
        nested = nested.groupBy(*by).agg((F.sum("n") - F.max("n")).alias("n"))
    # Cells near each other are brought together, so most copies of a cell are summed where they are made.
    near = nested.repartition(*keys, "_l", F.shiftright("_cx", NEAR_BITS), F.shiftright("_cy", NEAR_BITS))
    around = _into_block(near, 1).groupBy(*by).agg(F.sum("n").alias("n")).filter(F.col("n") >= k).drop("n")
    asked = query.select(*keys, "_fx", "_fy").distinct().selectExpr(*keys, "_fx", "_fy", "_fx AS _qx", "_fy AS _qy", grid.levels)
    return (
        by_shuffle(_at_level(asked, grid)).join(around, by)
        .groupBy(*keys, "_qx", "_qy").agg(F.min("_l").alias("_level"))
        .withColumnsRenamed({"_qx": "_fx", "_qy": "_fy"})
    )


def knn_join(
    query: DataFrame,
    train: DataFrame,
    k: int,
    keys: Sequence[str],
    query_id: str = "id",
    train_id: str = "id",
    x: str = "x",
    y: str = "y",
    maxdist: float | None = None,
    fold: str | None = None,
    train_cols: Sequence[str] = (),
    query_cols: Sequence[str] = (),
    unique_locations: bool = False,
    spread: str = "train",
) -> DataFrame:
    """The k nearest training rows of each query row with the same keys.

    Returns keys, ``q_id, q_x, q_y, t_id, t_x, t_y``, the ``query_cols`` and ``train_cols``, squared
    distance ``d2`` and ``rank``; ties are broken by training id. ``maxdist`` drops farther rows; ``fold`` names a
    column of both sides and only rows of *other* folds are eligible. ``spread`` says which side is
    copied into the cell block: the smaller one.

    A dozen numbers (extent and density of the training rows) reach the driver. The training rows without
    needless copies, the queries with their level, and the levels in use per key, are written to the shared
    folder once.
    """
    keys = list(keys)
    q, t, grid = _celled(query, train, k, keys, query_id, train_id, x, y, maxdist, fold, train_cols, query_cols, unique_locations)
    cell = [*keys, "_l", "_cx", "_cy"]
    if spread == "train":
        # The rank window is clustered on a superset of the join key: no further shuffle.
        pairs, clustered = by_shuffle(q).join(_into_block(t, 1).filter(grid.inside()), cell), [*cell, "q_id"]
    else:
        pairs, clustered = by_shuffle(_into_block(q, 1).filter(grid.near_cell())).join(t, cell), [*keys, "q_id"]
    tail = ["_l", "_cx", "_cy"] if spread == "train" else []
    return _nearest(pairs, k, keys, clustered, maxdist, fold, train_cols, query_cols, tail)


def _celled(query, train, k, keys, query_id, train_id, x, y, maxdist, fold, train_cols, query_cols, unique_locations):
    """Queries in the cell whose block holds all rows that can be among their k nearest, the training rows in the cells
    of the levels in use, and the grid."""
    q_fold, t_fold = ([f"{fold} AS q_fold"], [f"{fold} AS t_fold"]) if fold else ([], [])
    q = query.selectExpr(*keys, f"{query_id} AS q_id", f"CAST({x} AS DOUBLE) AS q_x", f"CAST({y} AS DOUBLE) AS q_y", *q_fold, *query_cols)
    t = train.selectExpr(*keys, f"{train_id} AS t_id", f"CAST({x} AS DOUBLE) AS t_x", f"CAST({y} AS DOUBLE) AS t_y", *t_fold, *train_cols)
    if not unique_locations:
        t = stage(limit_copies(t, keys, k, fold), "knn-train")
    grid = _grid_of(t, keys, k * FOLD_ROOM if fold else float(k))
    if grid is None:
        grid = _Grid(0.0, 0.0, 0.0, 0.0, 1.0, 0)
    t = t.selectExpr("*", *grid.cell("t_x", "t_y")).drop("_off2")
    q = q.selectExpr("*", *grid.cell("q_x", "q_y"))
    limit2 = "CAST(NULL AS DOUBLE)" if maxdist is None else f"{float(maxdist) ** 2!r}D"
    if maxdist is not None:
        q = q.filter(f"_off2 <= {limit2}")

    # Bound of the k-th distance, and the level at which the 3x3 block reaches that far from the
    # moved position (moving into the extent shortens the distance to every training row).
    kept = [c for c in q.columns if c not in ("_fx", "_fy", "_off2")]
    q = (
        by_shuffle(q).join(_query_levels(t, q, grid, keys, k, fold), [*keys, "_fx", "_fy"], "left")
        .selectExpr(
            *kept, "_fx", "_fy", "_off2",
            f"least(pow(sqrt(_off2) + {grid.farthest_in_block()}, 2), {limit2}) * {1 + 1e-9!r}D AS _bound2",
        )
        .selectExpr(
            *kept, "_fx", "_fy", "_bound2",
            f"CASE WHEN _bound2 IS NULL THEN {grid.top} ELSE CAST(greatest({-grid.finer}, least({grid.top}, "
            f"ceil(log2(greatest(1e-30D, sqrt(greatest(_bound2 - _off2, 0D)) / {grid.side!r}D))))) AS INT) END AS _l",
        )
    )
    q = stage(_at_level(q, grid), "knn-queries")
    # Training rows are only bucketed at the levels some query of their own keys asked for.
    asked = stage(q.groupBy(*keys).agg(F.collect_set("_l").alias("_ls")), "knn-levels")
    t = _at_level(t.join(asked, keys).selectExpr(
        *keys, "t_id", "t_x", "t_y", *(["t_fold"] if fold else []), *train_cols, "_fx", "_fy", "explode(_ls) AS _l",
    ), grid)

    return q, t, grid


def _nearest(pairs, k, keys, clustered, maxdist, fold, train_cols, query_cols, tail) -> DataFrame:
    """The k nearest of the pairs of each query."""
    columns = [*keys, "q_id", "q_x", "q_y", *query_cols, "t_id", "t_x", "t_y", *train_cols]
    where = "(_bound2 IS NULL OR d2 <= _bound2)"
    if maxdist is not None:
        where += f" AND d2 <= {float(maxdist) ** 2!r}D"
    if fold:
        where += " AND q_fold <> t_fold"
    rank = F.row_number().over(Window.partitionBy(*clustered).orderBy("d2", "t_id", *train_cols))
    return (
        pairs.selectExpr("*", "(q_x - t_x) * (q_x - t_x) + (q_y - t_y) * (q_y - t_y) AS d2").filter(where)
        .select(*columns, "d2", *tail, rank.alias("rank")).filter(F.col("rank") <= k)
    )


def _crowd(k: int) -> int:
    """Training rows from which a block is not an array."""
    return max(2000, 64 * k)


def knn_arrays(
    query: DataFrame,
    train: DataFrame,
    k: int,
    keys: Sequence[str],
    query_id: str = "id",
    train_id: str = "id",
    x: str = "x",
    y: str = "y",
    fold: str | None = None,
    train_cols: Sequence[str] = (),
    query_cols: Sequence[str] = (),
    spread: str = "train",
) -> DataFrame:
    """:func:`knn_join` with one row per query: keys, ``q_id, q_x, q_y``, the ``query_cols``, and ``nb``, the array of its
    neighbours in rank order (``rank, t_x, t_y, d2`` and the ``train_cols``). ``fold`` is a whole number.

    A query's candidates are never rows: the queries of a cell and the training rows of its block meet as arrays, and
    numpy picks the nearest. With ``spread="query"``, for few queries, they are copied into their block instead, meet
    the rows of each cell, and the nearest of every cell are merged. Cells of more than ``PACK_ROWS`` queries are cut by a hash of their id; blocks of
    more than ``_crowd(k)`` training rows take the way of :func:`knn_join`, which sorts pairs in many tasks.
    """
    keys = list(keys)
    q, t, grid = _celled(query, train, k, keys, query_id, train_id, x, y, None, fold, train_cols, query_cols, False)
    cell = [*keys, "_l", "_cx", "_cy"]
    held = t.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    if spread == "train":
        held = _into_block(held, 1).groupBy(*cell).agg(F.sum("n").alias("n"))
        around, carried = _into_block(t, 1).filter(grid.inside()), [*train_cols]
    else:
        q, around, carried = _into_block(q, 1).filter(grid.near_cell()), t, ["t_id", *train_cols]
    crowded = stage(held.filter(F.col("n") > _crowd(k)).select(*cell), "crowded")
    large = q.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / F.lit(PACK_ROWS)).cast("int").alias("_parts")).filter("_parts > 1")
    large = stage(large, "large-cells")

    t_item = F.struct("t_id", *train_cols, "t_x", "t_y", *(["t_fold"] if fold else []))
    q_item = F.struct(*(c for c in q.columns if c not in cell))
    # The order of training rows at one distance: id, then the other columns.
    blocks = around.join(crowded, cell, "left_anti").groupBy(*cell).agg(F.sort_array(F.collect_list(t_item)).alias("_ts"))
    dealt = q.join(large, cell, "left").withColumn("_part", F.pmod(F.xxhash64("q_id"), F.coalesce("_parts", F.lit(1))))
    packed = dealt.groupBy(*cell, "_part").agg(F.collect_list(q_item).alias("_qs"))
    met = by_shuffle(packed).join(blocks, cell).select(*keys, "_qs", "_ts")

    kept = ["q_id", "q_x", "q_y", *query_cols]
    q_types, t_types = ({f.name: f for f in df.schema} for df in (q, t))
    item = [T.StructField("rank", T.IntegerType()), *(T.StructField(c, T.DoubleType()) for c in ("t_x", "t_y", "d2")), *(t_types[c] for c in carried)]
    schema = T.StructType([q_types[c] for c in (*keys, *kept)] + [T.StructField("nb", T.ArrayType(T.StructType(item)))])
    folded = fold is not None

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            qs, ts = batch.column("_qs"), batch.column("_ts")
            asked, known = (dict(zip((f.name for f in c.type.value_type), c.flatten().flatten())) for c in (qs, ts))
            ends = [c.offsets.to_numpy() - c.offsets[0].as_py() for c in (qs, ts)]
            counts, places, d2 = _pick_nearest(asked, known, *ends, k, folded)
            rows = np.flatnonzero(counts)
            offsets = np.concatenate([[0], np.cumsum(counts[rows])]).astype(np.int32)
            take = pa.array(places)
            rank = np.arange(len(places)) - np.repeat(offsets[:-1], counts[rows]) + 1
            fields = [pa.array(rank.astype(np.int32)), known["t_x"].take(take), known["t_y"].take(take), pa.array(d2), *(known[c].take(take) for c in carried)]
            nb = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, ["rank", "t_x", "t_y", "d2", *carried]))
            own = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(ends[0]))[rows])
            chosen = pa.array(rows)
            columns = [batch.column(c).take(own) for c in keys] + [asked[c].take(chosen) for c in kept] + [nb]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    usual = met.mapInArrow(pick, schema)
    # The other blocks, usually none: pairs as rows.
    hot = by_shuffle(q.join(crowded, cell, "left_semi")).join(around.join(crowded, cell, "left_semi"), cell)
    hot = _nearest(hot, k, keys, [*cell, "q_id"], None, fold, train_cols, query_cols, ["_l", "_cx", "_cy"])
    rest = hot.groupBy(*cell, "q_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "t_x", "t_y", "d2", *carried))).alias("nb"),
        *(F.first(c).alias(c) for c in ("q_x", "q_y", *query_cols)))
    found = usual.unionByName(rest.select(*schema.names))
    return found if spread == "train" else _merged(found, k, keys, train_cols, kept)


def _merged(found: DataFrame, k: int, keys: list[str], train_cols: Sequence[str], kept: Sequence[str]) -> DataFrame:
    """The k nearest of those that a query's cells gave, in the order of :func:`_nearest`."""
    order = ["d2", "t_id", *train_cols, "t_x", "t_y"]
    every = F.transform(F.flatten(F.collect_list("nb")), lambda e: F.struct(*(e[c].alias(c) for c in order)))
    rows = found.groupBy(*keys, "q_id").agg(every.alias("_every"), *(F.first(c).alias(c) for c in kept if c != "q_id"))
    nb = F.transform(F.slice(F.sort_array("_every"), 1, k), lambda e, i: F.struct(
        (i + 1).alias("rank"), *(e[c].alias(c) for c in ("t_x", "t_y", "d2", *train_cols))))
    return rows.select(*keys, *kept, nb.alias("nb"))


def _numbers(array: pa.Array) -> np.ndarray:
    return array.cast(pa.float64()).to_numpy(zero_copy_only=False)


def _pick_nearest(asked, known, q_ends, t_ends, k: int, folded: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of neighbours of each query, and their places among the training rows and squared distances, by rank.

    The training rows of a block are in the order that decides between equal distances.
    """
    qx, qy, bound = (_numbers(asked[c]) for c in ("q_x", "q_y", "_bound2"))
    tx, ty = _numbers(known["t_x"]), _numbers(known["t_y"])
    # Without a bound every row counts. Spark takes NaN as the largest number, so a NaN bound excludes nothing either.
    free = np.isnan(bound)
    if folded:
        qf, tf = _numbers(asked["q_fold"]), _numbers(known["t_fold"])
    counts, places, d2s = np.zeros(len(qx), np.int64), [np.zeros(0, np.int64)], [np.zeros(0)]
    for i in range(len(q_ends) - 1):
        ts = slice(t_ends[i], t_ends[i + 1])
        n = ts.stop - ts.start
        step = max(1, CHUNK // max(1, n))
        for start in range(q_ends[i], q_ends[i + 1], step):
            rows = slice(start, min(start + step, q_ends[i + 1]))
            dx, dy = qx[rows, None] - tx[ts], qy[rows, None] - ty[ts]
            d2 = dx * dx + dy * dy
            ok = (d2 <= bound[rows, None]) | free[rows, None]
            if folded:
                a, b = qf[rows, None], tf[ts]
                ok &= (a != b) & ~np.isnan(a) & ~np.isnan(b)
            if np.isfinite(d2).all():
                order = np.argsort(np.where(ok, d2, np.inf), axis=1, kind="stable")[:, :k]
            else:
                order = np.lexsort((d2, ~ok), axis=1)[:, :k]
            found = np.minimum(ok.sum(axis=1), k)
            counts[rows] = found
            near = np.arange(order.shape[1]) < found[:, None]
            places.append(order[near] + ts.start)
            d2s.append(np.take_along_axis(d2, order, axis=1)[near])
    places, d2s = np.concatenate(places), np.concatenate(d2s)
    return _one_row_an_id(asked["q_id"], q_ends, counts, places, d2s, k)


def _one_row_an_id(ids: pa.Array, q_ends: np.ndarray, counts, places, d2s, k: int):
    """Queries of one cell that share an id (or have none) are one query: the first takes the k nearest of all."""
    codes = ids.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    cells = np.repeat(np.arange(len(q_ends) - 1), np.diff(q_ends))
    if not len(codes):
        return counts, places, d2s
    of = cells * (codes.max() + 2) + codes + 1
    order = np.argsort(of, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(of[order]) != 0]))
    if len(first) == len(of):
        return counts, places, d2s
    ends = np.concatenate([[0], np.cumsum(counts)])
    spots = [np.arange(a, b) for a, b in zip(ends[:-1], ends[1:])]
    for a, b in zip(first, [*first[1:], len(order)]):
        if b - a > 1:
            group = order[a:b]
            every = np.concatenate([spots[g] for g in group])
            every = every[np.lexsort((places[every], d2s[every]))][:k]
            for g in group:
                spots[g] = every[:0]
            spots[group[0]] = every
    chosen = np.concatenate(spots)
    return np.array([len(s) for s in spots]), places[chosen], d2s[chosen]


def range_join(
    query: DataFrame,
    train: DataFrame,
    maxdist: float,
    keys: Sequence[str],
    query_id: str = "id",
    x: str = "x",
    y: str = "y",
    train_cols: Sequence[str] = (),
) -> DataFrame:
    """Every training row within ``maxdist`` of each query row: keys, query, training columns, ``d2``.

    Crowded cells are cut into blocks, so points that all lie within one ``maxdist`` are many tasks' work.
    """
    keys, c = list(keys), float(maxdist)

    def celled(df, side, *more):
        return df.selectExpr(
            *keys, *more, f"CAST({x} AS DOUBLE) AS {side}_x", f"CAST({y} AS DOUBLE) AS {side}_y",
            f"floor({x} / {c!r}D) AS _cx", f"floor({y} / {c!r}D) AS _cy",
        )

    q, t = celled(query, "q", f"{query_id} AS q_id"), celled(train, "t", *train_cols)
    return (
        blocked_join(q, _into_block(t, 1), [*keys, "_cx", "_cy"])
        .selectExpr("*", "(q_x - t_x) * (q_x - t_x) + (q_y - t_y) * (q_y - t_y) AS d2")
        .filter(f"d2 <= {c * c!r}D")
        .drop("_cx", "_cy")
    )


def idw_within(
    query: DataFrame, train: DataFrame, maxdist: float, keys: Sequence[str], values: Sequence[str],
    query_id: str = "id", x: str = "x", y: str = "y",
) -> DataFrame:
    """Inverse squared distance weighting over all rows within ``maxdist``; NULL without any.

    Copies of a location have equal weights, so they are summed before the join; an exact hit
    takes the (mean) value of that location.
    """
    keys = list(keys)
    by_place = train.groupBy(*keys, x, y).agg(
        *(F.sum(v).alias(f"_s_{v}") for v in values), *(F.count(v).alias(f"_n_{v}") for v in values)
    )
    sums = [c for v in values for c in (f"_s_{v}", f"_n_{v}")]
    near = range_join(query, by_place, maxdist, keys, query_id, x, y, sums)
    w = F.when(F.col("d2") > 0, 1.0 / F.col("d2"))
    aggs = []
    for v in values:
        s, n = F.col(f"_s_{v}"), F.col(f"_n_{v}")
        hit = F.col("d2") == 0
        at_place = F.sum(F.when(hit, s)) / F.nullif(F.sum(F.when(hit, n)), F.lit(0))
        aggs.append(F.coalesce(at_place, F.sum(w * s) / F.nullif(F.sum(w * n), F.lit(0.0))).alias(v))
    found = near.groupBy(*keys, "q_id").agg(*aggs)
    return by_shuffle(query.select(*keys, F.col(query_id).alias("q_id"))).join(found, [*keys, "q_id"], "left")


def idw_aggregate(value: str, maxdist: float | None = None) -> Column:
    """Inverse squared distance mean of the grouped neighbours; an exact hit takes its value."""
    use = F.lit(True) if maxdist is None else F.col("d2") <= float(maxdist) ** 2
    z = F.col(value)
    w = F.when(use & (F.col("d2") > 0) & z.isNotNull(), 1.0 / F.col("d2"))
    return F.coalesce(F.avg(F.when(use & (F.col("d2") == 0), z)), F.sum(w * z) / F.sum(w))


def idw_nearest(neighbors: DataFrame, keys: Sequence[str], values: Sequence[str], maxdist: float | None = None) -> DataFrame:
    """Inverse squared distance weighting over the rows of :func:`knn_join`."""
    aggs = [idw_aggregate(v, maxdist).alias(v) for v in values]
    return neighbors.groupBy(*neighbor_group(neighbors, keys)).agg(*aggs).select(*keys, "q_id", *values)


def neighbor_aggregates(cutoff: float | None = None) -> list[Column]:
    inside = F.lit(1) if not cutoff or cutoff <= 0 else F.when(F.col("d2") <= float(cutoff) ** 2, 1)
    return [F.sqrt(F.min("d2")).alias("nearest_distance"), F.count(inside).cast("int").alias("neighbors_used")]


def neighbor_stats(neighbors: DataFrame, keys: Sequence[str], cutoff: float | None = None) -> DataFrame:
    """Nearest distance and how many of the k nearest lie within ``cutoff`` (all if it is not positive)."""
    return (
        neighbors.groupBy(*neighbor_group(neighbors, keys)).agg(*neighbor_aggregates(cutoff))
        .select(*keys, "q_id", "nearest_distance", "neighbors_used")
    )


def idw_of(nb: str, value: str) -> Column:
    """:func:`idw_aggregate` over an array of neighbours."""
    hit = f"filter({nb}, e -> e.d2 = 0 AND e.{value} IS NOT NULL)"
    far = f"filter({nb}, e -> e.d2 > 0 AND e.{value} IS NOT NULL)"

    def total(rows, term):
        return f"aggregate({rows}, 0D, (s, e) -> s + {term})"

    mean = f"{total(hit, f'e.{value}')} / nullif(size({hit}), 0)"
    return F.expr(f"coalesce({mean}, {total(far, f'1D / e.d2 * e.{value}')} / nullif({total(far, '1D / e.d2')}, 0D))")


def neighbor_counts(nb: str, cutoff: float | None = None) -> list[Column]:
    """:func:`neighbor_aggregates` over an array of neighbours in rank order."""
    inside = nb if not cutoff or cutoff <= 0 else f"filter({nb}, e -> e.d2 <= {float(cutoff) ** 2!r}D)"
    return [F.expr(f"sqrt({nb}[0].d2)").alias("nearest_distance"), F.expr(f"size({inside})").alias("neighbors_used")]


def neighbor_group(neighbors: DataFrame, keys: Sequence[str]) -> list[str]:
    """Grouping columns of a query's neighbours; the cell columns keep the join's partitioning."""
    cell = [c for c in ("_l", "_cx", "_cy") if c in neighbors.columns]
    return [*keys, *cell, "q_id"]
