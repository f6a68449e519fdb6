"""Lattice inference, refinement and assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gustgrid.operators.numbering import row_numbers
from gustgrid.operators.projection import project
from gustgrid.session import by_shuffle, stage

# Relative tolerance when a coordinate is matched to a lattice line.
ON_LINE = 1e-6
# Coordinates nearer than this share of the extent are one lattice line (noise of float arithmetic).
SAME_LINE = 1e-7
# Candidates for the step of a lattice: the commonest gaps of its lines, and the smallest.
CANDIDATES = 16
# Share of the gaps of each axis that must be whole multiples of the step; relative room for one step.
VOTES, STEP_ROOM = 0.9, 1e-3
# Column with the projection of a key's lattice, where keys have their own.
PROJECTION = "_projection"
# Points and keys of one block when a point list meets the hours: a task makes the pairs of a few blocks. Copies of rows for
# the block pairs that one task makes, about.
POINT_BLOCK, BLOCKS_A_TASK, COPIES_A_TASK = 1000, 8, 1_000_000


def anchor_offset(df: DataFrame, keys: Sequence[str], x="x", y="y", proj_x="proj_x", proj_y="proj_y") -> DataFrame:
    """Shift grid coordinates by the projected position of each key's first node.

    The first node is the one with the smallest (y, x), so row order does not matter.
    """
    first = df.groupBy(*keys).agg(
        F.min_by(F.struct(proj_x, proj_y), F.struct(F.col(y), F.col(x))).alias("_a")
    )
    return (
        df.join(first, list(keys))
        .withColumn(x, F.col(x) + F.col(f"_a.{proj_x}"))
        .withColumn(y, F.col(y) + F.col(f"_a.{proj_y}"))
        .drop("_a")
    )


def local_coords(df: DataFrame, keys: Sequence[str], x="x", y="y") -> DataFrame:
    """Add ``x_local, y_local`` and the key's origin ``min_x, min_y``."""
    origin = df.groupBy(*keys).agg(F.min(x).alias("min_x"), F.min(y).alias("min_y"))
    return (
        df.join(origin, list(keys))
        .withColumn("x_local", F.col(x) - F.col("min_x"))
        .withColumn("y_local", F.col(y) - F.col("min_y"))
    )


def infer_lattice(df: DataFrame, keys: Sequence[str], x="x", y="y") -> DataFrame:
    """One row per key: origin, extents, step between lattice lines, number of lines.

    The step is the largest gap of which nine tenths of the gaps of each axis are whole multiples, so a node beside
    the lines or patches far apart do not change it. The lines are those of the commonest remainder; extents are from
    the first to the last of them, and :func:`off_lattice` lists the rows that lie on none. Coordinates that differ by
    noise are one line. ``base_res`` is NULL without two lines, and for scattered points, of which no gap wins.
    Only the distinct coordinates of one axis (the lattice width) meet in a window.
    """
    keys = list(keys)
    axes = df.select(*keys, F.explode(F.array(
        F.struct(F.lit("x").alias("axis"), F.col(x).cast("double").alias("c")),
        F.struct(F.lit("y").alias("axis"), F.col(y).cast("double").alias("c")),
    )).alias("_e")).select(*keys, "_e.axis", "_e.c").distinct()
    per_axis = Window.partitionBy(*keys, "axis")
    gap = F.col("c") - F.lag("c").over(per_axis.orderBy("c"))
    lowest, highest = F.min("c").over(per_axis), F.max("c").over(per_axis)
    axes = axes.withColumns({"gap": gap, "low": lowest, "extent": highest - lowest}).withColumn(
        "fresh", F.coalesce(F.col("gap") > SAME_LINE * F.col("extent"), F.lit(True)))
    axes = stage(axes, "lines")

    gaps = axes.filter("fresh AND gap IS NOT NULL").groupBy(*keys, "axis", F.expr("CAST(round(ln(gap) * 10000) AS BIGINT)").alias("size")).agg(
        F.count(F.lit(1)).alias("n"), F.min("gap").alias("gap"))
    of_key = Window.partitionBy(*keys)
    ranked = gaps.withColumns({"place": F.row_number().over(of_key.orderBy(F.desc("n"), "gap")), "least": F.min("gap").over(of_key)})
    tried = ranked.filter((F.col("place") <= CANDIDATES) | (F.col("gap") == F.col("least"))).select(*keys, F.col("gap").alias("step")).distinct()
    times = "gap / step"
    fits = f"abs({times} - round({times})) <= {STEP_ROOM} * greatest(1D, {times} * {STEP_ROOM}) AND round({times}) >= 1"
    votes = tried.join(gaps, keys).groupBy(*keys, "step", "axis").agg((F.sum(F.expr(f"CASE WHEN {fits} THEN n ELSE 0 END")) / F.sum("n")).alias("share"))
    steps = votes.groupBy(*keys, "step").agg(F.min("share").alias("share")).filter(F.col("share") >= VOTES).groupBy(*keys).agg(F.max("step").alias("base_res"))

    # Lines by their remainder, a thousandth of a step wide, and the two beside it; without a step every line counts.
    turn = round(1 / STEP_ROOM)
    known = axes.join(steps, keys, "left").withColumn("rest", F.expr(f"coalesce(CAST(pmod(round((c - low) / base_res * {turn}), {turn}) AS BIGINT), 0L)"))
    common = known.groupBy(*keys, "axis", "rest").agg(F.count_if("fresh").alias("n")).groupBy(*keys, "axis").agg(
        F.max_by("rest", F.struct("n", -F.col("rest"))).alias("common"))
    on_line = by_shuffle(known).join(common, [*keys, "axis"]).filter(f"pmod(rest - common + 1, {turn}) <= 2")
    best = on_line.groupBy(*keys, "axis").agg(F.struct(
        F.min("c").alias("first"), F.max("c").alias("last"), F.count_if("fresh").alias("n"), F.max("base_res").alias("base_res")).alias("b"))

    def of(axis, column):
        return F.max(F.when(F.col("axis") == axis, F.col(f"b.{column}")))

    return best.groupBy(*keys).agg(
        F.max("b.base_res").alias("base_res"), of("x", "first").alias("min_x"), of("y", "first").alias("min_y"),
        (of("x", "last") - of("x", "first")).alias("max_x_local"), (of("y", "last") - of("y", "first")).alias("max_y_local"),
        of("x", "n").alias("n_x"), of("y", "n").alias("n_y"),
    )


def off_lattice(df: DataFrame, lattice: DataFrame, keys: Sequence[str], x="x", y="y") -> DataFrame:
    """Rows that lie on no node of their key's native lattice."""
    return assign_node_id(df, lattice, keys, 1, x, y).filter("node IS NULL").drop("node")


def _lines(extent: Column, spacing: Column) -> Column:
    return F.floor(extent / spacing + ON_LINE).cast("int") + 1


def refine_grid(lattice: DataFrame, keys: Sequence[str], res_factor: int) -> DataFrame:
    """All nodes of the lattice refined by a whole factor, x fastest.

    Node ids count from 1; ``is_orig`` marks nodes on the native lattice. Rows are spread by
    (key, line) before the x axis is expanded, so one hour is not one task.
    """
    keys, f = list(keys), int(res_factor)
    spacing = F.col("base_res") / F.lit(float(f))
    rows = (
        lattice.filter(F.col("base_res") > 0)
        .withColumn("spacing", spacing)
        .withColumn("nx", _lines(F.col("max_x_local"), F.col("spacing")))
        .withColumn("ny", _lines(F.col("max_y_local"), F.col("spacing")))
        .select(*keys, "min_x", "min_y", "spacing", "nx",
                F.explode(F.sequence(F.lit(0), F.col("ny") - 1)).alias("iy"))
    )
    return (
        rows.repartition(*keys, "iy")
        .select("*", F.explode(F.sequence(F.lit(0), F.col("nx") - 1)).alias("ix"))
        .select(
            *keys,
            (F.col("iy").cast("bigint") * F.col("nx") + F.col("ix") + 1).alias("node"),
            "ix", "iy",
            (F.col("ix") * F.col("spacing")).alias("x_local"),
            (F.col("iy") * F.col("spacing")).alias("y_local"),
            (F.col("min_x") + F.col("ix") * F.col("spacing")).alias("x"),
            (F.col("min_y") + F.col("iy") * F.col("spacing")).alias("y"),
            ((F.col("ix") % f == 0) & (F.col("iy") % f == 0)).alias("is_orig"),
        )
    )


def target_nodes(grid: DataFrame) -> DataFrame:
    return grid.filter(~F.col("is_orig"))


def assign_node_id(df: DataFrame, lattice: DataFrame, keys: Sequence[str], res_factor: int, x="x", y="y") -> DataFrame:
    """Add the refined-grid ``node`` of each data row, NULL off the lattice.

    The grid is regular, so its equi-join on coordinates is arithmetic on the key's lattice row;
    the grid itself is not scanned.
    """
    spacing = F.col("base_res") / F.lit(float(int(res_factor)))
    lat = lattice.select(
        *keys, "min_x", "min_y", spacing.alias("_s"),
        _lines(F.col("max_x_local"), spacing).alias("_nx"),
        _lines(F.col("max_y_local"), spacing).alias("_ny"),
    )
    fx, fy = (F.col(x) - F.col("_min_x")) / F.col("_s"), (F.col(y) - F.col("_min_y")) / F.col("_s")
    ix, iy = F.round(fx).cast("bigint"), F.round(fy).cast("bigint")
    on_grid = (
        (F.abs(fx - ix) <= ON_LINE) & (F.abs(fy - iy) <= ON_LINE)
        & ix.between(F.lit(0), F.col("_nx") - 1) & iy.between(F.lit(0), F.col("_ny") - 1)
    )
    lat = lat.withColumnsRenamed({"min_x": "_min_x", "min_y": "_min_y"})
    return (
        df.join(lat, list(keys), "left")
        .withColumn("node", F.when(on_grid, iy * F.col("_nx") + ix + 1))
        .drop("_min_x", "_min_y", "_s", "_nx", "_ny")
    )


def append_points(grid: DataFrame, points: DataFrame, lattice: DataFrame, keys: Sequence[str], projection) -> DataFrame:
    """Add named points (name, lon, lat) to the grid of every key.

    Every key needs every point, so the result has that many rows. Both lists are dealt into blocks, each row is
    copied to the block pairs it takes part in, and the pair of blocks is an equi-join: no list is broadcast, and the
    tasks follow the number of pairs. Points are projected before they meet the keys, unless each key has its own
    projection. Points without a name are numbered by longitude and latitude. Points with key columns go to their own
    keys only.
    A lattice with a ``PROJECTION`` column gives each key its projection.
    """
    keys = list(keys)
    more = [PROJECTION] if PROJECTION in lattice.columns else []
    if keys and set(keys) <= set(points.columns):
        own = points.select(*keys, "name", "lon", "lat")
        rank = F.row_number().over(Window.partitionBy(*keys, F.col("name").isNull()).orderBy("lon", "lat"))
        own = own.withColumn("name", F.coalesce("name", F.concat(F.lit("test_point_"), rank)))
        return _appended(grid, lattice.select(*keys, "min_x", "min_y", *more).join(own, keys), keys, projection)
    given = points.select("name", "lon", "lat")
    unnamed = row_numbers(given.filter("name IS NULL"), ["lon", "lat"]).select(F.concat(F.lit("test_point_"), "number").alias("name"), "lon", "lat")
    listed = given.filter("name IS NOT NULL").union(unnamed)
    listed = stage(listed if more else project(listed, projection).drop("lon", "lat"), "points")
    origins = stage(lattice.select(*keys, "min_x", "min_y", *more), "origins")
    of_points, of_keys = (max(1, -(-df.count() // POINT_BLOCK)) for df in (listed, origins))
    tasks = max(int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-of_points * of_keys // BLOCKS_A_TASK))

    a, b = _copied(listed, "_p", of_points, "_k", of_keys), _copied(origins, "_k", of_keys, "_p", of_points)
    pairs = by_shuffle(a.repartition(tasks, "_p", "_k")).join(b.repartition(tasks, "_p", "_k"), ["_p", "_k"])
    return _appended(grid, pairs.drop("_p", "_k"), keys, projection if more else None)


def _copied(df: DataFrame, own: str, blocks: int, other: str, copies: int) -> DataFrame:
    """Adds the row's block ``own`` and a copy for each block ``other`` of the other list. The copies are as many as the pairs
    of a block and a row, so many are made by several tasks, however few files the list comes from."""
    block = F.pmod(F.xxhash64(*df.columns), F.lit(blocks)).cast("int").alias(own)
    tasks = -(-blocks * POINT_BLOCK * copies // COPIES_A_TASK)
    rows = df.repartition(tasks) if tasks > 1 else df
    return rows.select("*", block, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other))


def _appended(grid: DataFrame, named: DataFrame, keys: list[str], projection) -> DataFrame:
    """The grid and the named points, which have x and y already where no projection is given."""
    named = (project(named, projection) if projection is not None else named).select(
        *keys, F.col("name").alias("node_id"),
        (F.col("x") - F.col("min_x")).alias("x_local"), (F.col("y") - F.col("min_y")).alias("y_local"),
        "x", "y", F.lit(False).alias("is_orig"), F.lit(True).alias("is_test_point"),
    )
    return (
        grid.withColumn("node_id", F.col("node").cast("string"))
        .withColumn("is_test_point", F.lit(False))
        .unionByName(named, allowMissingColumns=True)
    )


def assemble_grid(grid: DataFrame, data: DataFrame, predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Originals take the data, targets the predictions; tag where each value comes from.

    ``data`` has (keys, node_id, u, v), ``predictions`` (keys, node_id, u, v, u_rkt, v_rkt,
    kriging_var_u, kriging_var_v).
    """
    on = [*keys, "node_id"]
    known = data.select(*on, F.struct("u", "v").alias("_d"))
    made = predictions.select(
        *on, F.struct("u", "v", "u_rkt", "v_rkt", "kriging_var_u", "kriging_var_v").alias("_p")
    )
    joined = grid.join(known, on, "left").join(made, on, "left")

    def filled(column, source):
        return F.when(F.col("is_orig"), F.col(f"_d.{source}")).otherwise(F.col(f"_p.{column}"))

    return joined.select(
        *grid.columns,
        filled("u", "u").alias("u"), filled("v", "v").alias("v"),
        filled("u_rkt", "u").alias("u_rkt"), filled("v_rkt", "v").alias("v_rkt"),
        F.when(~F.col("is_orig"), F.col("_p.kriging_var_u")).alias("kriging_var_u"),
        F.when(~F.col("is_orig"), F.col("_p.kriging_var_v")).alias("kriging_var_v"),
        source_tag(F.col("is_orig"), F.col("is_test_point")).alias("interpolation_source"),
    )


def output_counts(nodes: DataFrame, clipped_grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Input rows per key, and nodes of the clipped grid that are not originals."""
    made = clipped_grid.groupBy(*keys).agg(F.count_if(~F.col("is_orig")).cast("int").alias("interpolated_count"))
    return (
        nodes.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("input_count"))
        .join(made, list(keys), "left")
        .withColumn("interpolated_count", F.coalesce("interpolated_count", F.lit(0)))
    )


def source_tag(is_orig: Column, is_test_point: Column) -> Column:
    return F.when(is_test_point, "test_point").when(is_orig, "original").otherwise("interpolated")
