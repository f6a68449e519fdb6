"""Equi-joins whose hot keys are cut into blocks.

A join on a cell forms all pairs of the cell's rows in one task. Here the rows of a key that holds more
than ``BLOCK_ROWS`` are dealt into blocks, each row is copied to the block pairs it takes part in, and
the pair of blocks joins the key. Every pair of rows still meets exactly once, no task forms more than
about ``BLOCK_ROWS`` squared pairs of one key, and keys of ordinary size are joined as they were: only
the hot keys and their sizes, a small table, are looked up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gustgrid.session import by_shuffle, stage

BLOCK_ROWS = 1000


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))


def _sizes(df: DataFrame, on: list[str], name: str, size: int) -> DataFrame:
    return df.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("int").alias(name))


def _dealt(df: DataFrame, hot: DataFrame, on: list[str], own: str, other: str, mine: str, theirs: str) -> DataFrame:
    """Adds the row's block ``mine`` and a copy for each block ``theirs`` of the other side."""
    known = df.withColumn("_hash", _row_hash(df)).join(hot, on, "left")
    block = F.pmod(F.col("_hash"), F.coalesce(own, F.lit(1))).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
    return known.withColumn(mine, block).withColumn(theirs, copies).drop("_hash", own, other)


def _met(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """The join of both sides over a fixed number of tasks: small rows that form many pairs must not be merged into one."""
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return by_shuffle(a.repartition(tasks, *on, "_p", "_q")).join(b.repartition(tasks, *on, "_p", "_q"), [*on, "_p", "_q"])


def blocked_join(left: DataFrame, right: DataFrame, on: Sequence[str], size: int = BLOCK_ROWS) -> DataFrame:
    """``left.join(right, on)``; both are counted first, so give tables that are cheap to read again.

    Equal rows have equal hashes and stay in one block. The sides share no column names but ``on``.
    """
    on = list(on)
    sizes = by_shuffle(_sizes(left, on, "_left_blocks", size)).join(_sizes(right, on, "_right_blocks", size), on)
    hot = stage(sizes.filter("_left_blocks > 1 OR _right_blocks > 1"), "hot-keys")
    a = _dealt(left, hot, on, "_left_blocks", "_right_blocks", "_p", "_q")
    b = _dealt(right, hot, on, "_right_blocks", "_left_blocks", "_q", "_p")
    return _met(a, b, on).drop("_p", "_q")


def blocked_pairs(rows: DataFrame, on: Sequence[str], left: dict[str, str], right: dict[str, str], size: int = BLOCK_ROWS) -> DataFrame:
    """Pairs of rows of one table with equal ``on``: block pairs form a triangle.

    ``left`` and ``right`` name the columns of either side. ``_ordered`` is false where both rows are of one
    block, so that both orders of a pair (and a row with itself) appear; between blocks each pair appears once.
    """
    on = list(on)
    hot = stage(_sizes(rows, on, "_blocks", size).filter("_blocks > 1"), "hot-keys")
    known = rows.withColumn("_hash", _row_hash(rows)).join(hot, on, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    known = known.withColumn("_b", F.pmod(F.col("_hash"), F.col("_blocks")).cast("int"))

    def side(names: dict[str, str], own: str, other: str, low: str, high: str) -> DataFrame:
        return known.selectExpr(*on, f"_b AS {own}", f"explode(sequence({low}, {high})) AS {other}", *(f"{c} AS {n}" for n, c in names.items()))

    pairs = _met(side(left, "_p", "_q", "_b", "_blocks - 1"), side(right, "_q", "_p", "0", "_b"), on)
    return pairs.withColumn("_ordered", F.col("_p") < F.col("_q")).drop("_p", "_q")


def _beside(cell: Sequence[str]) -> list[str]:
    """The cells whose half neighbours (1,0) (-1,1) (0,1) (1,1) include the cell ``cell``; needs ``_o`` from 1 to 4."""
    x, y = cell
    return [f"{x} - CASE WHEN _o IN (1, 4) THEN 1 WHEN _o = 2 THEN -1 ELSE 0 END AS {x}", f"{y} - CASE WHEN _o >= 2 THEN 1 ELSE 0 END AS {y}"]


def packed_pairs(rows: DataFrame, keys: Sequence[str], cell: Sequence[str], size: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of rows that meet: every pair of rows of one cell, and of a cell and its eight neighbours, in one row each.

    Returns keys, ``a``, ``b`` (arrays of the other columns of up to about ``size`` rows) and ``same``: then ``b`` is ``a``,
    and only pairs of different places in it count. Otherwise all pairs of ``a`` and ``b`` do. ``cell`` names the two
    numbers of a cell. Rows without a key or cell meet none.
    """
    keys, cell = list(keys), list(cell)
    on = [*keys, *cell]
    rows = rows.dropna(subset=on)
    hot = stage(_sizes(rows, on, "_blocks", size).filter("_blocks > 1"), "hot-keys")
    item = F.struct(*(c for c in rows.columns if c not in on))
    dealt = rows.withColumn("_hash", _row_hash(rows)).join(hot, on, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    dealt = dealt.withColumn("_b", F.pmod("_hash", "_blocks").cast("int"))
    packed = stage(dealt.groupBy(*on, "_blocks", "_b").agg(F.collect_list(item).alias("a")), "packed")

    own = packed.filter("size(a) > 1").selectExpr(*keys, "a", "a AS b", "true AS same")
    cut = packed.filter("_blocks > 1")
    low = cut.filter("_b < _blocks - 1").selectExpr(*on, "a", "_b AS _p", "explode(sequence(_b + 1, _blocks - 1)) AS _q")
    high = cut.filter("_b > 0").selectExpr(*on, "a AS b", "_b AS _q", "explode(sequence(0, _b - 1)) AS _p")
    # A block is copied for the blocks of the neighbours it meets: most cells have one, and so have theirs.
    theirs = hot.selectExpr("*", "explode(sequence(1, 4)) AS _o").selectExpr(*keys, *_beside(cell), "_blocks AS _other").groupBy(*on).agg(F.max("_other").alias("_other"))
    left = packed.join(theirs, on, "left").selectExpr(*on, "a", "_b AS _p", "explode(sequence(0, coalesce(_other, 1) - 1)) AS _q")
    moved = packed.selectExpr(*on, "a AS b", "_b AS _q", "explode(sequence(1, 4)) AS _o").selectExpr(*keys, *_beside(cell), "b", "_q")
    right = moved.join(hot.withColumnRenamed("_blocks", "_other"), on, "left").selectExpr(*on, "b", "_q", "explode(sequence(0, coalesce(_other, 1) - 1)) AS _p")
    met = _met(low, high, on).unionByName(_met(left, right, on)).selectExpr(*keys, "a", "b", "false AS same")
    return own.unionByName(met)
