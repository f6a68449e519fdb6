"""Consecutive row numbers without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gustgrid.session import stage


def row_numbers(df: DataFrame, order: Sequence[str | Column], name: str = "number") -> DataFrame:
    """Adds ``name``: 1, 2, ... in ascending ``order``; rows equal in it are ordered by all their columns.

    Rows are dealt by ranges and numbered within each range; the ranges' sizes, one number a task, pass
    through the driver and become the number before each range. Equal rows get different numbers.
    """
    part, spark = f"{name}_part", df.sparkSession
    keys = [*(F.col(c) if isinstance(c, str) else c for c in order), F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))]
    dealt = stage(df.repartitionByRange(*keys).withColumn(part, F.spark_partition_id()), "numbered")
    before, rows = 0, []
    for r in dealt.groupBy(part).agg(F.count(F.lit(1)).alias("n")).orderBy(part).collect():
        rows.append((r[part], before))
        before += r["n"]
    offsets = spark.createDataFrame(rows, f"{part} int, {name}_before long")
    own = F.row_number().over(Window.partitionBy(part).orderBy(*keys))
    return dealt.withColumn(f"{name}_own", own).join(offsets, part).withColumn(
        name, F.col(f"{name}_own") + F.col(f"{name}_before")).select(*df.columns, name)
