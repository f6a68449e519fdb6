"""Sinks for comparison tables and subsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gustgrid.session import stage

# Rows of one writing task: files may be smaller, but the ranges of the tasks are sampled, by a hundred rows a task, on the driver.
TASK_ROWS = 500_000


def write_metrics(tables: dict[str, DataFrame], root: str, by: str = "buoy_id", rows_per_file: int = 500_000) -> None:
    """Each table as CSV with a header under ``root/<name>``, one folder per buoy, files of at most ``rows_per_file`` rows.

    Rows are counted first: tasks follow the data, a buoy with a third of all rows is cut by a hash of the row into a
    third of the tasks, and small buoys share one. A task writes as many files as its rows need.
    """
    for name, df in tables.items():
        known = stage(df, "metrics")
        tasks = max(1, -(-known.count() // max(rows_per_file, TASK_ROWS)))
        dealt = known.repartitionByRange(tasks, F.col(by), F.xxhash64(*known.columns)).sortWithinPartitions(by)
        dealt.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", rows_per_file).partitionBy(by).csv(f"{root.rstrip('/')}/{name}")


def write_subset(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Filtered rows as Parquet with ZSTD; one file only on request, as it is one task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("compression", "zstd").parquet(path)
