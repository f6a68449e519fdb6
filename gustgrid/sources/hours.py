"""Hourly partitioned datasets and their sidecar documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from gustgrid.functions.text import sidecar_root
from gustgrid.session import stage

HOUR_KEYS = ("year", "month", "day", "hour")
# Fields of a sidecar document.
REGION_TYPE = "struct<region_name:string,name:string,polygon:array<array<double>>>"
SIDECAR_SCHEMA = (
    "crs string, nc_proj_string string, projection string, proj4 string, proj4text string, proj4_string string, "
    f"source_url string, source_model string, region_name string, regions array<{REGION_TYPE}>, "
    "test_points array<struct<name:string,lon:double,lat:double>>, "
    "netcdf_attributes struct<global:map<string,string>,variables:map<string,map<string,string>>,dimensions:map<string,int>>, "
    "generated struct<script:string,timestamp:string>"
)


# Error conditions that mean "no such files"; any other analysis error is the caller's to see.
NO_FILES = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _no_files(e: AnalysisException) -> bool:
    return (e.getCondition() or "").startswith(NO_FILES)


def _read(spark: SparkSession, root: str, glob: str, place: str, schema=None) -> DataFrame | None:
    reader = spark.read.option("pathGlobFilter", glob).option("basePath", root)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    try:
        return reader.parquet(f"{root.rstrip('/')}/{place}" if place else root)
    except AnalysisException as e:
        if _no_files(e):
            return None
        raise


def scan_partitions(spark: SparkSession, root: str, date: str | None = None, hour: str | None = None, schema=None) -> DataFrame:
    """Rows of an hourly dataset; only the folders of ``date`` (YYYY-MM-DD) and ``hour`` are listed.

    Files with the legacy extension are used for hours that have no ordinary file. The four
    partition columns stay text. Without a ``schema`` the footers of the listed files are merged, which
    reads each of them; give one for a large dataset. Hours that have no files give no rows.
    """
    parts = dict(zip(HOUR_KEYS, date.split("-"))) if date is not None else {}
    if hour is not None:
        parts["hour"] = f"{int(hour):02d}"
    deepest = max((i for i, k in enumerate(HOUR_KEYS) if k in parts), default=-1)
    place = "/".join(f"{k}={parts.get(k, '*')}" for k in HOUR_KEYS[: deepest + 1])

    def both(at: str) -> tuple[DataFrame | None, DataFrame | None]:
        return _read(spark, root, "*.parquet", at, schema), _read(spark, root, "*.geoparquet", at, schema)

    main, legacy = both(place)
    if main is None and legacy is None and place:
        # Nothing there: no rows, if the dataset has files elsewhere.
        main, legacy = both("")
    if main is None and legacy is None:
        raise FileNotFoundError(f"no Parquet files under {root}")
    if main is not None and legacy is not None:
        only_legacy = legacy.join(main.select(*HOUR_KEYS).distinct(), list(HOUR_KEYS), "left_anti")
        main = main.unionByName(only_legacy, allowMissingColumns=True)
    df = main if main is not None else legacy
    for k, v in parts.items():
        df = df.filter(F.col(k) == v)
    return df


def nanos_to_timestamp(c):
    """Timestamp of a nanosecond count (files whose ``time`` has nanosecond precision)."""
    return F.timestamp_micros(F.floor(c / 1000).cast("bigint"))


def write_hourly(df: DataFrame, root: str, files_per_hour: int = 1) -> None:
    """Write partitions with snappy, replacing only the hours present in ``df``.

    ``files_per_hour`` spreads a large hour over several tasks and files. The number of tasks is
    given, because small partitions would else be merged and an hour's files with them.
    """
    keys, tasks = [F.col(k) for k in HOUR_KEYS], int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if files_per_hour > 1:
        keys.append(F.pmod(F.xxhash64(*(c for c in df.columns if c not in HOUR_KEYS)), F.lit(int(files_per_hour))))
        tasks *= int(files_per_hour)
    (
        df.repartition(tasks, *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy").partitionBy(*HOUR_KEYS).parquet(root)
    )


def write_clustered(df: DataFrame, root: str, order: Sequence[str] = (), keys: Sequence[str] = HOUR_KEYS, rows_per_file: int = 1_000_000, mode: str = "overwrite") -> None:
    """Write partitions in files of at most ``rows_per_file`` rows, each a narrow range of ``order`` (say, lon and lat).

    The rows are counted first, so the number of tasks follows the data, and dealt by ranges of the keys and ``order``:
    a key with a third of all rows is cut over a third of the tasks, light keys share one. Files of narrow ranges let
    readers skip most of them by their footers. Only the partitions present in ``df`` are replaced.
    """
    known = stage(df, "clustered")
    tasks = max(1, -(-known.count() // rows_per_file))
    by = [*(F.col(k) for k in keys), *(F.col(c) for c in order)]
    # A hash of the row breaks ties, so equal positions can be cut too.
    tie = F.xxhash64(*(F.col(f"`{f.name}`") for f in known.schema if not isinstance(f.dataType, T.MapType)))
    (
        known.repartitionByRange(tasks, *by, tie).sortWithinPartitions(*by).write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy").option("maxRecordsPerFile", rows_per_file).partitionBy(*keys).parquet(root)
    )


def read_sidecars(spark: SparkSession, dataset_root: str) -> DataFrame:
    """Sidecar documents of a dataset with their hour; no documents give an empty frame.

    A malformed document is an error when its row is read, never a row of NULLs.
    """
    try:
        return spark.read.schema(f"{SIDECAR_SCHEMA}, year string, month string, day string, hour string").option(
            "multiLine", True
        ).option("mode", "FAILFAST").json(sidecar_root(dataset_root))
    except AnalysisException as e:
        if not _no_files(e):
            raise
        return spark.createDataFrame([], f"{SIDECAR_SCHEMA}, year string, month string, day string, hour string")


def write_sidecars(docs: DataFrame, dataset_root: str, keys: Sequence[str] = HOUR_KEYS) -> None:
    """One JSON document per hour; columns other than the keys become its fields."""
    body = F.to_json(F.struct(*(c for c in docs.columns if c not in keys)))
    (
        docs.select(*keys, body.alias("value")).repartition(*keys).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("lineSep", "\n").partitionBy(*keys)
        .text(sidecar_root(dataset_root))
    )
