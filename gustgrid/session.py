"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. Skewed join partitions are split by AQE even where
# that costs one more shuffle, because one hour or cell may hold a large share of all rows.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
}

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``, or a temporary one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="gustgrid-")
    return _local_dirs[app]


def stage_path(spark: SparkSession, label: str) -> str:
    """A new place in this application's part of the shared folder, which :func:`release_stages` deletes."""
    return f"{shared_dir(spark)}/gustgrid-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts lineage, so a lost executor only costs a re-read, and gives the planner the true
    size of the table: it is broadcast later only if it is under the broadcast threshold.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` for joins of two tables that both grow with the rows: they meet by shuffle and sort, however small the
    planner takes them for.

    Estimates come from compressed file sizes and do not count the rows that ``explode`` makes, so a table of many
    rows can look small enough to be collected and broadcast.
    """
    return df.hint("merge")


def release_stages(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; results that read them must be written first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/gustgrid-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
