"""Incremental catalog as a file stream (C4).

New files are picked up once by the stream's checkpoint. The catalog table holds one row per file,
so an hour whose files arrive in several batches keeps them all; :func:`read_catalog` merges the
files of an hour to its item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gustgrid.operators.catalog import file_items, merge_files


def append_new_files(batch: DataFrame, catalog_path: str) -> None:
    """Append the files of a batch that the catalog table does not have (a batch may be replayed)."""
    spark = batch.sparkSession
    files = file_items(batch)
    if _exists(spark, catalog_path):
        files = files.join(spark.read.schema(files.schema).parquet(catalog_path).select("path"), "path", "left_anti")
    files.write.mode("append").parquet(catalog_path)


def read_catalog(spark: SparkSession, catalog_path: str) -> DataFrame:
    """Items of the catalog table, one per hour."""
    return merge_files(spark.read.parquet(catalog_path))


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def catalog_stream(spark: SparkSession, root: str, schema, catalog_path: str, checkpoint: str) -> StreamingQuery:
    """Catalog all files present now that earlier runs have not seen, then stop."""
    hours = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(root)
    return (
        hours.withColumn("path", F.col("_metadata.file_path")).writeStream
        .foreachBatch(lambda batch, _: append_new_files(batch, catalog_path))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
