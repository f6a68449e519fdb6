"""Deterministic exact-size samples and folds (M1-M3).

Rows are ordered by ``md5(seed:id)`` within their key. The exact rank of a row is found without
sorting a whole key in one task: rows are counted per leading hash digits, the counts are summed
up to the row's bucket, and only the rows of one bucket are sorted together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gustgrid.session import by_shuffle

# Leading hex digits of the hash that form a bucket: 16**3 buckets per key.
BUCKET_DIGITS = 3


def hash_order(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def hash_rank(df: DataFrame, keys: Sequence[str], id_col: str, seed: int, rank: str = "rank", total: str = "total") -> DataFrame:
    """Add the 1-based rank in hash order and the row count of each key."""
    keys = list(keys)
    hashed = df.withColumn("_h", hash_order(id_col, seed)).withColumn("_b", F.substring("_h", 1, BUCKET_DIGITS))
    # At most 16**BUCKET_DIGITS rows per key reach this window.
    per_key = Window.partitionBy(*keys)
    counts = (
        hashed.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(per_key.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
        .withColumn(total, F.sum("_n").over(per_key))
    )
    in_bucket = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy("_h", id_col))
    return (
        by_shuffle(hashed).join(counts, [*keys, "_b"])
        .withColumn(rank, F.col("_before") + in_bucket)
        .drop("_h", "_b", "_n", "_before")
    )


def sample_size(total: Column, pct: float) -> Column:
    return F.ceil(total * F.lit(float(pct)) / F.lit(100.0))


def holdout_split(df: DataFrame, keys: Sequence[str], id_col: str, test_pct: float = 10.0, seed: int = 123) -> DataFrame:
    """Add ``is_test``: true for exactly ``ceil(n * test_pct / 100)`` rows of each key."""
    return (
        hash_rank(df, keys, id_col, seed, "_r", "_t")
        .withColumn("is_test", F.col("_r") <= sample_size(F.col("_t"), test_pct))
        .drop("_r", "_t")
    )


def subsample(df: DataFrame, keys: Sequence[str], id_col: str, pct: float, seed: int = 124) -> DataFrame:
    """Keep exactly ``ceil(n * pct / 100)`` rows of each key."""
    return (
        hash_rank(df, keys, id_col, seed, "_r", "_t")
        .filter(F.col("_r") <= sample_size(F.col("_t"), pct))
        .drop("_r", "_t")
    )


def kfold(df: DataFrame, keys: Sequence[str], id_col: str, nfold: int, seed: int = 125) -> DataFrame:
    """Add a balanced ``fold`` number in ``[0, nfold)``."""
    return (
        hash_rank(df, keys, id_col, seed, "_r", "_t")
        .withColumn("fold", F.pmod(F.col("_r") - 1, F.lit(nfold)).cast("int"))
        .drop("_r", "_t")
    )
