"""Mixing sources to target weights by capped water-filling.

Weights share the total size. A source stops at ``max_epochs`` times its own size; what it cannot
take is shared again by weight among the others. The fixed point of clamping and sharing is a level
``L`` with target = min(cap, L * weight), found in one pass over the sources in order of cap / weight.

Each source then takes ``floor(target / size)`` whole repetitions of every document, and one more of
the documents that come first in a seeded hash order, until the rest of the target is met (a document
counts as met if its middle is). The running sums are cut into hash buckets, so a source with a third
of all rows is spread over ``BUCKETS`` groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BUCKETS = 4096
SIZE_SQL = r"CAST(coalesce(regexp_count({text}, '[^\\x20\\x09-\\x0D]+'), 0) AS BIGINT)"


def cyclic_weights(sizes: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, ... ``cycle``, repeating, over sources by code point, null last: one row a source."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return sizes.select("source", ((rank - 1) % cycle + 1).cast("double").alias("weight"))


def fill_targets(sizes: DataFrame, weights: DataFrame, max_epochs: float = 3.0) -> DataFrame:
    """(source, source_size, target) of (source, source_size) and (source, weight); one row a source."""
    w = weights.withColumnRenamed("source", "_ws")
    rows = sizes.join(w, F.col("source").eqNullSafe(F.col("_ws"))).selectExpr(
        "source", "source_size", "weight", f"CAST(source_size AS DOUBLE) * {float(max_epochs)!r}D AS cap")
    order = "ORDER BY cap / weight, source NULLS LAST"
    level = rows.selectExpr(
        "*", "CAST(sum(source_size) OVER () AS DOUBLE) AS total",
        f"coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0D) AS used",
        f"sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left",
    ).selectExpr("*", "(total - used) / left AS level")
    # Clamped sources come first in this order; the first one that is not has the largest level of the rest, and it holds for all of them.
    return level.selectExpr(
        "source", "source_size", "cap", "weight", "max(CASE WHEN level * weight < cap THEN level END) OVER () AS level",
    ).selectExpr("source", "source_size", "coalesce(least(cap, level * weight), cap) AS target")


def mix(docs: DataFrame, weights=cyclic_weights, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        max_epochs: float = 3.0, seed: str = "mix") -> DataFrame:
    """The input columns plus ``_size, _source_size, _target, _copies`` (columns of these names are replaced).

    ``weights`` makes (source, weight) from (source, source_size). A null or empty text has size 0; it
    is repeated like its neighbours in hash order. A null source is a source. Rows that repeat an id
    are ordered by size; equal rows get an equal key, so reruns give the same rows.
    """
    added = ["_size", "_source_size", "_target", "_copies", "_key", "_bucket", "_s", "_before", "_run"]
    kept = [c for c in docs.columns if c not in added]
    rows = docs.selectExpr(
        *[f"`{c}`" for c in kept], f"`{source_col}` AS _s", f"{SIZE_SQL.format(text=f'`{text_col}`')} AS _size",
        f"md5(concat('{seed}:', coalesce(CAST(`{id_col}` AS STRING), ''))) AS _key").withColumn("_bucket", F.expr("conv(left(_key, 3), 16, 10)").cast("int"))
    buckets = rows.groupBy("_s", "_bucket").agg(F.sum("_size").alias("_sum"))
    sizes = buckets.groupBy(F.col("_s").alias("source")).agg(F.sum("_sum").alias("source_size"))
    targets = fill_targets(sizes, weights(sizes), max_epochs).selectExpr("source AS _ts", "source_size AS _source_size", "target AS _target")
    before = Window.partitionBy("_s").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(F.col("_s").alias("_bs"), F.col("_bucket").alias("_bb"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    buckets = buckets.join(targets, F.col("_bs").eqNullSafe(F.col("_ts"))).drop("_ts")
    run = Window.partitionBy("_s", "_bucket").orderBy("_key", F.col(id_col), "_size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("_run", F.sum("_size").over(run)).join(
        buckets, F.col("_s").eqNullSafe(F.col("_bs")) & (F.col("_bucket") == F.col("_bb")))
    whole = "CASE WHEN _source_size > 0 THEN floor(_target / _source_size) ELSE 0 END"
    return found.selectExpr(
        *[f"`{c}`" for c in kept], "_size", "_source_size", "_target",
        f"CAST({whole} + CASE WHEN 2 * (_before + _run) - _size < 2 * (_target - ({whole}) * _source_size) THEN 1 ELSE 0 END AS BIGINT) AS _copies")
