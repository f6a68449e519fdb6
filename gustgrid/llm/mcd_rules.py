"""Quality rules: minimum-covariance-determinant outliers per language and source.

Base rules count words, symbols, repeated lines and repeated 3-word windows. The method transforms
them to a vector per document and estimates a robust mean and covariance for each language and
source: from medians and median deviations, concentration steps keep the half of a group's rows
that lies nearest (by the group's quantile of Mahalanobis distance) and estimate again. Every step is
two aggregations over all groups at once, so a source with a third of all rows is summed by all
tasks. Groups of fewer than ``LEAST`` rows use their language's estimate, then that of all rows.
Variances have a floor, because most counts are zero in most documents.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from gustgrid.llm.common import steps
from gustgrid.llm.doc_stats import counts
from gustgrid.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Mean word length; log of symbols, and square roots of repeated lines and words, by words or lines.
VECTOR = {"x0": "word_chars / n_words", "x1": "ln(1 + 100D * n_symbols / n_words)", "x2": "sqrt(n_dup_lines / greatest(n_lines, 1))",
          "x3": "sqrt(n_repeat_words / n_words)"}
P = len(VECTOR)
# Smallest standard deviation of each coordinate that is told apart. Roots of shares end at 1, so theirs are small:
# CUTOFF * 0.08 ** 2 = 0.21 is the share of repeated lines or words that alone is too far from none.
FLOOR = [0.4, 0.5, 0.08, 0.08]
LEAST, STEPS, KEPT_SHARE, OUTLIER_P = 50, 5, 0.5, 1e-6


def _gamma_share(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function, by its series."""
    term = total = 1.0 / a
    n = a
    while term > total * 1e-16:
        n += 1.0
        term *= x / n
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a)) if x > 0 else 0.0


def chi2_share(x: float, df: int) -> float:
    return _gamma_share(df / 2.0, x / 2.0)


def chi2_quantile(share: float, df: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_share(mid, df) < share else (low, mid)
    return (low + high) / 2


# The covariance of the nearest half is too small by this factor for normal rows.
CONSISTENCY = KEPT_SHARE / chi2_share(chi2_quantile(KEPT_SHARE, P), P + 2)
CUTOFF = chi2_quantile(1.0 - OUTLIER_P, P)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [*BASE, "n_lines"]
    for batch in batches:
        for part in steps(batch, "text"):
            c = counts(part.column(3))
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *(pa.array(c[k]) for k in names)], ["id", "lang", "source", *names])


def _inverse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean and inverse covariance of each group row (g, n, means, the products' means)."""
    for batch in batches:
        n = batch.num_rows
        mean = np.array(batch.column(2).to_pylist(), float).reshape(n, P)
        cov = np.array(batch.column(3).to_pylist(), float).reshape(n, P, P) - mean[:, :, None] * mean[:, None, :]
        cov = cov * CONSISTENCY + np.diag(np.square(FLOOR))
        inverse = np.linalg.inv(cov).reshape(n, P * P)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(mean.tolist(), pa.list_(pa.float64())), pa.array(inverse.tolist(), pa.list_(pa.float64()))], ["g", "n", "mean", "inverse"])


DISTANCE = " + ".join(f"(x{i} - mean[{i}]) * inverse[{i * P + j}] * (x{j} - mean[{j}])" for i in range(P) for j in range(P))


def robust_estimates(rows: DataFrame) -> DataFrame:
    """(g, n, mean, inverse) of rows (g, x0, x1, ...): one small table row for each group."""
    xs = list(VECTOR)
    middle = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *(F.percentile_approx(x, 0.5, 1000).alias(f"m_{x}") for x in xs))
    spread = rows.join(stage(middle, "medians"), "g").groupBy("g", "n", *(f"m_{x}" for x in xs)).agg(
        *(F.percentile_approx(F.expr(f"abs({x} - m_{x})"), 0.5, 1000).alias(f"d_{x}") for x in xs))
    # 1.4826 median deviations are a standard deviation of normal rows.
    diagonal = ", ".join(
        f"1D / (pow(1.4826D * d_x{i}, 2) + {FLOOR[i] ** 2!r}D)" if i == j else "0D" for i in range(P) for j in range(P))
    params = stage(spread.selectExpr("g", "n", f"array({', '.join(f'm_{x}' for x in xs)}) AS mean", f"array({diagonal}) AS inverse"), "estimates")
    for _ in range(STEPS):
        far = rows.join(params, "g").selectExpr("g", "n", *xs, f"{DISTANCE} AS d2")
        limit = stage(far.groupBy("g").agg(F.percentile_approx("d2", KEPT_SHARE, 1000).alias("limit")), "limits")
        near = far.join(limit, "g").filter("d2 <= limit")
        sums = near.groupBy("g", "n").agg(
            F.array(*(F.avg(x) for x in xs)).alias("mean"), F.array(*(F.avg(F.expr(f"{x} * {y}")) for x in xs for y in xs)).alias("products"))
        params = stage(sums.mapInArrow(_inverse_batches, "g string, n long, mean array<double>, inverse array<double>"), "estimates")
    return params


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document row: ``id_col``, the base counts, ``base_failed, distance, kept``.

    Documents that fail the base rules take no part in the estimates and have no distance. Null and
    empty texts have no words and fail. Null languages and sources are groups of their own.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    stats = rows.mapInArrow(_count_batches, f"id {kind}, lang string, source string, {', '.join(f'{c} long' for c in BASE)}, n_lines long")
    stats = stats.selectExpr("*", "n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed")
    # Group names: whole table, language, language and source; lengths keep any two apart.
    part = "concat(length({c}), ':', {c})"
    lang, source = (f"coalesce({part.format(c=c)}, 'null')" for c in ("lang", "source"))
    stats = stage(stats.selectExpr("*", f"array('all', concat('l', {lang}), concat('s', {lang}, {source})) AS gs"), "counts")
    good = stats.filter("NOT base_failed").selectExpr("explode(gs) AS g", *(f"CAST({e} AS DOUBLE) AS {x}" for x, e in VECTOR.items()))
    params = robust_estimates(good)
    names = stats.select("gs").distinct()
    level = [params.selectExpr(f"g AS g{k}", f"n AS n{k}", f"mean AS mean{k}", f"inverse AS inverse{k}") for k in range(3)]
    chosen = names.selectExpr("gs", "gs[0] AS g0", "gs[1] AS g1", "gs[2] AS g2")
    for k in range(3):
        chosen = chosen.join(level[k], f"g{k}", "left")
    pick = "CASE WHEN n2 >= {n} THEN {c}2 WHEN n1 >= {n} THEN {c}1 ELSE {c}0 END AS {c}"
    chosen = stage(chosen.selectExpr("gs", *(pick.format(n=LEAST, c=c) for c in ("mean", "inverse"))), "chosen")
    out = stats.join(chosen, "gs", "left").selectExpr("*", *(f"CASE WHEN n_words > 0 THEN CAST({e} AS DOUBLE) END AS {x}" for x, e in VECTOR.items()))
    return out.selectExpr(f"id AS {id_col}", *BASE, "base_failed", f"CASE WHEN NOT base_failed THEN {DISTANCE} END AS distance").selectExpr(
        "*", f"NOT base_failed AND distance <= {CUTOFF!r}D AS kept")
