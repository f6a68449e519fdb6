"""Alignment and error metrics of predicted against observed series.

Every metric is one aggregation with map-side combine, so a station with most of the rows is no
bottleneck. Two signs of bias exist on purpose: interpolation scores use observed minus predicted,
station comparisons predicted minus observed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gustgrid.functions.wind import circular_diff, is_finite

# Compared variables and the labels used in reports.
COMPONENTS = (
    ("Wind speed (m/s)", "wind_speed_pred", "wind_speed_obs"),
    ("U component (m/s)", "u_pred", "u_obs"),
    ("V component (m/s)", "v_pred", "v_obs"),
)


def align_series(predictions: DataFrame, observations: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Inner join on exact time; duplicates multiply, nothing is matched approximately."""
    return predictions.join(observations, [*keys, ts])


def _rmse(err: Column) -> Column:
    return F.sqrt(F.avg(err * err))


def cv_score(predicted: DataFrame, by: Sequence[str], obs: str = "obs", pred: str = "pred") -> DataFrame:
    """RSR (rmse over sample deviation) and bias (observed minus predicted).

    A missing prediction makes the score NULL, as an unusable model should not win.
    """
    o, p = F.col(obs), F.col(pred)
    complete = F.count(p) == F.count(F.lit(1))
    err = o - p
    return predicted.groupBy(*by).agg(
        F.when(complete, _rmse(err) / F.nullif(F.stddev_samp(o), F.lit(0.0))).alias("rsr"),
        F.when(complete, F.avg(err)).alias("bias"),
    )


def component_metrics(aligned: DataFrame, keys: Sequence[str]) -> DataFrame:
    """RMSE, RSR, bias and sample count per variable; no finite pair gives NULLs and 0."""
    pairs = F.array(*(
        F.struct(F.lit(label).alias("variable"), F.col(p).alias("p"), F.col(o).alias("o")) for label, p, o in COMPONENTS
    ))
    ok = is_finite(F.col("p")) & is_finite(F.col("o"))
    err, obs = F.when(ok, F.col("p") - F.col("o")), F.when(ok, F.col("o"))
    rmse = _rmse(err)
    return (
        aligned.select(*keys, F.inline(pairs))
        .groupBy(*keys, "variable")
        .agg(
            rmse.alias("rmse"), (rmse / F.nullif(F.stddev_samp(obs), F.lit(0.0))).alias("rsr"),
            F.avg(err).alias("bias"), F.count(err).alias("samples"),
        )
    )


def speed_metrics(aligned: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Speed and direction errors of each key in one pass."""
    p, o = F.col("wind_speed_pred"), F.col("wind_speed_obs")
    ok = is_finite(p) & is_finite(o)
    p, o = F.when(ok, p), F.when(ok, o)
    err = p - o
    n = F.count(err)
    spread = F.stddev_pop(err)
    return aligned.groupBy(*keys).agg(
        n.alias("samples"),
        _rmse(err).alias("rmse_speed"),
        F.avg(F.abs(err)).alias("mae_speed"),
        F.avg(err).alias("bias_speed"),
        (F.covar_pop(p, o) / F.nullif(F.stddev_pop(p) * F.stddev_pop(o), F.lit(0.0))).alias("corr_speed"),
        (1.0 - F.sum(err * err) / F.nullif(F.var_pop(o) * n, F.lit(0.0))).alias("r2_speed"),
        (spread / F.nullif(F.avg(F.abs(o)), F.lit(0.0))).alias("si_speed"),
        (spread / F.nullif(F.max(F.abs(o)), F.lit(0.0))).alias("si_speed_max"),
        *direction_aggregates(),
    )


def direction_aggregates() -> list[Column]:
    """Mean, mean absolute and rms angle between directions (degrees), and vector correlation."""
    p, o = F.col("wind_dir_pred"), F.col("wind_dir_obs")
    d = F.when(is_finite(p) & is_finite(o), circular_diff(p, o))
    real, imag = F.avg(F.cos(d)), F.avg(F.sin(d))
    return [
        F.degrees(F.avg(d)).alias("eam_dir"),
        F.degrees(F.avg(F.abs(d))).alias("eaam_dir"),
        F.degrees(_rmse(d)).alias("rmse_dir"),
        F.sqrt(real * real + imag * imag).alias("compcorr_dir"),
    ]


def direction_metrics(aligned: DataFrame, keys: Sequence[str]) -> DataFrame:
    return aligned.groupBy(*keys).agg(*direction_aggregates())


def union_metrics(*frames: DataFrame) -> DataFrame:
    """Stack metric tables; columns a table lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
