"""Wind speed, direction and component expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Readings at or below this are "missing" in buoy records.
MISSING_AT_OR_BELOW = -9000.0
# Defaults of the logarithmic wind profile (metres).
SOURCE_HEIGHT, TARGET_HEIGHT, ROUGHNESS = 3.0, 10.0, 0.0002


def is_finite(c: Column) -> Column:
    """True for a value that is not NULL, NaN or infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def finite_or_null(c: Column) -> Column:
    return F.when(is_finite(c), c)


def uv_from_speed_dir(speed: Column, direction: Column) -> tuple[Column, Column]:
    """Components of a wind that blows *from* ``direction`` (degrees)."""
    rad = F.radians(F.pmod(direction, F.lit(360.0)))
    return -speed * F.sin(rad), -speed * F.cos(rad)


def speed_from_uv(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def dir_from_uv(u: Column, v: Column) -> Column:
    """Direction the wind blows from, in [0, 360)."""
    deg = F.degrees(F.atan2(-u, -v))
    return F.when(deg < 0, deg + 360.0).otherwise(deg)


def height_factor(source: Column, target: Column, roughness: Column) -> Column:
    """Ratio of the log profile at two heights; fails on parameters that give no finite ratio."""
    ok = is_finite(source) & is_finite(target) & is_finite(roughness)
    ratio = F.log(target / roughness) / F.log(source / roughness)
    return F.when(ok, ratio).otherwise(
        F.raise_error(F.lit("height correction needs finite heights and roughness")).cast("double")
    )


def height_correct(speed: Column, source=SOURCE_HEIGHT, target=TARGET_HEIGHT, roughness=ROUGHNESS) -> Column:
    """Move a wind speed from one height to another; NULL stays NULL.

    Plain numbers are checked here; columns (per-buoy plans) are checked row by row.
    """
    params = (source, target, roughness)
    if not any(isinstance(p, Column) for p in params):
        if not all(math.isfinite(p) and p > 0 for p in params):
            raise ValueError("height correction needs finite heights and roughness")
        return speed * F.lit(math.log(target / roughness) / math.log(source / roughness))
    return speed * height_factor(*(p if isinstance(p, Column) else F.lit(float(p)) for p in params))


def clean_sentinel(c: Column) -> Column:
    """NULL for sentinel readings."""
    return F.when(c > MISSING_AT_OR_BELOW, c)


def circular_diff(pred_deg: Column, obs_deg: Column) -> Column:
    """Signed smallest angle from ``obs`` to ``pred``, in radians."""
    d = F.radians(pred_deg) - F.radians(obs_deg)
    return F.atan2(F.sin(d), F.cos(d))
