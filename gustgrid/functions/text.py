"""Text helpers: slugs, paths, plot names, overrides, item ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gustgrid.functions.times import partition_value

# Plot file names written next to the interpolated hours.
VARIOGRAM_PLOT = "^variogram_([uv])(_rkt)?_empirical_"
GRID_PLOT_PREFIX = "grid_points"


def non_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def slugify(value: Column, fallback: Column) -> Column:
    """Lower-case words joined by ``_``; the fallback replaces an empty input or an empty slug."""
    source = F.coalesce(non_empty(value), fallback)
    words = F.regexp_replace(source, "[^A-Za-z0-9]+", "_")
    return F.lower(F.coalesce(non_empty(F.btrim(words, F.lit("_"))), fallback))


def sidecar_path(file_path: Column) -> Column:
    """Metadata document that belongs to an hourly data file."""
    return F.regexp_replace(
        file_path,
        r"([^/]+)/(year=[^/]+/month=[^/]+/day=[^/]+/hour=[^/]+)/[^/]+$",
        "metadata/$1/$2/metadata.json",
    )


def sidecar_root(dataset_root: str) -> str:
    """Root of the metadata tree that is a sibling of a dataset."""
    root = dataset_root.rstrip("/")
    scheme, sep, rest = root.partition("://")
    if sep and "/" not in rest:
        return f"{root}/metadata"
    parent, _, name = root.rpartition("/")
    return f"{parent}/metadata/{name}" if parent or root.startswith("/") else f"metadata/{name}"


def plot_type(name: Column) -> Column:
    low = F.lower(name)
    return F.when(low.startswith(GRID_PLOT_PREFIX), "grid-mesh").when(low.rlike(VARIOGRAM_PLOT), "variogram")


def plot_component(name: Column) -> Column:
    return non_empty(F.regexp_extract(F.lower(name), VARIOGRAM_PLOT, 1))


def plot_variant(name: Column) -> Column:
    low = F.lower(name)
    return F.when(
        low.rlike(VARIOGRAM_PLOT),
        F.when(F.regexp_extract(low, VARIOGRAM_PLOT, 2) != "", "regression-kriging").otherwise("ordinary-kriging"),
    )


def item_id(path: Column) -> Column:
    """``YYYYMMDDTHH`` of a fully partitioned path, else the file stem in lower case."""
    y, m, d, h = (partition_value(path, k) for k in ("year", "month", "day", "hour"))
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"(.)\.[^.]*$", "$1")
    return F.coalesce(F.concat(y, m, d, F.lit("T"), h), F.lower(F.translate(stem, ".", "-")))


def merge_json_maps(base: Column, override: Column) -> Column:
    """Deep merge of a map of maps: keys of ``override`` win, nested keys are merged one by one."""
    merged = F.map_zip_with(
        base,
        override,
        lambda k, b, o: F.when(b.isNull(), o).when(o.isNull(), b).otherwise(
            F.map_concat(F.map_filter(b, lambda kk, _: ~F.map_contains_key(o, kk)), o)
        ),
    )
    return F.coalesce(merged, base, override)
