"""Catalog tables over hourly datasets, subsets and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from gustgrid.functions.geometry import in_region, rings_from_wkt, wkb_point, wkt_point
from gustgrid.functions.text import item_id, plot_component, plot_type, plot_variant, sidecar_path
from gustgrid.functions.times import parse_timestamp, partition_end, partition_start
from gustgrid.operators.regions import LAT_NAMES, LON_NAMES, first_present, points_in_polygon

# Columns that may hold the time of a row, by priority.
TIME_COLUMNS = (("timestamp",), ("datetime",), ("time",), ("date",), ("start_datetime", "end_datetime"))
# Columns every published dataset promotes, and columns it no longer should have.
PROMOTED = (
    "date", "hour", "timestamp", "input_count", "interpolated_count",
    *(f"{a}_{b}_{v}" for v in "uv" for a in ("cv", "test") for b in ("model", "rsr", "bias")),
    "kriging_var_u", "kriging_var_v", "nearest_distance_km", "neighbors_used", "interpolation_source",
    *(f"vgm_{b}_{v}" for v in "uv" for b in ("model", "range", "sill", "nugget")),
)
DEPRECATED = ("nc_proj_string", "cv_all", "test_metrics", "regions", "test_points", "source_url")


def _time_aggregates(df: DataFrame, path: str) -> tuple[list[Column], Column, Column]:
    """Aggregates per usable time column, and start and end picked from them by priority."""
    aggs, lows, highs = [], [], []
    for i, names in enumerate(c for c in TIME_COLUMNS if set(c) <= set(df.columns)):
        aggs += [F.min(_as_time(df, names[0])).alias(f"_lo{i}"), F.max(_as_time(df, names[-1])).alias(f"_hi{i}")]
        both = F.col(f"_lo{i}").isNotNull() & F.col(f"_hi{i}").isNotNull()
        lows.append(F.when(both, F.col(f"_lo{i}")))
        highs.append(F.when(both, F.col(f"_hi{i}")))
    return aggs, F.coalesce(*lows, partition_start(F.col(path))), F.coalesce(*highs, partition_end(F.col(path)))


def time_bounds(df: DataFrame, path: str = "path") -> DataFrame:
    """First and last time per file, from the first time column with any readable value.

    Files without one fall back to the hour their partition path names.
    """
    aggs, start, end = _time_aggregates(df, path)
    rows = df.groupBy(path).agg(*aggs) if aggs else df.select(path).distinct()
    return rows.select(path, start.alias("start_datetime"), end.alias("end_datetime"))


def _as_time(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    return parse_timestamp(F.col(name)) if isinstance(kind, T.StringType) else F.col(name).cast("timestamp")


def file_items(df: DataFrame, path: str = "path") -> DataFrame:
    """One row per data file: id of its hour, box, time range, rows, model. One scan of the needed columns.

    ``df`` is a dataset with the file of each row in ``path`` (``_metadata.file_path``).
    """
    lon, lat = first_present(df, LON_NAMES), first_present(df, LAT_NAMES)
    model = F.min("source_model") if "source_model" in df.columns else F.lit(None).cast("string")
    boxes = [
        (agg(c).cast("double") if c else F.lit(None).cast("double")).alias(n)
        for n, agg, c in (("min_lon", F.min, lon), ("min_lat", F.min, lat), ("max_lon", F.max, lon), ("max_lat", F.max, lat))
    ]
    aggs, start, end = _time_aggregates(df, path)
    return df.groupBy(path).agg(*boxes, F.count(F.lit(1)).alias("row_count"), model.alias("source_model"), *aggs).select(
        item_id(F.col(path)).alias("item_id"), path, "min_lon", "min_lat", "max_lon", "max_lat",
        start.alias("start_datetime"), end.alias("end_datetime"), "row_count", "source_model",
    )


def merge_files(files: DataFrame) -> DataFrame:
    """One item per hour from rows of :func:`file_items`: ids are unique however many files an hour has.

    ``path`` is the first file; ``n_files`` counts them. Files outside hourly partitions are items of their own.
    """
    return files.groupBy("item_id").agg(
        F.min("path").alias("path"), F.min("min_lon").alias("min_lon"), F.min("min_lat").alias("min_lat"),
        F.max("max_lon").alias("max_lon"), F.max("max_lat").alias("max_lat"),
        F.min("start_datetime").alias("start_datetime"), F.max("end_datetime").alias("end_datetime"),
        F.sum("row_count").alias("row_count"), F.min("source_model").alias("source_model"), F.count(F.lit(1)).alias("n_files"),
    )


def catalog_items(df: DataFrame, path: str = "path") -> DataFrame:
    """One row per hour of a dataset with the file of each row in ``path``."""
    return merge_files(file_items(df, path).withColumnRenamed(path, "path"))


def scan_items(dataset: DataFrame) -> DataFrame:
    """Catalog items of a dataset read from files."""
    return catalog_items(dataset.withColumn("path", F.col("_metadata.file_path")))


def constant_column(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Value of a per-file constant (the smallest, if there are several) and whether it conflicts."""
    return df.groupBy(*keys).agg(F.min(column).alias(column), (F.min(column) != F.max(column)).alias("conflict"))


def stac_type(kind: T.DataType) -> str:
    if isinstance(kind, T.IntegralType):
        return "integer"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "number"
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return "date" if isinstance(kind, T.DateType) else "string"


def column_profile(df: DataFrame) -> DataFrame:
    """(name, n_rows, n_null, min_value, max_value) of each column in one aggregation; the extremes of numbers only."""
    aggs, rows = [F.count(F.lit(1)).alias("_rows")], []
    for i, f in enumerate(df.schema):
        number = isinstance(f.dataType, T.NumericType)
        value = F.col(f"`{f.name}`")
        aggs.append(F.count(value).alias(f"_n{i}"))
        if number:
            aggs += [F.min(value).cast("double").alias(f"_lo{i}"), F.max(value).cast("double").alias(f"_hi{i}")]
        low, high = (F.col(f"_{k}{i}") if number else F.lit(None).cast("double") for k in ("lo", "hi"))
        rows.append(F.struct(F.lit(f.name).alias("name"), F.col("_rows").alias("n_rows"), (F.col("_rows") - F.col(f"_n{i}")).alias("n_null"),
                             low.alias("min_value"), high.alias("max_value")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def column_catalog(df: DataFrame, descriptions: DataFrame | None = None) -> DataFrame:
    """(name, type, description) of each column; only the schema is read (see :func:`column_profile` for values)."""
    spark = df.sparkSession
    rows = [(f.name, stac_type(f.dataType)) for f in df.schema]
    listed = spark.createDataFrame(rows, "name string, type string")
    default = F.format_string("%s column with values of type %s.", "name", "type")
    if descriptions is None:
        return listed.withColumn("description", default)
    return listed.join(descriptions, "name", "left").withColumn("description", F.coalesce("description", default))


def incremental_items(existing: DataFrame, found: DataFrame, years: Sequence[str] | None = None) -> DataFrame:
    """All existing items plus those found whose id is new.

    ``years`` limits the search: only ids of these years are compared and added, and existing items
    of other years stay as they are.
    """
    known = existing.select("item_id")
    if years:
        in_years = F.substring("item_id", 1, 4).isin(*years)
        known, found = known.filter(in_years), found.filter(in_years)
    return existing.unionByName(found.join(known, "item_id", "left_anti"), allowMissingColumns=True)


def collection_extent(items: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Box, period and models of a whole catalog.

    A given start or end is part of the extent, and is the reported period.
    """
    given = [parse_timestamp(F.lit(v), strict=True) if v else F.lit(None).cast("timestamp") for v in (start, end)]
    low, high = F.least(F.min("start_datetime"), given[0]), F.greatest(F.max("end_datetime"), given[1])
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    return items.agg(
        F.min("min_lon").alias("min_lon"), F.min("min_lat").alias("min_lat"),
        F.max("max_lon").alias("max_lon"), F.max("max_lat").alias("max_lat"),
        F.date_format(low, iso).alias("extent_start"), F.date_format(high, iso).alias("extent_end"),
        F.date_format(F.coalesce(given[0], low), iso).alias("period_start"),
        F.date_format(F.coalesce(given[1], high), iso).alias("period_end"),
        # Models are few, whatever the number of items: each task sends each of its models once.
        F.concat_ws(",", F.sort_array(F.collect_set("source_model"))).alias("source_models"),
    )


def link_sidecars(items: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Items with the metadata document of their partition, NULL without one (``sidecars`` has ``path``)."""
    wanted = items.withColumn("_side", sidecar_path(F.col("path")))
    present = sidecars.select(F.col("path").alias("_side"), F.col("path").alias("describedby"))
    linked = wanted.join(present, "_side", "left").drop("_side")
    return linked.withColumn("metadata_id", F.when(F.col("describedby").isNotNull(), F.concat("item_id", F.lit("-metadata"))))


def link_plots(items: DataFrame, plots: DataFrame) -> DataFrame:
    """One row per (item, plot of its hour) with the plot's kind; ``plots`` has ``path``."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    kinds = plots.select(
        item_id(F.col("path")).alias("item_id"), name.alias("plot"),
        plot_type(name).alias("plot_type"), plot_component(name).alias("plot_component"), plot_variant(name).alias("plot_variant"),
    )
    return items.select("item_id").join(kinds, "item_id", "left")


def year_completeness(items: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """Cataloged and present files per year; complete when equal and above zero."""
    year = F.regexp_extract(path, r"year=(\d{4})", 1)
    have = items.groupBy(F.substring("item_id", 1, 4).alias("year")).agg(F.count(F.lit(1)).alias("cataloged"))
    want = files.groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("present"))
    cataloged, present = (F.coalesce(c, F.lit(0).cast("bigint")) for c in ("cataloged", "present"))
    return have.join(want, "year", "full_outer").select(
        "year", cataloged.alias("cataloged"), present.alias("present"), ((cataloged == present) & (present > 0)).alias("complete")
    )


def filter_nodes(df: DataFrame, node_ids: DataFrame, column: str = "node_id") -> DataFrame:
    """Rows whose node is listed; the list is de-duplicated and joined, not turned into a predicate."""
    ids = node_ids.select(F.trim(F.col(column).cast("string")).alias(column)).filter(F.col(column) != "").distinct()
    return df.join(ids, column, "left_semi")


def subset(df: DataFrame, node_ids: DataFrame | None = None, ring=None, x="lon", y="lat") -> DataFrame:
    """Rows matching every given filter; at least one is needed."""
    if node_ids is None and ring is None:
        raise ValueError("a subset needs node ids or a polygon")
    if ring is not None:
        df = points_in_polygon(df, ring, x, y)
    return df if node_ids is None else filter_nodes(df, node_ids)


def subset_geometry(df: DataFrame, region, node_ids: DataFrame | None = None, geometry: str = "geometry", geom_format: str = "wkb") -> DataFrame:
    """Rows whose point geometry lies in a region, and whose node is listed if a list is given.

    ``region`` is a POLYGON or MULTIPOLYGON text, or a list of rings; ``geom_format`` says how the geometry column holds
    its points: wkb (binary) or wkt (text). Rows without a readable point are in no region.
    """
    if geom_format not in ("wkb", "wkt"):
        raise ValueError("geom_format must be wkb or wkt")
    rings = rings_from_wkt(region) if isinstance(region, str) else region
    point = (wkb_point if geom_format == "wkb" else wkt_point)(F.col(geometry))
    # Generated, not projected: the tests then read the decoded numbers, where a projection would decode anew for each.
    placed = df.select("*", F.inline(F.array(F.struct(point[0].alias("_gx"), point[1].alias("_gy")))))
    kept = placed.filter(in_region(F.col("_gx"), F.col("_gy"), rings)).drop("_gx", "_gy")
    return kept if node_ids is None else filter_nodes(kept, node_ids)


def subset_summary(dataset: DataFrame, chosen: DataFrame, path: str = "path") -> DataFrame:
    """Rows kept, time range of all partitions, and time range of the partitions of kept rows."""
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"

    def span(df, prefix):
        start = partition_start(F.col(path))
        return df.agg(
            F.count(F.lit(1)).alias(f"{prefix}_rows"),
            F.date_format(F.min(start), iso).alias(f"{prefix}_start"), F.date_format(F.max(start), iso).alias(f"{prefix}_end"),
        )

    all_rows, kept = span(dataset, "dataset"), span(chosen, "subset")
    both = F.struct("subset_rows", "subset_start", "subset_end")
    return all_rows.withColumn("_k", kept.select(both).scalar()).select(
        "dataset_rows", "dataset_start", "dataset_end", "_k.subset_rows", "_k.subset_start", "_k.subset_end"
    )


def verify_columns(df: DataFrame) -> DataFrame:
    """Expected and deprecated columns with what the schema has."""
    have = set(df.columns)
    rows = [(c, "promoted", c in have) for c in PROMOTED] + [(c, "deprecated", c in have) for c in DEPRECATED]
    return df.sparkSession.createDataFrame(rows, "name string, kind string, present boolean")


def verify_dataset(df: DataFrame, keys: Sequence[str], sidecars: DataFrame | None = None) -> DataFrame:
    """Rows, columns and NULLs in promoted columns per key, in one pass; whether a sidecar exists."""
    promoted = [c for c in PROMOTED if c in df.columns]
    missing = sum((F.col(c).isNull().cast("int") for c in promoted), F.lit(0))
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"), F.sum(missing).alias("promoted_nulls"),
        F.lit(len(PROMOTED) - len(promoted)).alias("promoted_missing"),
        F.lit(sum(c in df.columns for c in DEPRECATED)).alias("deprecated_present"),
    )
    if sidecars is None:
        return out
    return out.join(sidecars.select(*keys, F.lit(True).alias("_s")).distinct(), list(keys), "left").select(
        *out.columns, F.coalesce("_s", F.lit(False)).alias("has_sidecar")
    )
