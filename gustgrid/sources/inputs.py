"""Test points, regions and work lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gustgrid.functions.geometry import ring_from_pairs
from gustgrid.functions.text import non_empty
from gustgrid.functions.times import partition_path

# Header aliases of test-point files.
POINT_NAMES = ("name", "test_point", "Name")
LON_ALIASES, LAT_ALIASES = ("lon", "longitude"), ("lat", "latitude")
# Public archives of the three model domains.
ARCHIVE = "https://mandeo.meteogalicia.es/thredds/fileServer/modelos"
MODELS = (
    ("wrf4km", f"{ARCHIVE}/WRF_HIST/d03", "wrf_arw_det_history_d03_%s_0000.nc4", "yyyy/MM"),
    ("wrf1_3km", f"{ARCHIVE}/WRF_ARW_1KM_HIST/d05", "wrf_arw_det1km_history_d05_%s_0000.nc4", "yyyy/MM"),
    ("wrf1km", f"{ARCHIVE}/WRF_ARW_1KM_HIST_Novo", "wrf_arw_det_history_d02_%s_0000.nc4", "yyyyMMdd"),
)


def points_from_rows(rows: DataFrame) -> DataFrame:
    """(name, lon, lat) of rows with any of the header aliases; bad rows are errors."""
    def alias(names: Sequence[str]) -> Column:
        # Column names are compared exactly: "name" and "Name" are different headers.
        found = [non_empty(F.col(f"`{n}`").cast("string")) for n in names if n in rows.columns]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    def number(names, what):
        value = alias(names).try_cast("double")
        return F.coalesce(value, F.raise_error(F.lit(f"test point without a valid {what}")).cast("double"))

    name = F.coalesce(alias(POINT_NAMES), F.raise_error(F.lit("test point without a name")).cast("string"))
    return rows.select(name.alias("name"), number(LON_ALIASES, "longitude").alias("lon"), number(LAT_ALIASES, "latitude").alias("lat"))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return points_from_rows(spark.read.option("header", True).csv(path))


def rings_from_geojson(texts: DataFrame, text: str = "value", name: Column | None = None, first_only: bool = False) -> DataFrame:
    """(region_name, feature, part, ring_no, ring) of GeoJSON documents: every ring of every polygon.

    ``feature``, ``part`` and ``ring_no`` count from 0; ring 0 of a part is its outer one, the others
    are holes. ``first_only`` gives one row per document, (region_name, ring): the outer ring of the
    first polygon of the first feature. A geometry without a polygon is an error.
    """
    doc = F.col(text)
    kind = F.get_json_object(doc, "$.type")
    features = F.when(
        kind == "FeatureCollection", F.from_json(doc, "features array<struct<geometry:string>>")["features"]["geometry"]
    ).otherwise(F.array(F.when(kind == "Feature", F.get_json_object(doc, "$.geometry")).otherwise(doc)))
    label = name if name is not None else F.get_json_object(doc, "$.name")
    shapes = texts.select(label.alias("region_name"), F.posexplode_outer(features).alias("feature", "_g"))
    shape, body = F.get_json_object("_g", "$.type"), F.get_json_object("_g", "$.coordinates")
    rings = "array<array<array<double>>>"
    parts = F.when(shape == "Polygon", F.array(F.from_json(body, rings))).when(shape == "MultiPolygon", F.from_json(body, f"array<{rings}>"))
    parts = F.when(F.size(parts) > 0, parts).otherwise(F.raise_error(F.lit("no polygon in GeoJSON")).cast(f"array<{rings}>"))
    if first_only:
        shapes = shapes.filter("coalesce(feature, 0) = 0")
    each = shapes.select("region_name", "feature", F.posexplode(parts).alias("part", "_p")).select(
        "region_name", "feature", "part", F.posexplode("_p").alias("ring_no", "_r"))
    if first_only:
        each = each.filter("part = 0 AND ring_no = 0")
    whole = F.when(F.size("_r") >= 3, F.col("_r")).otherwise(F.raise_error(F.lit("no polygon in GeoJSON")).cast("array<array<double>>"))
    kept = ["region_name"] if first_only else ["region_name", "feature", "part", "ring_no"]
    return each.select(*kept, ring_from_pairs(whole).alias("ring"))


def read_regions(spark: SparkSession, path: str, name: str | None = None, first_only: bool = False) -> DataFrame:
    """Regions of GeoJSON files (see :func:`rings_from_geojson`), named after the file unless a name is given."""
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
    texts = spark.read.text(path, wholetext=True)
    return rings_from_geojson(texts.select("value", stem.alias("_stem")), name=F.lit(name) if name else F.col("_stem"), first_only=first_only)


def model_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MODELS), "model string, base_url string, file_pattern string, folder_pattern string")


def source_manifest(ranges: DataFrame, models: DataFrame) -> DataFrame:
    """One archive URL per day of each (model, start_date, end_date); an inverted range is an error."""
    bad = F.raise_error(F.lit("end date before start date")).cast("date")
    end = F.when(F.col("end_date") >= F.col("start_date"), F.col("end_date")).otherwise(bad)
    days = F.sequence(F.col("start_date"), end, F.expr("INTERVAL 1 DAY"))
    folder = F.when(F.col("folder_pattern") == "yyyy/MM", F.date_format("day", "yyyy/MM")).otherwise(F.date_format("day", "yyyyMMdd"))
    file = F.replace(F.col("file_pattern"), F.lit("%s"), F.date_format("day", "yyyyMMdd"))
    return (
        ranges.join(models, "model")
        .withColumn("day", F.explode(days))
        .select("model", F.date_format("day", "yyyy-MM-dd").alias("date"), F.concat_ws("/", "base_url", folder, file).alias("url"))
    )


def hour_manifest(dates: DataFrame, hours: Sequence[int] = tuple(range(24))) -> DataFrame:
    """Expected (date, hour, partition path) of every date."""
    hour = F.explode(F.array(*(F.lit(f"{int(h):02d}") for h in hours)))
    y, m, d = (F.substring("date", a, n) for a, n in ((1, 4), (6, 2), (9, 2)))
    return dates.select("date").distinct().select("date", hour.alias("hour")).withColumn(
        "partition", partition_path(y, m, d, F.col("hour"))
    )


def missing_hours(expected: DataFrame, present: DataFrame) -> DataFrame:
    return expected.join(present.select("date", "hour").distinct(), ["date", "hour"], "left_anti")
