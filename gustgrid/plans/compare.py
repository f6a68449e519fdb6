"""Comparison of station observations with predictions, all stations in one job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gustgrid.functions.text import non_empty, slugify
from gustgrid.functions.times import in_window, parse_timestamp
from gustgrid.functions.wind import ROUGHNESS, SOURCE_HEIGHT, TARGET_HEIGHT, clean_sentinel, height_correct, uv_from_speed_dir
from gustgrid.operators.metrics import align_series, component_metrics, speed_metrics, union_metrics

# Entry fields of a plan file; each may be missing.
PLAN_FIELDS = (
    "id", "label", "name", "catalog", "buoy_catalog", "item_id", "item", "buoy_item", "node_id", "prediction_node_id",
    "output_subdir", "output_dir_name", "output_dir", "report_name", "prediction_path",
    "obs_start", "observation_start", "obs_end", "observation_end",
    "pred_start", "prediction_start", "pred_end", "prediction_end",
    "buoy_height_correction", "source_height", "obs_height", "target_height", "roughness",
)
# Texts read as "yes".
TRUE_TEXTS = ("1", "true", "yes", "on")
PLAN_SCHEMA = ", ".join(f"{f} string" for f in PLAN_FIELDS)


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a plan file: an array of objects, one object, or an object with ``buoys``."""
    text = spark.read.text(path, wholetext=True)
    wrapped = F.from_json("value", f"buoys array<struct<{PLAN_FIELDS[0]}:string>>")
    many = F.when(F.size(F.col("w.buoys")) > 0, F.get_json_object("value", "$.buoys")).when(
        F.substring(F.trim("value"), 1, 1) == "[", F.col("value")
    ).otherwise(F.concat(F.lit("["), "value", F.lit("]")))
    entry = "struct<" + ", ".join(f"{f}:string" for f in PLAN_FIELDS) + ">"
    return (
        text.withColumn("w", wrapped).withColumn("entries", F.from_json(many, f"array<{entry}>"))
        .select(F.posexplode("entries").alias("pos", "e")).select((F.col("pos") + 1).alias("idx"), "e.*")
    )


def buoy_plan(entries: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """One typed row per entry; each value falls back to its aliases, then to the defaults.

    An entry without a catalog, or without any prediction path, is an error.
    """
    d = dict(defaults or {})

    def first(*names, default: Column | None = None):
        tries = [non_empty(F.col(n)) for n in names] + ([default] if default is not None else [])
        return F.coalesce(*tries)

    def fallback(name, value=None):
        value = d.get(name, value)
        return F.lit(value).cast("string")

    def required(c: Column, what: str):
        problem = F.concat(F.lit("plan entry "), F.col("idx").cast("string"), F.lit(f" has no {what}"))
        return F.coalesce(c, F.raise_error(problem).cast("string"))

    numbered = F.concat(F.lit("buoy_"), F.lpad(F.col("idx").cast("string"), 2, "0"))
    label = first("label", "name", "id", default=numbered)
    slug = slugify(first("output_subdir", "output_dir_name", "id", default=label), numbered)
    correction = first("buoy_height_correction")
    return entries.select(
        slug.alias("buoy_id"), label.alias("label"),
        required(first("catalog", "buoy_catalog"), "catalog").alias("catalog"),
        first("item_id", "item", "buoy_item", default=label).alias("item_id"),
        first("node_id", "prediction_node_id", default=slug).alias("node_id"),
        required(first("prediction_path", default=fallback("prediction_path")), "prediction_path").alias("prediction_path"),
        first("output_dir", default=F.concat(fallback("output_dir", "reports"), F.lit("/"), slug)).alias("output_dir"),
        first("report_name", default=F.concat(slug, F.lit("_report.md"))).alias("report_name"),
        *(
            parse_timestamp(first(f"{short}_{end}", f"{full}_{end}"), strict=True).alias(f"{short}_{end}")
            for short, full in (("obs", "observation"), ("pred", "prediction")) for end in ("start", "end")
        ),
        F.coalesce(F.lower(correction).isin(*TRUE_TEXTS), F.lit(bool(d.get("buoy_height_correction", False)))).alias("corrected"),
        first("source_height", "obs_height", default=fallback("source_height", SOURCE_HEIGHT)).cast("double").alias("source_height"),
        first("target_height", default=fallback("target_height", TARGET_HEIGHT)).cast("double").alias("target_height"),
        first("roughness", default=fallback("roughness", ROUGHNESS)).cast("double").alias("roughness"),
    )


def load_observations(raw: DataFrame, plan: DataFrame) -> DataFrame:
    """Clean, windowed and optionally height-corrected observations of the planned buoys.

    ``raw`` has (item_id, ts, wind_speed, wind_dir).
    """
    speed, direction = (clean_sentinel(F.col(c).cast("double")) for c in ("wind_speed", "wind_dir"))
    rows = (
        raw.select("item_id", F.col("ts").cast("timestamp").alias("ts"), speed.alias("wind_speed"), direction.alias("wind_dir"))
        .dropna(subset=["ts", "wind_speed", "wind_dir"])
        .join(plan.select("item_id", "buoy_id", "obs_start", "obs_end", "corrected", "source_height", "target_height", "roughness"), "item_id")
        .filter(in_window(F.col("ts"), F.col("obs_start"), F.col("obs_end")))
    )
    moved = height_correct(F.col("wind_speed"), F.col("source_height"), F.col("target_height"), F.col("roughness"))
    rows = rows.withColumn("wind_speed", F.when(F.col("corrected"), moved).otherwise(F.col("wind_speed")))
    u, v = uv_from_speed_dir(F.col("wind_speed"), F.col("wind_dir"))
    return rows.select(
        "buoy_id", "ts", F.col("wind_speed").alias("wind_speed_obs"), F.col("wind_dir").alias("wind_dir_obs"),
        u.alias("u_obs"), v.alias("v_obs"),
    )


def load_predictions(raw: DataFrame, plan: DataFrame) -> DataFrame:
    """Predictions at the planned test points inside their windows.

    ``raw`` has (node_id, interpolation_source, timestamp text, wind_speed, wind_dir, u, v); the
    source filter reaches the Parquet scan.
    """
    return (
        raw.filter(F.col("interpolation_source") == "test_point")
        .select("node_id", parse_timestamp(F.col("timestamp")).alias("ts"), "wind_speed", "wind_dir", "u", "v")
        .join(plan.select("node_id", "buoy_id", "pred_start", "pred_end"), "node_id")
        .filter(in_window(F.col("ts"), F.col("pred_start"), F.col("pred_end")))
        .select(
            "buoy_id", "ts", F.col("wind_speed").cast("double").alias("wind_speed_pred"),
            F.col("wind_dir").cast("double").alias("wind_dir_pred"), F.col("u").alias("u_pred"), F.col("v").alias("v_pred"),
        )
    )


def annotate(metrics: DataFrame, plan: DataFrame) -> DataFrame:
    """Add the label and the heights a metric row refers to."""
    heights = plan.select(
        "buoy_id", F.col("label").alias("buoy_label"), F.col("corrected").alias("obs_height_correction"),
        F.col("source_height").alias("source_height_m"), F.col("target_height").alias("target_height_m"),
        F.col("roughness").alias("roughness_m"),
        F.when(F.col("corrected"), F.col("target_height")).otherwise(F.col("source_height")).alias("obs_height_m"),
    )
    return metrics.join(heights, "buoy_id")


def compare(observations: DataFrame, predictions: DataFrame, plan: DataFrame) -> DataFrame:
    """Speed and component metrics of every buoy, stacked as in a combined metrics table."""
    aligned = align_series(load_predictions(predictions, plan), load_observations(observations, plan), ["buoy_id"])
    speed = speed_metrics(aligned, ["buoy_id"]).withColumn("variable", F.lit("wind_speed"))
    return annotate(union_metrics(speed, component_metrics(aligned, ["buoy_id"])), plan)


def report_rows(metrics: DataFrame) -> DataFrame:
    """Table rows of the report as text: one row per metric row."""
    def fmt(c, digits=3):
        return F.coalesce(F.format_string(f"%.{digits}f", F.col(c)), F.lit("NA"))

    def safe(c, digits=3):
        return F.when(F.col(c).isNull(), "NA").otherwise(fmt(c, digits))

    speed = F.concat_ws(
        " | ", F.col("samples").cast("string"), *(safe(c) for c in ("rmse_speed", "mae_speed", "bias_speed")),
        safe("corr_speed", 4), safe("r2_speed", 4),
        *(safe(c) for c in ("si_speed", "si_speed_max", "eam_dir", "eaam_dir", "rmse_dir")), safe("compcorr_dir", 4),
    )
    component = F.concat_ws(" | ", "variable", safe("rmse"), safe("rsr"), safe("bias"), F.col("samples").cast("string"))
    body = F.when(F.col("variable") == "wind_speed", speed).otherwise(component)
    return metrics.select("buoy_id", "variable", F.concat(F.lit("| "), body, F.lit(" |")).alias("line"))


def report_windows(aligned: DataFrame) -> DataFrame:
    """Time window and number of matched rows of each buoy."""
    def stamp(c):
        return F.date_format(c, "yyyy-MM-dd HH:mm'Z'")

    return aligned.groupBy("buoy_id").agg(
        stamp(F.min("ts")).alias("first_ts"), stamp(F.max("ts")).alias("last_ts"), F.count(F.lit(1)).alias("matched")
    )
