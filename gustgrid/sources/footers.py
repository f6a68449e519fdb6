"""Parquet footers as tables: rows, columns, statistics and boxes of every file, without reading data.

Spark lists the files, tasks read the footers, and a row describes each file. Statistics say what a
scan of the column would say, or nothing: a column has them only if every row group with values of it
has, and a text time only if its extremes have one ISO layout. Files whose footers leave a needed
value open are scanned, the others never are.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gustgrid.functions.text import item_id
from gustgrid.functions.times import parse_timestamp, partition_end, partition_start
from gustgrid.operators.catalog import TIME_COLUMNS, file_items
from gustgrid.operators.regions import LAT_NAMES, LON_NAMES
from gustgrid.session import stage

# The footer functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATS = "struct<low:double,high:double,low_text:string,high_text:string,low_micros:bigint,high_micros:bigint>"
FOOTER_SCHEMA = (
    "path string, n_bytes bigint, row_count bigint, n_row_groups int, columns array<struct<name:string,type:string>>, "
    f"geometry_column string, geo_box array<double>, stats map<string,{STATS}>"
)
# Layouts of text times that sort as the times do.
SORTABLE_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|\+00:00)?)?$"
# Schemes that file systems of other libraries know by another name.
SCHEMES = {"s3a": "s3", "s3n": "s3", "dbfs": "file"}


def list_files(spark: SparkSession, root: str, globs: Sequence[str] = ("*.parquet", "*.geoparquet")) -> DataFrame:
    """(path, n_bytes) of the files under ``root`` that match a pattern, listed by Spark; their content is not read."""
    pattern = "{" + ",".join(globs) + "}"
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    return found.select("path", F.col("length").alias("n_bytes"))


def _opened(path: str):
    scheme, mark, rest = path.partition(":")
    uri = f"{SCHEMES.get(scheme, scheme)}:{rest}" if mark else path
    system, place = fs.FileSystem.from_uri(uri) if mark else (fs.LocalFileSystem(), path)
    return system.open_input_file(place)


def _kind(kind: pa.DataType) -> str:
    if pa.types.is_integer(kind):
        return "integer"
    if pa.types.is_floating(kind) or pa.types.is_decimal(kind):
        return "number"
    if pa.types.is_boolean(kind):
        return "boolean"
    if pa.types.is_timestamp(kind):
        return "datetime"
    return "date" if pa.types.is_date(kind) else "string"


def _merged_stats(meta: pq.FileMetaData, at: int, kind: pa.DataType) -> dict | None:
    """Extremes of a flat column over all row groups, None if some group with values has none."""
    low, high = None, None
    for g in range(meta.num_row_groups):
        column = meta.row_group(g).column(at)
        stats = column.statistics
        if stats is None or not stats.has_min_max:
            if column.num_values == 0 or stats is not None and stats.has_null_count and stats.null_count == column.num_values:
                continue
            return None
        low = stats.min if low is None else min(low, stats.min)
        high = stats.max if high is None else max(high, stats.max)
    out = dict.fromkeys(("low", "high", "low_text", "high_text", "low_micros", "high_micros"))
    if low is None:
        return out
    if pa.types.is_timestamp(kind):
        zone = pa.scalar(low).type.tz
        micros = [pa.scalar(v).cast(pa.timestamp("us", zone)).value for v in (low, high)]
        return {**out, "low_micros": micros[0], "high_micros": micros[1]}
    if pa.types.is_integer(kind) or pa.types.is_floating(kind):
        return {**out, "low": float(low), "high": float(high)}
    return {**out, "low_text": str(low), "high_text": str(high)} if pa.types.is_string(kind) or pa.types.is_date(kind) else None


def _geo(meta: dict) -> tuple[str | None, list[float] | None]:
    """Primary geometry column and its box of a ``geo`` entry; a box without four numbers does not count."""
    try:
        geo = json.loads(meta.get(b"geo") or b"null")
        name = geo["primary_column"]
        box = (geo.get("columns") or {}).get(name, {}).get("bbox")
        half = len(box) // 2 if box else 0
        return name, [float(box[0]), float(box[1]), float(box[half]), float(box[half + 1])] if half >= 2 else None
    except (ValueError, TypeError, KeyError, AttributeError):
        return None, None


def describe(path: str) -> dict:
    """The footer of one file."""
    with _opened(path) as source:
        file = pq.ParquetFile(source)
        meta, schema = file.metadata, file.schema_arrow
    places = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
    name, box = _geo(schema.metadata or {})
    stats = {f.name: _merged_stats(meta, places[f.name], f.type) for f in schema if f.name in places}
    return {
        "row_count": meta.num_rows, "n_row_groups": meta.num_row_groups, "columns": [{"name": f.name, "type": _kind(f.type)} for f in schema],
        "geometry_column": name, "geo_box": box, "stats": [(k, v) for k, v in stats.items() if v is not None],
    }


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, text, whole = pa.float64(), pa.string(), pa.int64()
    stats = pa.struct([("low", number), ("high", number), ("low_text", text), ("high_text", text), ("low_micros", whole), ("high_micros", whole)])
    schema = pa.schema([
        ("path", text), ("n_bytes", whole), ("row_count", whole), ("n_row_groups", pa.int32()),
        ("columns", pa.list_(pa.struct([("name", text), ("type", text)]))), ("geometry_column", text), ("geo_box", pa.list_(number)), ("stats", pa.map_(text, stats))])
    for batch in batches:
        rows = [{"path": path, "n_bytes": size, **describe(path)} for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_pylist(rows, schema)


def read_footers(files: DataFrame) -> DataFrame:
    """One row per file of ``files`` (path, n_bytes), see ``FOOTER_SCHEMA``; an unreadable file is an error.

    Files are dealt over all tasks, because listing puts many small names into few partitions.
    """
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path", "n_bytes").repartition(tasks, "path").mapInArrow(_read, FOOTER_SCHEMA)


def _stat(name: str) -> Column:
    return F.try_element_at(F.col("stats"), F.lit(name))


def _has(name: str) -> Column:
    return F.exists("columns", lambda c: c["name"] == name)


def _first(names: Sequence[str]) -> Column:
    """Statistics of the first of the columns that the file has; NULL if it has none of them or no statistics."""
    picked = F.lit(None).cast(STATS)
    for name in reversed(names):
        picked = F.when(_has(name), _stat(name)).otherwise(picked)
    return picked


def _times(pair: Sequence[str]) -> tuple[Column, Column, Column]:
    """First and last time of a time column (or a start and an end column), and whether the footer leaves them open."""
    low, high = _stat(pair[0]), _stat(pair[-1])
    sortable = F.lit(True)
    for s in (low, high):
        ends = [s["low_text"], s["high_text"]]
        alike = F.regexp_replace(ends[0], r"\d", "0").eqNullSafe(F.regexp_replace(ends[1], r"\d", "0"))
        sortable &= F.coalesce(ends[0].rlike(SORTABLE_TIME) & ends[1].rlike(SORTABLE_TIME) & alike, ends[0].isNull())
    start = F.coalesce(F.timestamp_micros(low["low_micros"]), parse_timestamp(low["low_text"]))
    end = F.coalesce(F.timestamp_micros(high["high_micros"]), parse_timestamp(high["high_text"]))
    return start, end, low.isNull() | high.isNull() | ~sortable


def footer_files(spark: SparkSession, root: str, footers: DataFrame | None = None) -> DataFrame:
    """The rows of :func:`~gustgrid.operators.catalog.file_items` from footers, with columns, size and geometry column.

    A box is that of the ``geo`` entry, else the extremes of the coordinate columns; times come from the first usable
    time column, else from the partition. Only files whose footers leave one of these open are scanned.
    """
    known = stage(footers if footers is not None else read_footers(list_files(spark, root)), "footers")
    lon, lat = _first(LON_NAMES), _first(LAT_NAMES)
    missing_box = F.col("geo_box").isNull() & (
        (F.greatest(*(_has(n) for n in LON_NAMES)) & lon.isNull()) | (F.greatest(*(_has(n) for n in LAT_NAMES)) & lat.isNull()))
    starts, ends, open_time, later = [], [], F.lit(False), F.lit(True)
    for pair in TIME_COLUMNS:
        there = F.lit(True)
        for n in pair:
            there &= _has(n)
        start, end, unknown = _times(pair)
        # A column counts if none before it gave a time.
        open_time |= later & there & unknown
        usable = there & start.isNotNull() & end.isNotNull()
        starts.append(F.when(usable, start))
        ends.append(F.when(usable, end))
        later &= ~usable
    model = _stat("source_model")
    scan = missing_box | open_time | (_has("source_model") & model.isNull())
    described = known.select(
        item_id(F.col("path")).alias("item_id"), "path",
        F.coalesce(F.get("geo_box", F.lit(0)), lon["low"]).alias("min_lon"), F.coalesce(F.get("geo_box", F.lit(1)), lat["low"]).alias("min_lat"),
        F.coalesce(F.get("geo_box", F.lit(2)), lon["high"]).alias("max_lon"), F.coalesce(F.get("geo_box", F.lit(3)), lat["high"]).alias("max_lat"),
        F.coalesce(*starts, partition_start(F.col("path"))).alias("start_datetime"), F.coalesce(*ends, partition_end(F.col("path"))).alias("end_datetime"),
        "row_count", model["low_text"].alias("source_model"), "columns", "n_bytes", "geometry_column", scan.alias("scan"))
    # The names of the files to scan pass through the driver, as those of any scan do.
    paths = [r.path for r in described.filter("scan").select("path").toLocalIterator()]
    complete = described.filter("NOT scan").drop("scan")
    if not paths:
        return complete
    rows = spark.read.option("basePath", root).option("mergeSchema", True).parquet(*paths)
    scanned = file_items(rows.withColumn("path", F.expr("_metadata.file_path")))
    boxes = ("min_lon", "min_lat", "max_lon", "max_lat")
    boxed = known.select("path", F.col("geo_box").isNotNull().alias("boxed"))
    found = scanned.select("path", *(F.col(c).alias(f"found_{c}") for c in (*boxes, "start_datetime", "end_datetime", "source_model")))
    open_files = described.filter("scan").join(boxed, "path").join(found, "path", "left")
    filled = open_files.withColumns({c: F.when(F.col("boxed"), F.col(c)).otherwise(F.col(f"found_{c}")) for c in boxes}).withColumns(
        {c: F.coalesce(f"found_{c}", c) for c in ("start_datetime", "end_datetime", "source_model")})
    return complete.unionByName(filled.select(*complete.columns))


def footer_items(files: DataFrame) -> DataFrame:
    """One item per hour from :func:`footer_files`, with the columns that its files have."""
    return files.groupBy("item_id").agg(
        F.min("path").alias("path"), F.min("min_lon").alias("min_lon"), F.min("min_lat").alias("min_lat"),
        F.max("max_lon").alias("max_lon"), F.max("max_lat").alias("max_lat"),
        F.min("start_datetime").alias("start_datetime"), F.max("end_datetime").alias("end_datetime"),
        F.sum("row_count").alias("row_count"), F.min("source_model").alias("source_model"), F.count(F.lit(1)).alias("n_files"),
        # Bounded by the distinct columns of an hour, not by its files.
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("columns")))).alias("columns"),
    )


def prune_files(zones: DataFrame, box: Sequence[float] | None = None, start=None, end=None) -> DataFrame:
    """The files of a zone map that can hold rows of a box (min x, min y, max x, max y) and a period (timestamps, inclusive).

    A file without a box or times is kept.
    """
    tests = F.lit(True)
    if box is not None:
        x0, y0, x1, y1 = (F.lit(float(v)) for v in box)
        tests &= F.coalesce((F.col("max_lon") >= x0) & (F.col("min_lon") <= x1) & (F.col("max_lat") >= y0) & (F.col("min_lat") <= y1), F.lit(True))
    if start is not None:
        tests &= F.coalesce(F.col("end_datetime") >= F.lit(start).cast("timestamp"), F.lit(True))
    if end is not None:
        tests &= F.coalesce(F.col("start_datetime") <= F.lit(end).cast("timestamp"), F.lit(True))
    return zones.filter(tests)


def read_pruned(spark: SparkSession, root: str, zones: DataFrame, schema=None, **limits) -> DataFrame:
    """Rows of only those files of ``root`` that a zone map leaves for the limits of :func:`prune_files`.

    The caller filters the rows exactly. ``schema`` saves reading footers again and is needed if no file is left.
    """
    paths = [r.path for r in prune_files(zones, **limits).select("path").orderBy("path").toLocalIterator()]
    if not paths:
        if schema is None:
            raise ValueError("no file is left, and no schema was given")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", root)
    return (reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)).parquet(*paths)
