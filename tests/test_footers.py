"""Footers against scans: statistics, boxes, files that need a scan, and pruned reads."""

import json
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gustgrid.operators.catalog import file_items
from gustgrid.plans.registry_files import hourly_rows
from gustgrid.plans.views import Tables
from gustgrid.sources import footers
from gustgrid.sources.hours import scan_partitions, write_clustered

SF = "/root/testdata/sf0.001"


def write(root, hour, table, name="a.parquet", **options):
    folder = root / f"year=2024/month=01/day=02/hour={hour}"
    folder.mkdir(parents=True, exist_ok=True)
    pq.write_table(table, folder / name, **options)


def scanned(spark, root):
    return {r.path.rsplit("/", 2)[1] + r.path.rsplit("/", 1)[1]: r for r in file_items(scan_partitions(spark, str(root)).withColumn("path", F.expr("_metadata.file_path"))).collect()}


def from_footers(spark, root):
    return {r.path.rsplit("/", 2)[1] + r.path.rsplit("/", 1)[1]: r for r in footers.footer_files(spark, str(root)).collect()}


def test_footers_say_what_a_scan_says(spark, tmp_path):
    """Ordinary files, text without one layout, a column without statistics, NaN, only nulls, several row groups, no coordinates."""
    root = tmp_path / "winds"
    base = {"lon": [1.5, -2.0, None, 4.0], "lat": [40.0, 41.0, 42.0, 43.0], "timestamp": ["2024-01-02T00:10:00Z", "2024-01-02T00:20:00Z", "2024-01-02T00:00:00Z", None],
            "source_model": ["b", "a", "c", "a"]}
    write(root, "00", pa.table(base), row_group_size=1)
    write(root, "01", pa.table({**base, "timestamp": ["unknown", "2024-01-02T01:20:00Z", "2024-01-02T01:05:00Z", None]}))
    write(root, "02", pa.table(base), write_statistics=["lat"])
    write(root, "03", pa.table({**base, "lon": [float("nan"), 1.0, 2.0, 3.0]}))
    write(root, "04", pa.table({"lon": pa.array([None, None], pa.float64()), "lat": pa.array([None, None], pa.float64()), "timestamp": pa.array([None, None], pa.string()), "source_model": pa.array([None, None], pa.string())}))
    write(root, "05", pa.table({k: v[:0] for k, v in base.items()}, schema=pa.schema([("lon", pa.float64()), ("lat", pa.float64()), ("timestamp", pa.string()), ("source_model", pa.string())])))
    want, got = scanned(spark, root), from_footers(spark, root)
    # An empty file has no rows, so a scan does not see it; its footer does.
    empty = got.pop("hour=05a.parquet")
    assert empty.row_count == 0 and empty.min_lon is None and str(empty.start_datetime) == "2024-01-02 05:00:00"
    assert set(got) == set(want)
    for name, row in want.items():
        for column in ("min_lon", "min_lat", "max_lon", "max_lat", "start_datetime", "end_datetime", "row_count", "source_model", "item_id"):
            # Footers leave NaN out of extremes, as missing values are NULL here.
            b = 3.0 if (name, column) == ("hour=03a.parquet", "max_lon") else getattr(row, column)
            assert getattr(got[name], column) == b, (name, column)
    assert [c.name for c in got["hour=00a.parquet"]["columns"]] == list(base)


def test_geo_entry_and_time_types(spark, tmp_path):
    root = tmp_path / "winds"
    geo = {"primary_column": "geometry", "columns": {"geometry": {"bbox": [-9.5, 41.0, 0.0, -8.0, 43.0, 9.0]}}}
    times = pa.array([1_704_153_600_000_000, 1_704_157_199_123_456], pa.timestamp("us", "UTC"))
    table = pa.table({"geometry": pa.array([b"x", b"y"]), "time": times})
    write(root, "06", table.replace_schema_metadata({"geo": json.dumps(geo)}))
    write(root, "07", pa.table({"geometry": pa.array([b"x"]), "datetime": pa.array([1_704_153_600_000_000_000], pa.timestamp("ns"))}).replace_schema_metadata({"geo": "{}"}))
    write(root, "08", pa.table({"start_datetime": ["2024-01-02 00:00:00"], "end_datetime": ["2024-01-02 03:00:00"]}))
    got = from_footers(spark, root)
    first = got["hour=06a.parquet"]
    assert (first.min_lon, first.min_lat, first.max_lon, first.max_lat, first.geometry_column) == (-9.5, 41.0, -8.0, 43.0, "geometry")
    assert str(first.start_datetime) == "2024-01-02 00:00:00" and str(first.end_datetime) == "2024-01-02 00:59:59.123456"
    assert got["hour=07a.parquet"].geometry_column is None and str(got["hour=07a.parquet"].end_datetime) == "2024-01-02 00:00:00"
    assert str(got["hour=08a.parquet"].end_datetime) == "2024-01-02 03:00:00"


def test_no_data_column_is_read(spark, tmp_path):
    root = tmp_path / "winds"
    write(root, "00", pa.table({"lon": [1.0], "lat": [2.0]}))
    plan = footers.read_footers(footers.list_files(spark, str(root)))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" not in plan and "content" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_a_broken_file_is_an_error(spark, tmp_path):
    (tmp_path / "x.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="[Pp]arquet"):
        footers.read_footers(footers.list_files(spark, str(tmp_path))).collect()


def test_pruned_read_opens_few_files(spark, tmp_path):
    root = str(tmp_path / "winds")
    rows = hourly_rows(Tables(spark, SF))
    write_clustered(rows, root, ["lon", "lat"], rows_per_file=20)
    zones = footers.footer_files(spark, root).cache()
    box = (-9.0, 42.0, -8.95, 42.02)
    near = F.expr(f"lon BETWEEN {box[0]} AND {box[2]} AND lat BETWEEN {box[1]} AND {box[3]}")
    some = footers.read_pruned(spark, root, zones, box=box)
    assert sorted(r.event_id for r in some.filter(near).collect()) == sorted(r.event_id for r in rows.filter(near).collect())
    assert 0 < len(some.inputFiles()) < zones.count() / 2
    early = footers.read_pruned(spark, root, zones, start="2024-01-01 00:00:00", end="2024-01-02 00:00:00")
    assert len(early.inputFiles()) < zones.count()
    with pytest.raises(ValueError):
        footers.read_pruned(spark, root, zones, box=(90, 0, 91, 1))
    assert footers.read_pruned(spark, root, zones, schema=rows.schema, box=(90, 0, 91, 1)).count() == 0


def test_files_stay_under_the_target(spark, tmp_path):
    """One key holds a third of all rows; equal positions do not hold a file together."""
    df = spark.range(3000).selectExpr("id", "CASE WHEN id < 1000 THEN '00' ELSE lpad(CAST(id % 24 AS STRING), 2, '0') END AS hour", "1.0D AS lon")
    root = str(tmp_path / uuid.uuid4().hex)
    write_clustered(df, root, ["lon"], keys=["hour"], rows_per_file=100)
    sizes = [r.row_count for r in footers.read_footers(footers.list_files(spark, root)).collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 100
    back = spark.read.parquet(root)
    assert sorted(map(tuple, back.select("id", "hour").collect())) == sorted(map(tuple, df.select("id", "hour").collect()))
