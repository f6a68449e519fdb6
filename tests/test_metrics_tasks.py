import re

from gustgrid.sources.reports import write_metrics


def test_small_files_are_not_tasks(spark, tmp_path):
    """Files are as small as asked, but tasks (whose ranges are sampled on the driver) follow the rows."""
    write_metrics({"m": spark.range(4000).selectExpr("id", "CAST(id % 3 AS INT) AS buoy_id")}, str(tmp_path), rows_per_file=50)
    files = list(tmp_path.glob("m/buoy_id=*/*.csv"))
    sizes = [len(f.read_text().splitlines()) - 1 for f in files]
    assert sum(sizes) == 4000 and max(sizes) <= 50
    assert len({re.match(r"part-(\d+)", f.name)[1] for f in files}) == 1
