"""Timestamp parsing, hour columns, windows and partition keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Accepted timestamp layouts, the usual one first (a failed try is not free).
TIMESTAMP_PATTERNS = (
    "yyyy-MM-dd['T'][ ]HH:mm:ss[.SSSSSS][.SSS][XXX]",
    "yyyy-MM-dd",
    "yyyyMMdd",
    "yyyyMMddHHmmss",
    "yyyy/MM/dd[ HH:mm:ss]",
)


def parse_timestamp(text: Column, strict: bool = False) -> Column:
    """Parse text in UTC; unparsable text is NULL, or an error when ``strict``."""
    parsed = F.coalesce(*(F.try_to_timestamp(F.trim(text), F.lit(p)) for p in TIMESTAMP_PATTERNS))
    if not strict:
        return parsed
    failure = F.raise_error(F.concat(F.lit("cannot parse timestamp: "), text)).cast("timestamp")
    return F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(failure)


def hour_columns(ts: Column) -> dict[str, Column]:
    """Date, hour, ISO stamp and the four partition keys of a timestamp, all as text."""
    return {
        "date": F.date_format(ts, "yyyy-MM-dd"),
        "hour": F.date_format(ts, "HH"),
        "timestamp": F.date_format(ts, "yyyy-MM-dd'T'HH':00:00Z'"),
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }


def in_window(ts: Column, start=None, end=None) -> Column:
    """Inclusive window; a missing (NULL) bound leaves that side open."""
    tests = []
    if start is not None:
        tests.append(F.coalesce(ts >= start, start.isNull()) if isinstance(start, Column) else ts >= F.lit(start))
    if end is not None:
        tests.append(F.coalesce(ts <= end, end.isNull()) if isinstance(end, Column) else ts <= F.lit(end))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def partition_value(path: Column, key: str) -> Column:
    """Text value of ``key=value`` in a path, NULL if the key is absent."""
    return F.nullif(F.regexp_extract(path, rf"(?:^|/){key}=([^/]+)", 1), F.lit(""))


def partition_start(path: Column) -> Column:
    """Start of the hour named by a partition path; NULL without a year or with bad values."""
    parts = {k: partition_value(path, k) for k in ("year", "month", "day", "hour")}
    text = F.concat(
        F.lpad(parts["year"], 4, "0"),
        *(F.lpad(F.coalesce(parts[k], F.lit(d)), 2, "0") for k, d in (("month", "1"), ("day", "1"), ("hour", "0"))),
    )
    return F.try_to_timestamp(text, F.lit("yyyyMMddHH"))


def partition_end(path: Column) -> Column:
    return partition_start(path) + F.expr("INTERVAL 1 HOUR")


def partition_path(year: Column, month: Column, day: Column, hour: Column) -> Column:
    return F.concat(
        F.lit("year="), year, F.lit("/month="), month, F.lit("/day="), day, F.lit("/hour="), hour
    )
