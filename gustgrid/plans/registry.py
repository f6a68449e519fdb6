"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gustgrid.plans import registry_columns, registry_fields, registry_files, registry_kriging  # noqa: F401 (each fills the registry)
from gustgrid.plans.registry_columns import ORACLES, QUERIES
from gustgrid.plans.views import Tables
from gustgrid.session import configure


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(Tables(configure(spark), sf_dir))

    return {name: bind(fn) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
