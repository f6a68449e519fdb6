"""gustgrid: wind-field analytics on Spark DataFrames."""

from gustgrid.params import InterpolationParams
from gustgrid.session import configure

__all__ = ["InterpolationParams", "configure"]
