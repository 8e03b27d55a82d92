"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .temporal import _col

def round2(c) -> Column:
    """Round to two decimals by scaling first: round(x * 100) / 100.

    ``round(x, 2)`` would round the decimal text of x (1.005 -> 1.01); the
    scaled form rounds the binary value (1.005 -> 1.0), like the reference.
    """
    return F.round(_col(c) * 100, 0) / 100


def forecast_error(day_diff, observed, forecast) -> Column:
    """Observation minus forecast on the forecast's own day, else null."""
    return round2(F.when(_col(day_diff) == 0, _col(observed) - _col(forecast)))


def horizontal_min(*cols) -> Column:
    """Row-wise minimum that skips nulls."""
    return F.least(*[_col(c) for c in cols])


def horizontal_max(*cols) -> Column:
    """Row-wise maximum that skips nulls."""
    return F.greatest(*[_col(c) for c in cols])
