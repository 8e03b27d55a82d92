"""Display text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .temporal import _col


def first_token(c) -> Column:
    """Text before the first space ("2024-10-07 00:00" -> "2024-10-07").

    Typed dates and datetimes are printed as yyyy-MM-dd directly.
    """
    return F.split(_col(c).cast("string"), " ").getItem(0)


def two_decimals(c) -> Column:
    """Two-decimal text rounded on the exact binary value, half to even.

    Matches printf-style "%.2f" (0.125 -> "0.12", 1.005 -> "1.00"), which
    ``format_string`` does not.
    """
    return F.call_function("format_number", _col(c), F.lit("0.00"))
