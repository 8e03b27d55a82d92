"""Column expressions used by the operators."""

from .numeric import forecast_error, horizontal_max, horizontal_min, round2
from .temporal import (day_diff, day_of, epoch_seconds, local_to_utc, truncate_minute)
from .text import first_token, two_decimals

__all__ = [
    "day_diff", "day_of", "epoch_seconds", "first_token", "forecast_error",
    "horizontal_max", "horizontal_min", "local_to_utc", "round2", "truncate_minute",
    "two_decimals",
]
