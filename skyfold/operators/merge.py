"""Forecast vs. observation merge (the ``merged`` table)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import day_diff, day_of, forecast_error

JOIN_KEYS = S.PLACE_KEYS + ["created_date_local"]

# Fixed value: pulls whose forecasts a task joins, so that what it sorts (their join with
# the observations too) stays small however many pulls there are.
PULLS_A_TASK = 50_000


def merge_forecast(forecast: DataFrame, current: DataFrame, pulls: int | None = None) -> DataFrame:
    """Left-join each forecast row to the observations of its pull day.

    The pull day is the date of the forecast's ``created_date_local``; the
    observation day is the date of ``last_updated``; they must be equal. So
    an observation of the day before midnight meets that day's pulls, and
    several pulls of a place on one day multiply rows; an upsert's rule for
    repeated keys decides about those. Forecasts without an observation
    keep null observation columns; the error is filled only for the pull
    day itself.

    Both sides shuffle on the join keys unless AQE finds the observation
    side under the broadcast threshold at run time. Where the sides carry
    their input order, the result has the forecast's, then the observation's.
    Of so many ``pulls`` that Spark's own number of tasks would leave each more than
    ``PULLS_A_TASK``, both sides are dealt to more tasks by the same shuffle.
    """
    ordered = "_order" in forecast.columns and "_order" in current.columns
    fc = forecast.select(
        *S.PLACE_KEYS,
        day_of("created_date_local").alias("created_date_local"),
        "created_date_utc",
        F.col("date").alias("forecast_date"),
        "uv",
        F.col("avgtemp_c").alias("forecast_avgtemp_c"),
        F.col("maxtemp_c").alias("forecast_maxtemp_c"),
        F.col("mintemp_c").alias("forecast_mintemp_c"),
        "daily_chance_of_rain",
        "daily_chance_of_snow",
        F.col("maxwind_kph").alias("forecast_maxwind_kph"),
        *([F.col("_order").alias("_forecast")] if ordered else []),
    )
    ob = current.select(
        *S.PLACE_KEYS,
        day_of("last_updated").alias("created_date_local"),
        F.col("last_updated").alias("current_temp_last_updated"),
        F.col("temp_c").alias("current_temp_c"),
        *([F.col("_order").alias("_observed")] if ordered else []),
    )
    tasks = -(-(pulls or 0) // PULLS_A_TASK)
    if tasks > forecast.sparkSession.sparkContext.defaultParallelism:
        fc, ob = fc.repartition(tasks, *JOIN_KEYS), ob.repartition(tasks, *JOIN_KEYS)
    merged = with_forecast_error(fc.join(ob, JOIN_KEYS, "left"))
    return merged.select(*S.columns(S.MERGED_SCHEMA),
                         *([F.struct("_forecast", "_observed").alias("_order")] if ordered else []))


def with_forecast_error(merged: DataFrame) -> DataFrame:
    """(Re)compute ``day_diff`` and ``forecast_current_temp_diff``."""
    dd = day_diff("forecast_date", "created_date_local")
    return merged.withColumns({
        "day_diff": dd,
        "forecast_current_temp_diff": forecast_error(dd, "current_temp_c", "forecast_avgtemp_c"),
    })
