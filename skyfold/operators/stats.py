"""Per-place statistics of one batch (the ``stats`` table)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import horizontal_max, horizontal_min, round2
from .means import grouped_means


def place_stats(merged: DataFrame, order: Column | None = None) -> DataFrame:
    """Min/max/mean forecast, first observation and hottest day per place.

    "First" means first in input order: the rows' own where they carry it,
    else the pull (its UTC instant, so two pulls of one day stay apart),
    the forecast date and the observation's time. The first observation keeps nulls. The hottest day is the pull day when
    the first observation reaches the highest forecast high, else the first
    forecast date carrying that high.

    One shuffle of partial rows on the place keys and the magnitude of the
    mean's values (usually one or two a place), then one of what is left of
    them, so a place holding a third of all rows sends few rows per partition.
    """
    if order is None:
        order = F.col("_order") if "_order" in merged.columns else F.struct("created_date_utc", "forecast_date", "current_temp_last_updated")
    m = merged.select(*S.PLACE_KEYS, "current_temp_c", "forecast_mintemp_c",
                      "forecast_maxtemp_c", "forecast_avgtemp_c", "created_date_local",
                      "forecast_date", order.alias("_ord"))
    hot = F.when(F.col("forecast_maxtemp_c").isNotNull(),
                 F.struct((-F.col("forecast_maxtemp_c")).alias("cold"), "_ord", "forecast_date"))
    g = grouped_means(
        m, S.PLACE_KEYS, {"mean_forecast": F.col("forecast_avgtemp_c")},
        first=[F.min(F.struct("_ord", "current_temp_c", "created_date_local")).alias("_first"),
               F.min("forecast_mintemp_c").alias("min_forecast"), F.max("forecast_maxtemp_c").alias("max_forecast"),
               F.min(hot).alias("_hot")],
        second=[F.min("_first").alias("_first"), F.min("min_forecast").alias("min_forecast"),
                F.max("max_forecast").alias("max_forecast"), F.min("_hot").alias("_hot")])
    g = g.select("*", F.col("_first.current_temp_c").alias("current_temp_c"),
                 F.col("_first.created_date_local").alias("_first_created"), F.col("_hot.forecast_date").alias("_hottest_forecast"),
                 round2("mean_forecast").alias("_mean"))
    hottest = F.when(F.col("current_temp_c") >= F.col("max_forecast"), F.col("_first_created")) \
        .otherwise(F.col("_hottest_forecast"))
    return g.select(
        *S.PLACE_KEYS, "current_temp_c", "min_forecast", "max_forecast", F.col("_mean").alias("mean_forecast"),
        hottest.alias("highest_temp_date"),
        horizontal_min("min_forecast", "current_temp_c").alias("min_temp"),
        horizontal_max("max_forecast", "current_temp_c").alias("max_temp"),
    )
