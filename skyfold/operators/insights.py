"""Dashboard questions over the ``merged``, ``stats`` and ``location`` tables.

Every function answers for all places at once; ``city`` narrows to one
place name (the dashboard's selector). Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import first_token, two_decimals
from .means import grouped_means

# Order in which merged rows are read (the saved table's order),
# used to pick "the first row" among equal values.
ROW_ORDER = S.MERGED_KEYS


def _for_city(df: DataFrame, city) -> DataFrame:
    """``city`` is a place name (all regions of that name, like the dashboard)
    or a full (name, region, country) key."""
    if city is None:
        return df
    if isinstance(city, str):
        return df.where(F.col("name") == F.lit(city))
    cond = F.lit(True)
    for k, v in zip(S.PLACE_KEYS, city):
        cond = cond & (F.col(k) == F.lit(v))
    return df.where(cond)


def current_vs_forecast(merged: DataFrame) -> DataFrame:
    """Observation and forecast error on each pull's own day."""
    return merged.where(F.col("day_diff") == 0) \
        .select("name", "current_temp_c", "forecast_current_temp_diff")


def tile_count(merged: DataFrame) -> DataFrame:
    """Number of current-vs-forecast tiles (one row)."""
    return current_vs_forecast(merged).agg(F.count(F.lit(1)).alias("n_tiles"))


def extreme_row(merged: DataFrame, column: str, largest: bool) -> DataFrame:
    """First row (in saved-table order) holding the table-wide max or min.

    One aggregate, the least (sign * value, row order): each task sends one
    row. It ignores repeats, so Spark drops the merge's left join when the
    column comes from the forecast side.
    """
    rank = -F.col(column) if largest else F.col(column)
    best = F.min(F.struct(rank.alias("rank"), *ROW_ORDER, F.col(column).alias("value")))
    return merged.where(F.col(column).isNotNull()).agg(best.alias("best")).where("best is not null") \
        .select("best.name", F.col("best.value").alias(column))


def extreme_rows(merged: DataFrame, column: str, largest: bool) -> DataFrame:
    """Every row holding the table-wide max or min: one aggregate, joined back on its one value."""
    best = merged.agg((F.max if largest else F.min)(column).alias(column))
    return merged.join(best, column).select("name", "created_date_local", "forecast_date", column)


def hottest_current(merged):
    return extreme_row(merged, "current_temp_c", largest=True)


def coldest_current(merged):
    return extreme_row(merged, "current_temp_c", largest=False)


def highest_forecast(merged):
    return extreme_row(merged, "forecast_maxtemp_c", largest=True)


def lowest_forecast(merged):
    return extreme_row(merged, "forecast_mintemp_c", largest=False)


def latest_snapshot(merged: DataFrame, city=None) -> DataFrame:
    """Rows of each name's latest pull day.

    The latest day per name is a partially aggregated group-by (skew-safe),
    joined back on (name, day): the big side is spread by both columns.
    """
    m = _for_city(merged, city)
    latest = m.groupBy("name").agg(F.max("created_date_local").alias("created_date_local"))
    return m.join(latest, ["name", "created_date_local"], "left_semi")


def city_range(merged: DataFrame, city=None) -> DataFrame:
    """Forecast range series of the latest pull, per name."""
    snap = latest_snapshot(merged, city)
    return snap.select(
        "name",
        first_token("forecast_date").alias("forecast_day"),
        "forecast_mintemp_c", "forecast_maxtemp_c", "forecast_avgtemp_c",
        (F.col("forecast_maxtemp_c") - F.col("forecast_mintemp_c")).alias("range_c"),
    )


def city_detail(merged: DataFrame, stats: DataFrame, city=None) -> DataFrame:
    """Detail panel per place: hottest day, its high, mean forecast, uv, wind.

    The uv and wind means are over the place's latest pull; their display
    text has two decimals.
    """
    snap = latest_snapshot(merged, city)
    means = grouped_means(snap, S.PLACE_KEYS, {"uv_mean": F.col("uv"), "wind_mean": F.col("forecast_maxwind_kph")})
    st = _for_city(stats, city).select(*S.PLACE_KEYS, "highest_temp_date", "max_temp", "mean_forecast")
    out = st.join(means, S.PLACE_KEYS, "inner")
    return out.select(*out.columns,
                      two_decimals("uv_mean").alias("uv_text"),
                      two_decimals("wind_mean").alias("wind_text"))


def place_names(location: DataFrame) -> DataFrame:
    """Selector entries: every name, duplicates kept."""
    return location.select("name")


def stats_table(stats: DataFrame) -> DataFrame:
    """The full detail table."""
    return stats.select(*S.columns(S.STATS_SCHEMA))
