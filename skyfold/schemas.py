"""Schemas, upsert keys and column orders of the five tables.

The input record layout and the table layouts below are fixed values: they
must equal the reference job's, or results and saved files would differ.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Layout of one input record (a place's pull).
# Each leaf is one of the kinds "str", "float", "int", "bool", "date",
# "datetime"; a dict is a nested object, a one-element list an array of it.
# Every field is required.
# ---------------------------------------------------------------------------
CONDITION_SPEC = {"text": "str", "code": "int"}

LOCATION_SPEC = {
    "name": "str",
    "region": "str",
    "country": "str",
    "lat": "float",
    "lon": "float",
    "tz_id": "str",
    "localtime_epoch": "int",
    "localtime": "datetime",
}

CURRENT_SPEC = {
    "last_updated": "datetime",
    "temp_c": "float",
    "temp_f": "float",
    "is_day": "int",
    "condition": CONDITION_SPEC,
}

DAY_SPEC = {
    "maxtemp_c": "float",
    "maxtemp_f": "float",
    "mintemp_c": "float",
    "mintemp_f": "float",
    "avgtemp_c": "float",
    "avgtemp_f": "float",
    "maxwind_mph": "float",
    "maxwind_kph": "float",
    "totalprecip_mm": "float",
    "totalprecip_in": "float",
    "totalsnow_cm": "float",
    "avgvis_km": "float",
    "avgvis_miles": "float",
    "avghumidity": "float",
    "daily_will_it_rain": "bool",
    "daily_chance_of_rain": "int",
    "daily_will_it_snow": "bool",
    "daily_chance_of_snow": "int",
    "condition": CONDITION_SPEC,
    "uv": "float",
}

FORECAST_DAY_SPEC = {"date": "date", "date_epoch": "int", "day": DAY_SPEC}

RECORD_SPEC = {
    "location": LOCATION_SPEC,
    "current": CURRENT_SPEC,
    "forecast": {"forecastday": [FORECAST_DAY_SPEC]},
}

# Spark type of each leaf kind. Epoch fields are bigint, other ints int.
KIND_TYPES = {
    "str": T.StringType(),
    "float": T.DoubleType(),
    "int": T.IntegerType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "datetime": T.TimestampNTZType(),
}
BIGINT_FIELDS = ("localtime_epoch", "date_epoch")


def leaf_type(name: str, kind: str) -> T.DataType:
    if kind == "int" and name in BIGINT_FIELDS:
        return T.LongType()
    return KIND_TYPES[kind]


# ---------------------------------------------------------------------------
# Keys and column orders of the five output tables.
# ``created_date_utc`` holds the UTC wall-clock time as timestamp_ntz, so no
# result depends on the session time zone; files print it with "+0000".
# ---------------------------------------------------------------------------
PLACE_KEYS = ["name", "region", "country"]

LOCATION_KEYS = PLACE_KEYS
CURRENT_KEYS = PLACE_KEYS + ["created_date_local"]
FORECAST_KEYS = PLACE_KEYS + ["created_date_local", "date"]
MERGED_KEYS = PLACE_KEYS + ["created_date_local", "forecast_date"]
STATS_KEYS = PLACE_KEYS

LOCATION_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("tz_id", T.StringType()),
    T.StructField("localtime_epoch", T.LongType()),
    T.StructField("localtime", T.TimestampNTZType()),
])

CURRENT_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("created_date_local", T.TimestampNTZType()),
    T.StructField("created_date_utc", T.TimestampNTZType()),
    T.StructField("last_updated", T.TimestampNTZType()),
    T.StructField("temp_c", T.DoubleType()),
    T.StructField("temp_f", T.DoubleType()),
    T.StructField("is_day", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("code", T.IntegerType()),
])

_DAY_FIELDS = [
    (k, leaf_type(k, v)) for k, v in DAY_SPEC.items() if not isinstance(v, dict)
]
# condition text/code come before uv, as in the saved forecast table
_DAY_COLUMNS = [f for f in _DAY_FIELDS if f[0] != "uv"] + [
    ("text", T.StringType()), ("code", T.IntegerType()), ("uv", T.DoubleType())]

FORECAST_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("created_date_local", T.TimestampNTZType()),
        T.StructField("date", T.DateType()),
        T.StructField("created_date_utc", T.TimestampNTZType()),
        T.StructField("date_epoch", T.LongType()),
    ]
    + [T.StructField(n, t) for n, t in _DAY_COLUMNS]
)

MERGED_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("created_date_local", T.DateType()),
    T.StructField("created_date_utc", T.TimestampNTZType()),
    T.StructField("forecast_date", T.DateType()),
    T.StructField("current_temp_last_updated", T.TimestampNTZType()),
    T.StructField("current_temp_c", T.DoubleType()),
    T.StructField("uv", T.DoubleType()),
    T.StructField("forecast_avgtemp_c", T.DoubleType()),
    T.StructField("forecast_maxtemp_c", T.DoubleType()),
    T.StructField("forecast_mintemp_c", T.DoubleType()),
    T.StructField("day_diff", T.IntegerType()),
    T.StructField("forecast_current_temp_diff", T.DoubleType()),
    T.StructField("daily_chance_of_rain", T.IntegerType()),
    T.StructField("daily_chance_of_snow", T.IntegerType()),
    T.StructField("forecast_maxwind_kph", T.DoubleType()),
])

STATS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("current_temp_c", T.DoubleType()),
    T.StructField("min_forecast", T.DoubleType()),
    T.StructField("max_forecast", T.DoubleType()),
    T.StructField("mean_forecast", T.DoubleType()),
    T.StructField("highest_temp_date", T.DateType()),
    T.StructField("min_temp", T.DoubleType()),
    T.StructField("max_temp", T.DoubleType()),
])

TABLES = {
    "location": (LOCATION_SCHEMA, LOCATION_KEYS),
    "current_temp": (CURRENT_SCHEMA, CURRENT_KEYS),
    "forecast_temp": (FORECAST_SCHEMA, FORECAST_KEYS),
    "merged": (MERGED_SCHEMA, MERGED_KEYS),
    "stats": (STATS_SCHEMA, STATS_KEYS),
}


def columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
