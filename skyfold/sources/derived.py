"""Weather-shaped batches derived from the driver's ``events`` tables.

The test tables carry no weather, so each (user, day) of ``events`` is read
as one pull of one place:

* the place is user ``u<id>`` in nation ``id % 25`` and that nation's region;
* the pull time is the day's last event, floored to the minute;
* the observation is the day's last non-error event (``value`` as
  temperature); days with only errors have no observation;
* the pull forecasts the pull day and the two days after it from the
  day's lowest and highest value.

Everything is one aggregation of ``events`` by (user, day) — partial
aggregation map-side, so a user holding a third of all events still sends
one row per partition and day — plus broadcast joins with ``nation`` (25
rows) and ``region`` (5 rows), whose sizes are fixed by the TPC-H spec.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
import pytz
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import epoch_seconds, local_to_utc, truncate_minute
from ..functions.temporal import standard_first

# Fixed value: nations in the TPC-H nation table (a user's nation is id % 25).
NATIONS = 25

# Time zone of each region key 0..4.
REGION_ZONES = ("Africa/Johannesburg", "America/New_York", "Asia/Bangkok",
                "Europe/Paris", "Asia/Dubai")

# Condition code of each observed event type.
OBSERVED_CODES = {"click": 1000, "view": 1003, "purchase": 1063, "signup": 1183}

# Forecast condition text and code, rainy and dry.
RAIN_CONDITION = ("Patchy rain nearby", 1063)
DRY_CONDITION = ("Partly cloudy", 1003)

# Forecast horizon in days after the pull day, and the rain
# chance (percent of error events) from which rain is expected.
HORIZON_DAYS = (0, 1, 2)
RAIN_FROM_PERCENT = 25

# The two overlapping runs used by the upsert queries.
FIRST_RUN_BEFORE = dt.date(2024, 1, 20)
SECOND_RUN_FROM = dt.date(2024, 1, 15)


@dataclass
class Batch:
    """The three flat tables of one batch of pulls."""

    location: DataFrame
    current: DataFrame
    forecast: DataFrame
    pulls: int | None = None  # where known


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ntz_midnight(day: dt.date) -> Column:
    return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")


def _to_f(c: Column) -> Column:
    return c * F.lit(1.8) + F.lit(32.0)


def pulls(spark: SparkSession, sf_dir: str, first_day: dt.date | None = None,
          before_day: dt.date | None = None) -> DataFrame:
    """One row per (place, day): pull time, observation and forecast seed.

    ``first_day``/``before_day`` select a run's days; the filter is on
    ``ts`` so it reaches the parquet scan.
    """
    ev = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    # zone-free literals: a Python datetime would become a zoned timestamp
    if first_day is not None:
        ev = ev.where(F.col("ts") >= _ntz_midnight(first_day))
    if before_day is not None:
        ev = ev.where(F.col("ts") < _ntz_midnight(before_day))
    seen = "event_type <> 'error'"
    day = ev.groupBy("user_id", F.to_date("ts").alias("d")).agg(
        F.max("ts").alias("last_ts"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.count(F.lit(1)).alias("n"),
        F.expr("count(1) FILTER (WHERE event_type = 'error')").alias("n_err"),
        F.expr(f"max(ts) FILTER (WHERE {seen})").alias("obs_ts"),
        F.expr(f"max_by(value, event_id) FILTER (WHERE {seen})").alias("obs_value"),
        F.expr(f"max_by(event_type, event_id) FILTER (WHERE {seen})").alias("obs_type"),
    )
    nation = F.broadcast(_read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(_read(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    placed = (
        day.join(nation, (day.user_id % NATIONS) == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == region.r_regionkey)
    )
    return placed.select(
        "user_id", "d", "lo", "hi", "n", "n_err", "obs_ts", "obs_value", "obs_type",
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("name"),
        F.col("n_name").alias("region"),
        F.col("r_name").alias("country"),
        ((F.col("user_id") % 170).cast("double") - F.lit(84.5)).alias("lat"),
        (((F.col("user_id") * 37) % 360).cast("double") - F.lit(179.5)).alias("lon"),
        _region_zone("r_regionkey").alias("tz_id"),
        truncate_minute(F.col("last_ts")).alias("created_date_local"),
    ).withColumn("created_date_utc", local_to_utc("created_date_local", "tz_id"))


def _region_zone(region_key: str) -> Column:
    zone = F.lit(None).cast("string")
    for key, tz in reversed(list(enumerate(REGION_ZONES))):
        zone = F.when(F.col(region_key) == key, F.lit(tz)).otherwise(zone)
    return zone


def location_of(p: DataFrame) -> DataFrame:
    """Latest pull per place (the location table's grain is the place)."""
    g = p.groupBy("name", "region", "country", "tz_id", "lat", "lon").agg(
        F.max("created_date_local").alias("localtime"),
        F.max_by(epoch_seconds(F.col("created_date_utc")), F.col("created_date_local"))
        .alias("localtime_epoch"),
    )
    return g.select(*S.columns(S.LOCATION_SCHEMA))


def _current_cols(temp_shift: float = 0.0) -> list[Column]:
    """Observation columns of a pull row."""
    temp = F.col("obs_value") + F.lit(temp_shift) if temp_shift else F.col("obs_value")
    code = F.lit(None).cast("int")
    for kind, c in reversed(list(OBSERVED_CODES.items())):
        code = F.when(F.col("obs_type") == kind, F.lit(c)).otherwise(code)
    hour = F.hour("obs_ts")
    return [
        F.col("obs_ts").alias("last_updated"),
        temp.alias("temp_c"),
        _to_f(temp).alias("temp_f"),
        F.when((hour >= 6) & (hour <= 17), 1).otherwise(0).alias("is_day"),
        F.col("obs_type").alias("text"),
        code.alias("code"),
    ]


def current_of(p: DataFrame, temp_shift: float = 0.0) -> DataFrame:
    """Observations; days with only error events have none."""
    return p.where(F.col("obs_ts").isNotNull()).select(
        "name", "region", "country", "created_date_local", "created_date_utc",
        *_current_cols(temp_shift))


def _forecast_cols(h: Column, second_run: bool = False) -> list[Column]:
    """Forecast columns of a pull row for horizon ``h`` (date first)."""
    mx = F.col("hi") + h
    if second_run:
        mx = F.when(h != 1, mx + F.lit(1.0))
    mn = F.col("lo") - h
    avg = (F.col("lo") + F.col("hi")) / 2
    wind = (F.col("n") + h).cast("double")
    precip = F.col("n_err").cast("double") * F.lit(0.5)
    chance = F.expr("(100 * n_err) div n").cast("int")
    rain = chance >= RAIN_FROM_PERCENT
    date = F.date_add("d", h)
    return [
        date.alias("date"),
        (F.unix_date(date).cast("bigint") * 86400).alias("date_epoch"),
        mx.alias("maxtemp_c"), _to_f(mx).alias("maxtemp_f"),
        mn.alias("mintemp_c"), _to_f(mn).alias("mintemp_f"),
        avg.alias("avgtemp_c"), _to_f(avg).alias("avgtemp_f"),
        (wind / F.lit(1.609344)).alias("maxwind_mph"), wind.alias("maxwind_kph"),
        precip.alias("totalprecip_mm"), (precip / F.lit(25.4)).alias("totalprecip_in"),
        F.lit(0.0).alias("totalsnow_cm"),
        F.lit(10.0).alias("avgvis_km"), F.lit(6.0).alias("avgvis_miles"),
        chance.cast("double").alias("avghumidity"),
        rain.alias("daily_will_it_rain"),
        chance.alias("daily_chance_of_rain"),
        F.lit(False).alias("daily_will_it_snow"),
        F.lit(0).alias("daily_chance_of_snow"),
        F.when(rain, F.lit(RAIN_CONDITION[0])).otherwise(F.lit(DRY_CONDITION[0])).alias("text"),
        F.when(rain, F.lit(RAIN_CONDITION[1])).otherwise(F.lit(DRY_CONDITION[1])).alias("code"),
        ((F.col("n") + h) % 11).cast("double").alias("uv"),
    ]


def forecast_of(p: DataFrame, second_run: bool = False) -> DataFrame:
    """Forecast rows: the pull day and the next two days.

    ``second_run`` marks the re-pull used by the upsert queries: highs one
    degree up, with the next-day high missing (a null must not erase).
    """
    exploded = p.select("*", F.explode(F.array(*[F.lit(x) for x in HORIZON_DAYS])).alias("h"))
    cols = _forecast_cols(F.col("h"), second_run)
    return exploded.select("name", "region", "country", "created_date_local", cols[0],
                           "created_date_utc", *cols[1:])


def weather_batch(spark: SparkSession, sf_dir: str, first_day: dt.date | None = None,
                  before_day: dt.date | None = None, second_run: bool = False) -> Batch:
    """Location, current and forecast tables of the pulls in a day range.

    Planned lazily, so a query reads only the columns of ``events`` that its
    own tables need; where a plan uses the pulls twice, Spark reuses the
    exchange of the shared aggregation.
    """
    p = pulls(spark, sf_dir, first_day, before_day)
    return Batch(
        location=location_of(p),
        current=current_of(p, 1.0 if second_run else 0.0),
        forecast=forecast_of(p, second_run),
    )


def first_run(spark: SparkSession, sf_dir: str) -> Batch:
    """Run 1 of the upsert queries: pulls before ``FIRST_RUN_BEFORE``."""
    return weather_batch(spark, sf_dir, before_day=FIRST_RUN_BEFORE)


def second_run(spark: SparkSession, sf_dir: str) -> Batch:
    """Run 2: pulls from ``SECOND_RUN_FROM`` on, re-pulled (overlaps run 1)."""
    return weather_batch(spark, sf_dir, first_day=SECOND_RUN_FROM, second_run=True)


# ---------------------------------------------------------------------------
# JSON documents built from the pulls, for the document path.
# ---------------------------------------------------------------------------

# Places per document, and the encodings each pull selects.
# Odd event counts write the observed temperature as text; counts divisible
# by 3 write rain as "yes"/"no"; when (days since 1970 + user id) is
# divisible by 13 the condition code is fractional, by 17 the pull time
# carries a zone suffix, by 19 every day's rain chance is fractional text
# (all invalid). Days without observation have no "current" object (invalid).
PLACES_PER_DOCUMENT = 64
TEXT_TEMP_EVERY = 2
WORD_RAIN_EVERY = 3
BAD_CODE_EVERY = 13
BAD_CODE_FRACTION = 0.5
AWARE_TIME_EVERY = 17
AWARE_SUFFIX = "Z"
BAD_CHANCE_EVERY = 19
LOCAL_FORMAT = "yyyy-MM-dd HH:mm"
OBSERVED_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _json_struct(*cols: Column) -> Column:
    return F.to_json(F.struct(*cols))


def record_json(p: DataFrame, temp_shift: float = 0.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """(d, user_id, label, record text) per pull, and columns to keep: a projection, no shuffle."""
    n = F.col("n")
    rule = F.unix_date("d") + F.col("user_id")
    local_text = F.date_format("created_date_local", LOCAL_FORMAT)
    loc = _json_struct(
        "name", "region", "country", "lat", "lon", "tz_id",
        epoch_seconds(F.col("created_date_utc")).alias("localtime_epoch"),
        F.when(rule % AWARE_TIME_EVERY == 0, F.concat(local_text, F.lit(AWARE_SUFFIX)))
        .otherwise(local_text).alias("localtime"))

    cur = dict(zip(["last_updated", "temp_c", "temp_f", "is_day", "text", "code"], _current_cols(temp_shift)))
    head = [F.date_format("obs_ts", OBSERVED_FORMAT).alias("last_updated")]
    tail = [cur["temp_f"], cur["is_day"]]
    as_text = cur["temp_c"].cast("string").alias("temp_c")
    base = F.when(n % TEXT_TEMP_EVERY == 1, _json_struct(*head, as_text, *tail)) \
        .otherwise(_json_struct(*head, cur["temp_c"], *tail))
    bad_code = rule % BAD_CODE_EVERY == 0
    cond = F.when(bad_code, _json_struct(cur["text"], (cur["code"] + F.lit(BAD_CODE_FRACTION))
                                         .alias("code"))) \
        .otherwise(_json_struct(cur["text"], cur["code"]))
    # splice the condition object in before the closing brace
    cur_json = F.concat(F.expr("substring(_base, 1, length(_base) - 1)"),
                        F.lit(',"condition":'), F.col("_cond"), F.lit("}"))

    def day_struct(h: Column, worded: bool, bad_chance: bool) -> Column:
        cols = dict(zip([f.name for f in S.FORECAST_SCHEMA.fields if f.name not in
                         ("name", "region", "country", "created_date_local", "created_date_utc")],
                        _forecast_cols(h)))
        if worded:
            cols["daily_will_it_rain"] = F.when(cols["daily_will_it_rain"], F.lit("yes")) \
                .otherwise(F.lit("no")).alias("daily_will_it_rain")
        if bad_chance:
            cols["daily_chance_of_rain"] = F.concat(
                cols["daily_chance_of_rain"].cast("string"), F.lit(".5")).alias("daily_chance_of_rain")
        day = [cols[c] for c in S.DAY_SPEC if c not in ("condition", "uv")]
        return F.struct(
            F.date_format(cols["date"], "yyyy-MM-dd").alias("date"),
            cols["date_epoch"],
            F.struct(*day, F.struct(cols["text"], cols["code"]).alias("condition"),
                     cols["uv"]).alias("day"))

    horizon = F.array(*[F.lit(x) for x in HORIZON_DAYS])
    def days_json(worded: bool, bad_chance: bool) -> Column:
        return _json_struct(F.transform(horizon, lambda h: day_struct(h, worded, bad_chance))
                            .alias("forecastday"))

    worded, bad_chance = n % WORD_RAIN_EVERY == 0, rule % BAD_CHANCE_EVERY == 0
    fc_json = (F.when(worded & bad_chance, days_json(True, True))
               .when(worded, days_json(True, False))
               .when(bad_chance, days_json(False, True))
               .otherwise(days_json(False, False)))
    body = F.concat(
        F.lit('{"location":'), loc,
        F.when(F.col("obs_ts").isNotNull(), F.concat(F.lit(',"current":'), cur_json))
        .otherwise(F.lit("")),
        F.lit(',"forecast":'), fc_json, F.lit("}"))
    return p.withColumn("_base", base).withColumn("_cond", cond) \
        .select("d", "user_id", *keep, F.col("name").alias("label"), body.alias("record"))


def documents_of(p: DataFrame, temp_shift: float = 0.0) -> DataFrame:
    """One JSON object per (pull day, group of places): label -> record.

    Groups hold at most ``PLACES_PER_DOCUMENT`` records whatever the scale,
    so no document grows with the data. Places appear in user-id order, so
    a record's position in its document is known; documents are in order of
    day, so input order is pull order. The pulls are dealt by day and group
    before they become texts, many times their size, which then move no more.
    """
    grouped = p.withColumn("g", (F.col("user_id") / PLACES_PER_DOCUMENT).cast("bigint")).repartitionByRange("d", "g")
    r = record_json(grouped, temp_shift, keep=("g",))
    entry = F.concat(F.lit('"'), F.col("label"), F.lit('":'), F.col("record"))
    docs = r.groupBy("d", "g").agg(
        F.array_sort(F.collect_list(F.struct("user_id", entry.alias("e")))).alias("entries"))
    body = F.array_join(F.transform("entries", lambda x: x["e"]), ",")
    return docs.sortWithinPartitions("d", "g").select(F.concat(F.lit("{"), body, F.lit("}")).alias("value"))


def write_documents(spark: SparkSession, sf_dir: str, path: str, first_day: dt.date | None = None,
                    before_day: dt.date | None = None, temp_shift: float = 0.0) -> str:
    """Write the documents of a day range's pulls as newline-delimited JSON under ``path``."""
    documents_of(pulls(spark, sf_dir, first_day, before_day), temp_shift).write.mode("errorifexists").text(path)
    return path


# ---------------------------------------------------------------------------
# Several pulls of a place on one day, listed out of time order.
# ---------------------------------------------------------------------------

# An observation is this much older than its pull, so those just
# after midnight are of the day before; a pull's forecast horizon in days.
OBSERVED_MINUTES_BEFORE = 600
MANY_HORIZON = (0, 1)


def event_pulls(spark: SparkSession, sf_dir: str) -> Batch:
    """Every event as a pull of its user's place; input order is by falling event id."""
    ev = _read(spark, sf_dir, "events")
    nation = F.broadcast(_read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(_read(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    p = (ev.join(nation, (ev.user_id % NATIONS) == nation.n_nationkey)
         .join(region, F.col("n_regionkey") == region.r_regionkey)
         .select("event_id", "value", F.col("ts").alias("created_date_local"), F.col("ts").alias("created_date_utc"),
                 F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("name"),
                 F.col("n_name").alias("region"), F.col("r_name").alias("country")))
    head = ["name", "region", "country", "created_date_local", "created_date_utc"]
    current = p.select(*head, (F.col("created_date_local") - F.expr(f"INTERVAL {OBSERVED_MINUTES_BEFORE} MINUTES"))
                       .alias("last_updated"), F.col("value").alias("temp_c"), F.struct(-F.col("event_id")).alias("_order"))
    h = F.col("h")
    forecast = p.withColumn("h", F.explode(F.array(*[F.lit(x) for x in MANY_HORIZON]))).select(
        *head, F.date_add(F.to_date("created_date_local"), h).alias("date"), (F.col("value") + h).alias("avgtemp_c"),
        (F.col("value") + 2).alias("maxtemp_c"), (F.col("value") - 2).alias("mintemp_c"), F.lit(1.0).alias("uv"),
        F.lit(0).alias("daily_chance_of_rain"), F.lit(0).alias("daily_chance_of_snow"), F.lit(5.0).alias("maxwind_kph"),
        F.struct(-F.col("event_id"), h).alias("_order"))
    return Batch(location=p.select(*head), current=current, forecast=forecast, pulls=ev.count())


# ---------------------------------------------------------------------------
# Documents that are not quite what they should be.
# ---------------------------------------------------------------------------

# One text shape per (event id % 10); @ is the id.
EDGE_SHAPES = (
    '{"a@": {"v": @}}', '{"a@": {"v": @}}{"b@": {"v": 1}}', '{"a@": {"v": @}} tail', '{"a@": {"v": 0, "v": @}, "b@": {"v": 1}}',
    "{'a@': {'v': @}}", '{"a@": {"v": 1}, "a@": {"v": @}}', '{"a@": {"v": @}', '{}', '[{"a@": {"v": @}}]',
    '{"a@": {"v": @}}, {"b@": {"v": 2}}',
)


def edge_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, text): every event as one text of the shapes above."""
    shape = F.element_at(F.array(*[F.lit(x) for x in EDGE_SHAPES]), (F.col("event_id") % len(EDGE_SHAPES) + 1).cast("int"))
    return _read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("source"),
        F.replace(shape, F.lit("@"), F.col("event_id").cast("string")).alias("text"))


# ---------------------------------------------------------------------------
# Clock-change cases for the local -> UTC conversion.
# ---------------------------------------------------------------------------

# 2024 clock changes (spring, autumn) of the zones above that
# have them; the others use the first pair.
TRANSITION_DAYS = {"default": ("2024-03-10", "2024-11-03"),
                   "Europe/Paris": ("2024-03-31", "2024-10-27")}
# Fixed value: each event's time of day is folded into the first 4 hours.
TRANSITION_WINDOW_MINUTES = 240


def transition_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a local wall time around a clock change of its place's zone.

    Even event ids take the spring day, odd ones the autumn day; the time of
    day is folded into 00:00-04:00, which covers both gaps and overlaps.
    """
    ev = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    nation = F.broadcast(_read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    zone = _region_zone("n_regionkey")
    spring = F.col("event_id") % 2 == 0
    day = F.when(spring, F.lit(TRANSITION_DAYS["default"][0])).otherwise(
        F.lit(TRANSITION_DAYS["default"][1]))
    for tz, (sp, au) in TRANSITION_DAYS.items():
        if tz != "default":
            day = F.when(F.col("tz_id") == tz, F.when(spring, F.lit(sp)).otherwise(F.lit(au))) \
                .otherwise(day)
    m = (F.hour("ts") * 60 + F.minute("ts")) % TRANSITION_WINDOW_MINUTES
    placed = ev.join(nation, (ev.user_id % NATIONS) == nation.n_nationkey) \
        .select("event_id", "ts", zone.alias("tz_id"))
    d = day.cast("date")
    local = F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d),
                                 (m / 60).cast("int"), m % 60, F.lit(0))
    return placed.select("event_id", "tz_id", local.alias("local_time"))


# Years of the clock changes looked at, and quarter hours from an hour before each.
ZONE_YEARS, ZONE_SLOTS = (2000, 2025), 16


@cache
def zone_changes() -> list[tuple]:
    """(zone, wall time an hour before a clock change): every zone's last gap and last
    overlap, and every change into an overlap whose earlier reading is standard time."""
    out = []
    for zone in pytz.all_timezones:
        tz = pytz.timezone(zone)
        times, info = getattr(tz, "_utc_transition_times", ()), getattr(tz, "_transition_info", ())
        special = {since for since, _ in standard_first().get(zone, ())}
        last, chosen = {}, set()
        for k in range(1, len(times)):
            (before, *_), (after, *_) = info[k - 1], info[k]
            if before != after and ZONE_YEARS[0] <= times[k].year <= ZONE_YEARS[1]:
                start = times[k] + min(before, after)
                last[after > before] = start
                if start in special:
                    chosen.add(start)
        out += [(zone, t - dt.timedelta(hours=1)) for t in sorted(chosen | set(last.values()))]
    return out


def zone_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a wall time around a clock change of one of all zones."""
    changes = zone_changes()
    n = F.lit(len(changes))
    table = spark.createDataFrame(pa.table({
        "k": pa.array(range(len(changes)), pa.int64()), "tz_id": pa.array([zone for zone, _ in changes], pa.string()),
        "base": pa.array([t for _, t in changes], pa.timestamp("us"))}), "k long, tz_id string, base timestamp_ntz")
    slot = F.pmod(F.floor(F.col("event_id") / n), F.lit(ZONE_SLOTS))
    ev = (_read(spark, sf_dir, "events").where("event_id is not null")
          .select("event_id", F.pmod("event_id", n).alias("k"), slot.alias("slot")))
    # bounded: a few rows for each zone there is
    return ev.join(F.broadcast(table), "k").select(
        "event_id", "tz_id", (F.col("base") + F.make_dt_interval(mins=(F.col("slot") * 15).cast("int"))).alias("local_time"))
