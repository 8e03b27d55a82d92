"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Inputs are the driver's tables; ``sources.derived`` turns ``events`` into
weather-shaped batches, and the library's operators run on those.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import day_diff, day_of, round2
from ..operators import insights as I
from ..operators.merge import merge_forecast
from ..operators.stats import place_stats
from ..operators.upsert import upsert_table
from ..sources import derived as D

Query = Callable[[SparkSession, str], DataFrame]


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    b = D.weather_batch(spark, sf)
    return merge_forecast(b.forecast, b.current)


def _stats(spark: SparkSession, sf: str) -> DataFrame:
    return place_stats(_merged(spark, sf))


def q_merged(spark, sf):
    return _merged(spark, sf)


def q_stats(spark, sf):
    return _stats(spark, sf)


def q_highest_temp_date(spark, sf):
    return _stats(spark, sf).select(*S.PLACE_KEYS, "highest_temp_date")


def q_horizontal_minmax(spark, sf):
    return _stats(spark, sf).select(*S.PLACE_KEYS, "min_forecast", "max_forecast",
                                    "current_temp_c", "min_temp", "max_temp")


def q_day_diff(spark, sf):
    fc = D.weather_batch(spark, sf).forecast
    return fc.select(*S.PLACE_KEYS, "created_date_local", "date",
                     day_diff("date", day_of("created_date_local")).alias("day_diff"))


def q_forecast_error(spark, sf):
    return _merged(spark, sf).select(*S.PLACE_KEYS, "created_date_local", "forecast_date",
                                     "day_diff", "forecast_current_temp_diff")


def q_to_date(spark, sf):
    cur = D.weather_batch(spark, sf).current
    return cur.select(*S.PLACE_KEYS, "created_date_local", "last_updated",
                      day_of("created_date_local").alias("created_day"),
                      day_of("last_updated").alias("data_date"))


def q_round2(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    return ev.select("event_id", "value", round2(F.col("value") / 7).alias("value_r2"))


def q_local_to_utc(spark, sf):
    return D.pulls(spark, sf).select(*S.PLACE_KEYS, "tz_id", "created_date_local",
                                     "created_date_utc")


def q_current_vs_forecast(spark, sf):
    return I.current_vs_forecast(_merged(spark, sf))


def q_current_vs_forecast_count(spark, sf):
    return I.tile_count(_merged(spark, sf))


def q_hottest_current(spark, sf):
    return I.hottest_current(_merged(spark, sf))


def q_coldest_current(spark, sf):
    return I.coldest_current(_merged(spark, sf))


def q_highest_forecast(spark, sf):
    return I.highest_forecast(_merged(spark, sf))


def q_lowest_forecast(spark, sf):
    return I.lowest_forecast(_merged(spark, sf))


def q_hottest_current_rows(spark, sf):
    return I.extreme_rows(_merged(spark, sf), "current_temp_c", largest=True)


def q_coldest_current_rows(spark, sf):
    return I.extreme_rows(_merged(spark, sf), "current_temp_c", largest=False)


def q_highest_forecast_rows(spark, sf):
    return I.extreme_rows(_merged(spark, sf), "forecast_maxtemp_c", largest=True)


def q_lowest_forecast_rows(spark, sf):
    return I.extreme_rows(_merged(spark, sf), "forecast_mintemp_c", largest=False)


# Fixed value: the place asked for where a query narrows to one.
CITY = "u7"


def q_city_detail_one(spark, sf):
    m = _merged(spark, sf)
    return I.city_detail(m, place_stats(m), city=CITY)


def q_city_range_one(spark, sf):
    return I.city_range(_merged(spark, sf), city=CITY)


def q_latest_snapshot(spark, sf):
    return I.latest_snapshot(_merged(spark, sf))


def q_city_range(spark, sf):
    return I.city_range(_merged(spark, sf))


def q_city_detail(spark, sf):
    m = _merged(spark, sf)
    return I.city_detail(m, place_stats(m))


def q_place_names(spark, sf):
    return I.place_names(D.weather_batch(spark, sf).location)


def q_stats_table(spark, sf):
    return I.stats_table(_stats(spark, sf))


def _two_runs(spark, sf):
    return D.first_run(spark, sf), D.second_run(spark, sf)


def q_upsert_location(spark, sf):
    r1, r2 = _two_runs(spark, sf)
    return upsert_table("location", r1.location, r2.location)


def q_upsert_current(spark, sf):
    r1, r2 = _two_runs(spark, sf)
    return upsert_table("current_temp", r1.current, r2.current)


def q_upsert_forecast(spark, sf):
    r1, r2 = _two_runs(spark, sf)
    return upsert_table("forecast_temp", r1.forecast, r2.forecast)


def q_upsert_merged(spark, sf):
    r1, r2 = _two_runs(spark, sf)
    return upsert_table("merged", merge_forecast(r1.forecast, r1.current),
                        merge_forecast(r2.forecast, r2.current))


def q_upsert_stats(spark, sf):
    r1, r2 = _two_runs(spark, sf)
    s1 = place_stats(merge_forecast(r1.forecast, r1.current))
    s2 = place_stats(merge_forecast(r2.forecast, r2.current))
    return upsert_table("stats", s1, s2)


def queries() -> dict[str, Query]:
    return {name[2:]: fn for name, fn in globals().items()
            if name.startswith("q_") and callable(fn)}


# ---------------------------------------------------------------------------
# Document path, files and snapshots. Inputs are written to a new folder of the
# shared one from the driver's tables, then read back by the library.
# ---------------------------------------------------------------------------

def _documents(spark: SparkSession, sf: str) -> str:
    from ..session import scratch_path
    return D.write_documents(spark, sf, scratch_path(spark, "documents"))


def _records(spark, sf):
    from ..sources.documents import decode_documents, read_documents
    return decode_documents(read_documents(spark, _documents(spark, sf)))


def _flat(spark, sf):
    """Flat tables of the documents, validated and typed once per call (staged)."""
    from ..sources.documents import read_documents
    from .pipeline import batch_tables, stage_records
    staged = stage_records(spark, read_documents(spark, _documents(spark, sf)), mode="quarantine")
    return batch_tables(staged, on_duplicate="multiply")


def q_json_source(spark, sf):
    r = _records(spark, sf)
    return r.select(
        "label",
        F.try_variant_get("record", "$.location.name", "string").alias("name"),
        F.try_variant_get("record", "$.location.localtime", "string").alias("localtime"),
        F.try_variant_get("record", "$.current", "variant").isNotNull().alias("has_current"),
        F.size(F.try_variant_get("record", "$.forecast.forecastday", "array<variant>"))
        .alias("n_forecast_days"),
    )


def q_explode_map(spark, sf):
    r = _records(spark, sf)
    return r.select(
        "label", "pos",
        F.try_variant_get("record", "$.location.region", "string").alias("region"),
        F.try_variant_get("record", "$.location.country", "string").alias("country"),
    )


def q_validate_records(spark, sf):
    from ..operators.validate import validate_records
    v = validate_records(_records(spark, sf))
    return v.select(
        "label",
        F.try_variant_get("record", "$.location.localtime", "string").alias("localtime"),
        F.array_join("violations", "; ").alias("violations"),
    )


def q_location_table(spark, sf):
    return _flat(spark, sf)["location"]


def q_unnest_struct(spark, sf):
    return _flat(spark, sf)["current_temp"]


def q_explode_forecast(spark, sf):
    return _flat(spark, sf)["forecast_temp"]


def q_flatten(spark, sf):
    return _flat(spark, sf)["merged"]


def _merged_csv(spark, sf) -> str:
    from ..session import scratch_path
    from ..sources.snapshots import write_csv
    path = scratch_path(spark, "merged-csv")
    write_csv(_merged(spark, sf), path)
    return path


def q_csv_roundtrip(spark, sf):
    from ..sources.snapshots import read_csv
    return read_csv(spark, _merged_csv(spark, sf), "merged")


def q_parse_dates(spark, sf):
    from ..sources.snapshots import parse_dates, text_schema
    raw = spark.read.schema(text_schema("merged")).option("header", "true").csv(_merged_csv(spark, sf))
    return parse_dates(raw, "merged").select(
        *S.PLACE_KEYS, "created_date_local", "created_date_utc", "forecast_date",
        "current_temp_last_updated")


def q_snapshot_read(spark, sf):
    from ..session import scratch_path
    from ..sources.snapshots import SnapshotStore
    b = D.weather_batch(spark, sf)
    merged = merge_forecast(b.forecast, b.current)
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    store.write({"location": b.location, "current_temp": b.current, "forecast_temp": b.forecast,
                 "merged": merged, "stats": place_stats(merged)})
    return store.read("merged")


def q_weather_pipeline(spark, sf):
    from ..session import scratch_path
    from ..sources.snapshots import SnapshotStore
    from .pipeline import run
    root = scratch_path(spark, "store")
    run(spark, _documents(spark, sf), root, mode="quarantine", layout="versioned")
    return SnapshotStore(spark, root).read("stats")


def q_stream_ingest(spark, sf):
    """Documents picked up by the file stream, applied per micro-batch."""
    from ..session import scratch_path
    from ..sources.snapshots import SnapshotStore
    from ..streaming.ingest import start_ingest
    root = scratch_path(spark, "store")
    q = start_ingest(spark, _documents(spark, sf), root, mode="quarantine")
    q.awaitTermination()  # an available-now stream stops by itself
    return SnapshotStore(spark, root).read("merged")


def q_pipeline_by_day(spark, sf):
    """The run into the day-partitioned layout; the stored merged table."""
    from ..session import scratch_path
    from ..sources.snapshots import SnapshotStore
    from .pipeline import run
    root = scratch_path(spark, "daystore")
    run(spark, _documents(spark, sf), root, mode="quarantine", layout="by_day")
    return SnapshotStore(spark, root).read("merged")


def q_pipeline_location(spark, sf):
    """Location after a run whose batch holds every day's pull: latest per place."""
    from ..session import scratch_path
    from ..sources.snapshots import SnapshotStore
    from .pipeline import run
    root = scratch_path(spark, "store")
    run(spark, _documents(spark, sf), root, mode="quarantine")
    return SnapshotStore(spark, root).read("location")


def q_merged_many_pulls(spark, sf):
    """Several pulls a day, observations that belong to the day before."""
    b = D.event_pulls(spark, sf)
    return merge_forecast(b.forecast, b.current, b.pulls).select(
        *S.PLACE_KEYS, "created_date_local", "created_date_utc", "forecast_date", "current_temp_last_updated",
        "current_temp_c", "forecast_avgtemp_c", "day_diff", "forecast_current_temp_diff")


def q_stats_many_pulls(spark, sf):
    """First observations and hottest days by input order, which is not time order."""
    b = D.event_pulls(spark, sf)
    return place_stats(merge_forecast(b.forecast, b.current, b.pulls))


def q_collapse_many_pulls(spark, sf):
    """The batch's last row of every key in input order, for two tables that must agree."""
    from ..operators.upsert import collapse_batch
    b = D.event_pulls(spark, sf)
    merged = collapse_batch("merged", merge_forecast(b.forecast, b.current, b.pulls))
    return merged.select(*S.PLACE_KEYS, "created_date_local", "forecast_date", "created_date_utc",
                         "current_temp_last_updated", "current_temp_c", "forecast_avgtemp_c")


def q_json_edge_documents(spark, sf):
    """Texts that are one object, several, malformed or with repeated keys."""
    from ..sources.documents import decode_documents
    r = decode_documents(D.edge_documents(spark, sf))
    return r.select("source", "doc_ok", "label", "pos", F.try_variant_get("record", "$.v", "bigint").alias("v"), "text")


def q_mean_precise(spark, sf):
    """Means of small numbers, with NaN in some groups."""
    from ..operators.means import grouped_means
    ev = spark.read.parquet(f"{sf}/events.parquet")
    nan = (F.col("user_id") % 10 == 3) & (F.col("event_type") == "error")
    v = F.when(nan, F.lit(float("nan"))).otherwise(F.col("value") / 70000000)
    means = grouped_means(ev, ["user_id"], {"mean": v})
    return means.select("user_id", (F.round(F.col("mean") * 1e15, 0) / 1e15).alias("mean"))


def q_mean_wide(spark, sf):
    """Means over magnitudes from 1e-290 to 1e300, mixed in some groups, to 11 digits."""
    from ..operators.means import grouped_means
    ev = spark.read.parquet(f"{sf}/events.parquet")
    scale = F.element_at(F.array(*[F.lit(x) for x in (1.0, 1e-9, 1e16, 1e300, 1e-290)]),
                         (F.pmod(F.when(F.col("user_id") % 2 == 0, F.col("user_id")).otherwise(F.col("event_id")), F.lit(5)) + 1).cast("int"))
    means = grouped_means(ev, ["user_id"], {"mean": F.col("value") * scale})
    return means.select("user_id", F.format_string("%.10e", "mean").alias("mean"))


def q_csv_five_tables(spark, sf):
    """All five tables through CSV: names with blanks, quotes and line breaks, two column orders."""
    from ..session import scratch_path
    from ..sources.snapshots import read_csv, write_csv
    b = D.weather_batch(spark, sf)
    merged = merge_forecast(b.forecast, b.current)
    tables = {"location": (b.location, "lat"), "current_temp": (b.current, "temp_c"),
              "forecast_temp": (b.forecast, "avgtemp_c"), "merged": (merged, "forecast_avgtemp_c"),
              "stats": (place_stats(merged), "max_forecast")}
    out = None
    for name, (df, value) in tables.items():
        odd = df.withColumn("name", F.concat(F.lit(' "'), F.col("name"), F.lit('",\n x ')))
        path = scratch_path(spark, f"csv-{name}")
        half = F.pmod(F.xxhash64("region"), F.lit(2)) == 0
        write_csv(odd.where(half), path)
        write_csv(odd.where(~half).select(*reversed(odd.columns)), path, mode="append")
        rows = read_csv(spark, path, name).groupBy("name").agg(
            F.count("*").alias("n"), F.round(F.sum(F.col(value).cast("decimal(30,6)")), 3).cast("double").alias("total"))
        rows = rows.select(F.lit(name).alias("table_name"), "name", "n", "total")
        out = rows if out is None else out.unionAll(rows)
    return out


def q_saved_order(spark, sf):
    """Rows of a saved table with their number in saved order."""
    from ..session import scratch_path
    from ..sources.snapshots import SnapshotStore
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    store.write({"merged": _merged(spark, sf)}, sort=True)
    return store.read_numbered("merged").select(*S.MERGED_KEYS, F.col("n").cast("int"))


def _after_two_runs(spark, sf, table):
    """A table after two overlapping batches of documents, the second one degree warmer."""
    from ..session import scratch_path
    from ..sources.snapshots import SnapshotStore
    from .pipeline import run
    root = scratch_path(spark, "store")
    one = D.write_documents(spark, sf, scratch_path(spark, "documents"), before_day=D.FIRST_RUN_BEFORE)
    two = D.write_documents(spark, sf, scratch_path(spark, "documents"), first_day=D.SECOND_RUN_FROM, temp_shift=1.0)
    for documents in (one, two):
        run(spark, documents, root, mode="quarantine", multiline=False)
    return SnapshotStore(spark, root).read(table)


def q_two_runs_location(spark, sf):
    return _after_two_runs(spark, sf, "location")


def q_two_runs_current(spark, sf):
    return _after_two_runs(spark, sf, "current_temp")


def q_two_runs_forecast(spark, sf):
    return _after_two_runs(spark, sf, "forecast_temp")


def q_two_runs_merged(spark, sf):
    return _after_two_runs(spark, sf, "merged")


def q_two_runs_stats(spark, sf):
    return _after_two_runs(spark, sf, "stats")


def q_local_to_utc_transitions(spark, sf):
    """Local -> UTC for wall times in spring gaps and autumn overlaps."""
    from ..functions import local_to_utc
    t = D.transition_times(spark, sf)
    return t.select("event_id", "tz_id", "local_time",
                    local_to_utc("local_time", "tz_id").alias("utc_time"))


def q_local_to_utc_zones(spark, sf):
    """Local -> UTC around clock changes of every zone that has any."""
    from ..functions import local_to_utc
    t = D.zone_times(spark, sf)
    return t.select("event_id", "tz_id", "local_time",
                    local_to_utc("local_time", "tz_id").alias("utc_time"))
