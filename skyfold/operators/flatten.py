"""Documents -> the three flat tables of a batch (location, current, forecast)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import local_to_utc
from .validate import fail_on_violation, quarantined, typed_record, valid_only, validate_records

PARENT = S.PLACE_KEYS + ["created_date_local", "created_date_utc"]


@dataclass
class Flat:
    location: DataFrame
    current: DataFrame
    forecast: DataFrame
    rejected: DataFrame | None = None


def typed_records(records: DataFrame, mode: str = "fail") -> tuple[DataFrame, DataFrame | None]:
    """Validate decoded records and cast the valid ones.

    Returns (records with a typed ``rec`` struct, rejected or None).
    """
    if mode not in ("fail", "quarantine"):
        raise ValueError(f"mode must be 'fail' or 'quarantine', not {mode!r}")
    checked = validate_records(records, keep_parts=True)
    if mode == "fail":
        good, bad = fail_on_violation(checked), None
    else:
        good, bad = valid_only(checked), quarantined(checked)
    return good.select("source", "doc", "pos", "label", typed_record().alias("rec")), bad


# Input order of a row, carried beside the tables' own columns until a batch
# is collapsed: source, document, record, then forecast day.
ORDER = "_order"


def with_pull_keys(typed: DataFrame) -> DataFrame:
    """Place keys, pull time and its UTC reading beside each record, and its input order."""
    loc = F.col("rec.location")
    return typed.select(
        "rec", F.struct("source", "doc", "pos").alias(ORDER),
        loc["name"].alias("name"), loc["region"].alias("region"), loc["country"].alias("country"),
        loc["localtime"].alias("created_date_local"),
        local_to_utc(loc["localtime"], loc["tz_id"]).alias("created_date_utc"),
    )


def location_table(keyed: DataFrame) -> DataFrame:
    return keyed.select(ORDER, "rec.location.*").select(*S.columns(S.LOCATION_SCHEMA), ORDER)


def current_table(keyed: DataFrame) -> DataFrame:
    """Observation per record, condition unnested to text/code."""
    return keyed.select(*PARENT, ORDER, "rec.current.*").select(
        *PARENT, "last_updated", "temp_c", "temp_f", "is_day",
        F.col("condition.text").alias("text"), F.col("condition.code").alias("code"), ORDER,
    ).select(*S.columns(S.CURRENT_SCHEMA), ORDER)


def forecast_table(keyed: DataFrame) -> DataFrame:
    """One row per forecast day, parent keys repeated, day and condition unnested.

    A record without forecast days yields no rows.
    """
    days = keyed.select(*PARENT, ORDER, F.posexplode("rec.forecast.forecastday").alias("day_pos", "fd"))
    flat = days.select(*PARENT, F.struct(f"{ORDER}.*", "day_pos").alias(ORDER), "fd.date", "fd.date_epoch", "fd.day.*")
    return flat.select(
        *[c for c in flat.columns if c != "condition"],
        F.col("condition.text").alias("text"), F.col("condition.code").alias("code"),
    ).select(*S.columns(S.FORECAST_SCHEMA), ORDER)


def flatten(records: DataFrame, mode: str = "fail") -> Flat:
    """Decoded records -> location, current and forecast tables.

    The three tables share the validation and typing above; write them
    from one staged copy (see ``plans.pipeline``) so it runs once.
    """
    typed, bad = typed_records(records, mode)
    keyed = with_pull_keys(typed)
    return Flat(*[t.drop(ORDER) for t in (location_table(keyed), current_table(keyed), forecast_table(keyed))], bad)
