"""Date and time expressions (all JVM-side column expressions)."""

from __future__ import annotations

from functools import cache

import pytz
from pyspark.sql import Column
from pyspark.sql import functions as F

def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@cache
def standard_first() -> dict[str, list[tuple]]:
    """Zone -> spans of ambiguous wall times of which the earlier reading alone is standard time.

    That is so where clocks are set back *into* summer time, as zones do whose
    standard time is the one ahead (Dublin, Windhoek until 2017, Casablanca in
    Ramadan). Read from the zone data once; about 200 spans over all zones.
    """
    spans: dict[str, list[tuple]] = {}
    for zone in pytz.all_timezones:
        tz = pytz.timezone(zone)
        changes = list(zip(getattr(tz, "_utc_transition_times", ()), getattr(tz, "_transition_info", ())))
        for (_, (ahead, summer, _)), (at, (behind, then, _)) in zip(changes, changes[1:]):
            if behind < ahead and then and not summer:
                spans.setdefault(zone, []).append((at + behind, at + ahead))
    return spans


def _is_standard_first(local: Column, tz: Column) -> Column:
    when = lambda t: F.lit(t.isoformat()).cast("timestamp_ntz")
    table = F.create_map(*[x for zone, spans in standard_first().items() for x in (
        F.lit(zone), F.array(*[F.struct(when(a).alias("since"), when(b).alias("until")) for a, b in spans]))])
    return F.coalesce(F.exists(table[tz], lambda s: (local >= s["since"]) & (local < s["until"])), F.lit(False))


def local_to_utc(local, tz) -> Column:
    """Wall-clock ``timestamp_ntz`` in zone ``tz`` -> UTC wall clock (ntz).

    Non-existent times (spring gap) move forward by the gap. Ambiguous
    times (autumn overlap) take the standard-time reading, i.e. the later
    instant: the plain conversion gives the earlier one, so the zone's offset
    a day later, after the change, is tried and kept when it maps back to the
    same wall time, however far the clocks were set back, unless the zone data
    says that the earlier one alone is standard time. Independent of the session
    time zone.
    """
    local, tz = _col(local), _col(tz)
    utc = F.lit("UTC")
    plain = F.convert_timezone(tz, utc, local)
    after = plain + F.expr("INTERVAL 1 DAY")
    later = local - (F.convert_timezone(utc, tz, after) - after)
    maps_back = F.convert_timezone(utc, tz, later) == local
    return F.when(maps_back & ~_is_standard_first(local, tz), later).otherwise(plain)


def day_of(c) -> Column:
    """Datetime (or date) -> date."""
    return F.to_date(_col(c))


def day_diff(later, earlier) -> Column:
    """Whole days between two dates, as int."""
    return F.datediff(_col(later), _col(earlier))


def truncate_minute(c) -> Column:
    """Minute floor of a ``timestamp_ntz`` that stays ntz in any session zone."""
    c = _col(c)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c),
                                F.hour(c), F.minute(c), F.lit(0))


def epoch_seconds(utc_ntz) -> Column:
    """Unix seconds of a UTC wall-clock ``timestamp_ntz`` (session-independent)."""
    c = _col(utc_ntz)
    return (F.unix_date(F.to_date(c)).cast("bigint") * 86400
            + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c).cast("bigint"))
