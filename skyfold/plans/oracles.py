"""DuckDB SQL counterparts of the registered queries (the correctness gate).

The SQL restates the derivation of ``sources.derived`` and each operator
independently, in DuckDB's dialect, over the same parquet views.
"""

from __future__ import annotations

import datetime as dt

import pytz

from ..sources import derived as D

# Fixed value: the place asked for where a query narrows to one (as in the catalog).
CITY = "u7"
SEEN = "event_type <> 'error'"


def _case(column: str, mapping, default="NULL") -> str:
    parts = " ".join(f"when {k!r} then {v!r}" if isinstance(v, str) else f"when {k!r} then {v}"
                     for k, v in mapping)
    return f"case {column} {parts} else {default} end"


def _f(x: str) -> str:
    return f"({x}) * cast(1.8 as double) + cast(32.0 as double)"


RULE = "((d - DATE '1970-01-01') + user_id)"
VALID = (f"obs_ts is not null and {RULE} % {D.BAD_CODE_EVERY} <> 0 "
         f"and {RULE} % {D.AWARE_TIME_EVERY} <> 0 and {RULE} % {D.BAD_CHANCE_EVERY} <> 0")


def batch_ctes(tag: str = "", first_day=None, before_day=None, second_run=False,
               valid_only=False, warmer=False) -> list[str]:
    """CTEs p{tag}, loc{tag}, cur{tag}, fc{tag}, mg{tag}, sx{tag} of one run.

    ``valid_only`` keeps the pulls whose documents pass validation.
    """
    where = []
    if first_day is not None:
        where.append(f"ts >= TIMESTAMP '{first_day.isoformat()} 00:00:00'")
    if before_day is not None:
        where.append(f"ts < TIMESTAMP '{before_day.isoformat()} 00:00:00'")
    w = ("where " + " and ".join(where)) if where else ""
    zone = _case("r.r_regionkey", list(enumerate(D.REGION_ZONES)))
    code = _case("obs_type", list(D.OBSERVED_CODES.items()))
    shift = " + cast(1.0 as double)" if second_run or warmer else ""
    mx = "hi + h"
    if second_run:
        mx = "case when h <> 1 then hi + h + cast(1.0 as double) end"
    chance = "cast((100 * n_err) // n as integer)"
    rain = f"({chance} >= {D.RAIN_FROM_PERCENT})"
    t = tag
    return [
        f"""day{t} as (select user_id, cast(ts as date) d, max(ts) last_ts, min(value) lo, max(value) hi,
               count(*) n, count(*) filter (where event_type = 'error') n_err,
               max(ts) filter (where {SEEN}) obs_ts,
               max_by(value, event_id) filter (where {SEEN}) obs_value,
               max_by(event_type, event_id) filter (where {SEEN}) obs_type
            from events {w} group by user_id, cast(ts as date))""",
        f"""q{t} as (select dy.*, concat('u', cast(dy.user_id as varchar)) name, n.n_name region,
               r.r_name country, cast(dy.user_id % 170 as double) - cast(84.5 as double) lat,
               cast((dy.user_id * 37) % 360 as double) - cast(179.5 as double) lon,
               {zone} tz_id, date_trunc('minute', dy.last_ts) created_date_local
            from day{t} dy join nation n on n.n_nationkey = dy.user_id % 25
            join region r on r.r_regionkey = n.n_regionkey)""",
        f"""p{t} as (select *, timezone('UTC', timezone(tz_id, created_date_local)) created_date_utc
            from q{t} {'where ' + VALID if valid_only else ''})""",
        f"""loc{t} as (select name, region, country, lat, lon, tz_id,
               max_by(cast(epoch(created_date_utc) as bigint), created_date_local) localtime_epoch,
               max(created_date_local) localtime
            from p{t} group by name, region, country, tz_id, lat, lon)""",
        f"""cur{t} as (select name, region, country, created_date_local, created_date_utc,
               obs_ts last_updated, obs_value{shift} temp_c, {_f('obs_value' + shift)} temp_f,
               case when hour(obs_ts) between 6 and 17 then 1 else 0 end is_day,
               obs_type text, {code} code
            from p{t} where obs_ts is not null)""",
        f"""ph{t} as (select *, unnest([{', '.join(str(h) for h in D.HORIZON_DAYS)}]) h from p{t})""",
        f"""fc{t} as (select name, region, country, created_date_local, cast(d + h as date) date,
               created_date_utc, (cast(d + h as date) - DATE '1970-01-01') * 86400 date_epoch,
               {mx} maxtemp_c, {_f(mx)} maxtemp_f, lo - h mintemp_c, {_f('lo - h')} mintemp_f,
               (lo + hi) / 2 avgtemp_c, {_f('(lo + hi) / 2')} avgtemp_f,
               cast(n + h as double) / cast(1.609344 as double) maxwind_mph,
               cast(n + h as double) maxwind_kph,
               cast(n_err as double) * cast(0.5 as double) totalprecip_mm,
               cast(n_err as double) * cast(0.5 as double) / cast(25.4 as double) totalprecip_in,
               cast(0.0 as double) totalsnow_cm, cast(10.0 as double) avgvis_km,
               cast(6.0 as double) avgvis_miles, cast({chance} as double) avghumidity,
               {rain} daily_will_it_rain, {chance} daily_chance_of_rain,
               false daily_will_it_snow, 0 daily_chance_of_snow,
               case when {rain} then '{D.RAIN_CONDITION[0]}' else '{D.DRY_CONDITION[0]}' end text,
               case when {rain} then {D.RAIN_CONDITION[1]} else {D.DRY_CONDITION[1]} end code,
               cast((n + h) % 11 as double) uv
            from ph{t})""",
        f"""mg{t} as (select fc.name, fc.region, fc.country,
               cast(fc.created_date_local as date) created_date_local, fc.created_date_utc,
               fc.date forecast_date, ob.last_updated current_temp_last_updated,
               ob.temp_c current_temp_c, fc.uv, fc.avgtemp_c forecast_avgtemp_c,
               fc.maxtemp_c forecast_maxtemp_c, fc.mintemp_c forecast_mintemp_c,
               cast(fc.date - cast(fc.created_date_local as date) as integer) day_diff,
               case when fc.date - cast(fc.created_date_local as date) = 0
                    then round((ob.temp_c - fc.avgtemp_c) * 100, 0) / 100 end
                 forecast_current_temp_diff,
               fc.daily_chance_of_rain, fc.daily_chance_of_snow, fc.maxwind_kph forecast_maxwind_kph
            from fc{t} fc left join cur{t} ob on fc.name = ob.name and fc.region = ob.region
             and fc.country = ob.country
             and cast(fc.created_date_local as date) = cast(ob.last_updated as date))""",
        f"""sx0{t} as (select name, region, country,
               first(current_temp_c order by created_date_local, forecast_date) current_temp_c,
               min(forecast_mintemp_c) min_forecast, max(forecast_maxtemp_c) max_forecast,
               {mean('forecast_avgtemp_c', rounded=True)} mean_forecast,
               first(created_date_local order by created_date_local, forecast_date) first_created,
               first(forecast_date order by forecast_maxtemp_c desc, created_date_local, forecast_date)
                 filter (where forecast_maxtemp_c is not null) hottest_forecast
            from mg{t} group by name, region, country)""",
        f"""sx{t} as (select name, region, country, current_temp_c, min_forecast, max_forecast,
               mean_forecast,
               case when current_temp_c >= max_forecast then first_created else hottest_forecast end
                 highest_temp_date,
               least(min_forecast, current_temp_c) min_temp,
               greatest(max_forecast, current_temp_c) max_temp
            from sx0{t})""",
    ]


def mean(col: str, rounded: bool = False) -> str:
    m = f"cast(sum(cast({col} as decimal(38,6))) as double) / count({col})"
    return f"round({m} * 100, 0) / 100" if rounded else m


def with_ctes(ctes: list[str], body: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + body


def one_run(body: str) -> str:
    return with_ctes(batch_ctes(), body)


def valid_run(body: str) -> str:
    return with_ctes(batch_ctes(valid_only=True), body)


def two_runs(body: str) -> str:
    return with_ctes(batch_ctes("1", before_day=D.FIRST_RUN_BEFORE)
                     + batch_ctes("2", first_day=D.SECOND_RUN_FROM, second_run=True), body)


def upsert_sql(old: str, new: str, keys: list[str], cols: list[str]) -> str:
    sel = ", ".join(f"coalesce(n.{c}, o.{c}) {c}" for c in cols)
    on = " and ".join(f"o.{k} = n.{k}" for k in keys)
    return f"select {sel} from {old} o full join {new} n on {on}"


def _merged_recomputed(inner: str) -> str:
    from .. import schemas as S
    cols = []
    for c in S.columns(S.MERGED_SCHEMA):
        if c == "day_diff":
            cols.append("cast(forecast_date - created_date_local as integer) day_diff")
        elif c == "forecast_current_temp_diff":
            cols.append("case when forecast_date - created_date_local = 0 then "
                        "round((current_temp_c - forecast_avgtemp_c) * 100, 0) / 100 end "
                        "forecast_current_temp_diff")
        else:
            cols.append(c)
    return f"select {', '.join(cols)} from ({inner}) u"


def _extreme(col: str, largest: bool) -> str:
    direction = "desc" if largest else "asc"
    return one_run(f"select name, {col} from mg where {col} is not null order by {col} {direction}, "
                   "name, region, country, created_date_local, forecast_date limit 1")


def _extreme_rows(col: str, which: str) -> str:
    return one_run(f"select name, created_date_local, forecast_date, {col} from mg "
                   f"where {col} = (select {which}({col}) from mg)")


LATEST = ("(select m.* from mg m join (select name, max(created_date_local) mx from mg group by name) l"
          " on m.name = l.name and m.created_date_local = l.mx)")


def _city_range() -> str:
    return ("select name, cast(forecast_date as varchar) forecast_day, forecast_mintemp_c, forecast_maxtemp_c, "
            f"forecast_avgtemp_c, forecast_maxtemp_c - forecast_mintemp_c range_c from {LATEST} s")


def _city_detail() -> str:
    return ("select s.name, s.region, s.country, s.highest_temp_date, s.max_temp, s.mean_forecast, "
            "d.uv_mean, d.wind_mean, printf('%.2f', d.uv_mean) uv_text, "
            "printf('%.2f', d.wind_mean) wind_text from sx s join ("
            f"select name, region, country, {mean('uv')} uv_mean, "
            f"{mean('forecast_maxwind_kph')} wind_mean from {LATEST} l "
            "group by name, region, country) d "
            "on s.name = d.name and s.region = d.region and s.country = d.country")


MANY = f"""
ev as (select e.event_id, e.value, e.ts, concat('u', cast(e.user_id as varchar)) name, n.n_name region, r.r_name country
       from events e join nation n on n.n_nationkey = e.user_id % 25 join region r on r.r_regionkey = n.n_regionkey),
many as (select f.name, f.region, f.country, cast(f.ts as date) created_date_local, f.ts created_date_utc,
           cast(cast(f.ts as date) + h as date) forecast_date, o.ts - interval {D.OBSERVED_MINUTES_BEFORE} minute current_temp_last_updated,
           o.value current_temp_c, f.value + h forecast_avgtemp_c, f.value + 2 hi, f.value - 2 lo, h day_diff,
           f.event_id fe, o.event_id oe
         from (select *, unnest([{', '.join(map(str, D.MANY_HORIZON))}]) h from ev) f left join ev o
           on f.name = o.name and f.region = o.region and f.country = o.country
          and cast(f.ts as date) = cast(o.ts - interval {D.OBSERVED_MINUTES_BEFORE} minute as date))"""


def _edge_sql() -> str:
    """What each text shape holds, by hand."""
    id_ = "event_id"
    text = " ".join(f"when {k} then replace('{t.replace(chr(39), chr(39) * 2)}', '@', {id_} :: varchar)"
                    for k, t in enumerate(D.EDGE_SHAPES))
    one = f"'a' || {id_}"
    return f"""
with t as (select event_id, event_id % {len(D.EDGE_SHAPES)} k, event_id :: varchar source from events),
rows as (
  select source, true doc_ok, {one} as label, 0 pos, event_id v, null :: varchar as text from t where k in (0, 3, 5)
  union all select source, true, 'b' || {id_}, 1, 1, null from t where k = 3
  union all select source, false, null, null, null, case k {text} end from t where k in (1, 2, 4, 6, 8, 9))
select source, doc_ok, label, cast(pos as integer) pos, cast(v as bigint) v, text from rows"""


def _more(S) -> dict[str, str]:
    """Oracles of the queries on odd input and on two runs."""
    diff = "case when day_diff = 0 then round((current_temp_c - forecast_avgtemp_c) * 100, 0) / 100 end"
    order = "fe desc, day_diff, oe desc"
    keys = "name, region, country, created_date_local, forecast_date"
    out = {
        "merged_many_pulls": f"with {MANY} select {keys}, created_date_utc, current_temp_last_updated, current_temp_c, "
                             f"forecast_avgtemp_c, cast(day_diff as integer) day_diff, {diff} forecast_current_temp_diff from many",
        "stats_many_pulls": f"""with {MANY}, g as (select name, region, country,
              first(current_temp_c order by {order}) current_temp_c, min(lo) min_forecast, max(hi) max_forecast,
              round(fsum(forecast_avgtemp_c) / count(*) * 100, 0) / 100 mean_forecast,
              first(created_date_local order by {order}) created,
              first(forecast_date order by hi desc, {order}) hottest from many group by name, region, country)
            select name, region, country, current_temp_c, min_forecast, max_forecast, mean_forecast,
              case when current_temp_c >= max_forecast then created else hottest end highest_temp_date,
              least(min_forecast, current_temp_c) min_temp, greatest(max_forecast, current_temp_c) max_temp from g""",
        "collapse_many_pulls": f"""with {MANY}, l as (select {keys},
              last(created_date_utc order by {order}) created_date_utc, last(forecast_avgtemp_c order by {order}) forecast_avgtemp_c,
              last(current_temp_last_updated order by {order}) filter (where oe is not null) current_temp_last_updated,
              last(current_temp_c order by {order}) filter (where oe is not null) current_temp_c
            from many group by {keys}) select * from l""",
        "json_edge_documents": _edge_sql(),
        "mean_precise": "select user_id, round(case when bool_or(user_id % 10 = 3 and event_type = 'error') then 'nan' :: double "
                        "else fsum(value / 70000000) / count(*) end * 1e15, 0) / 1e15 as mean from events group by user_id",
        "mean_wide": "select user_id, printf('%.10e', fsum(value * [1.0::double, 1e-9, 1e16, 1e300, 1e-290][case when user_id % 2 = 0 "
                     "then user_id else event_id end % 5 + 1]) / count(*)) as mean from events group by user_id",
        "saved_order": one_run("select name, region, country, created_date_local, forecast_date, cast(row_number() over (order by "
                               "name, region, country, created_date_local, forecast_date) as integer) n from mg"),
    }
    tables = {"location": ("loc", "lat"), "current_temp": ("cur", "temp_c"), "forecast_temp": ("fc", "avgtemp_c"),
              "merged": ("mg", "forecast_avgtemp_c"), "stats": ("sx", "max_forecast")}
    odd = "' \"' || name || '\",' || chr(10) || ' x '"
    out["csv_five_tables"] = one_run(" union all ".join(
        f"select '{t}' table_name, {odd} as name, count(*) n, "
        f"cast(round(sum(cast({v} as decimal(30,6))), 3) as double) total from {cte} group by name" for t, (cte, v) in tables.items()))
    runs = {"location": ("loc", "location"), "current": ("cur", "current_temp"), "forecast": ("fc", "forecast_temp"),
            "merged": ("mg", "merged"), "stats": ("sx", "stats")}
    both = (batch_ctes("1", before_day=D.FIRST_RUN_BEFORE, valid_only=True)
            + batch_ctes("2", first_day=D.SECOND_RUN_FROM, valid_only=True, warmer=True))
    for name, (cte, table) in runs.items():
        schema, table_keys = S.TABLES[table]
        sql = upsert_sql(f"{cte}1", f"{cte}2", table_keys, S.columns(schema))
        out[f"two_runs_{name}"] = with_ctes(both, _merged_recomputed(sql) if table == "merged" else sql)
    return out


def oracle_sql() -> dict[str, str]:
    from .. import schemas as S
    mcols = ", ".join(S.columns(S.MERGED_SCHEMA))
    q = {
        "merged": one_run(f"select {mcols} from mg"),
        "stats": one_run("select * from sx"),
        "highest_temp_date": one_run("select name, region, country, highest_temp_date from sx"),
        "horizontal_minmax": one_run(
            "select name, region, country, min_forecast, max_forecast, current_temp_c, min_temp, "
            "max_temp from sx"),
        "day_diff": one_run(
            "select name, region, country, created_date_local, date, "
            "cast(date - cast(created_date_local as date) as integer) day_diff from fc"),
        "forecast_error": one_run(
            "select name, region, country, created_date_local, forecast_date, day_diff, "
            "forecast_current_temp_diff from mg"),
        "to_date": one_run(
            "select name, region, country, created_date_local, last_updated, "
            "cast(created_date_local as date) created_day, cast(last_updated as date) data_date "
            "from cur"),
        "round2": "select event_id, value, round(value / 7 * 100, 0) / 100 value_r2 from events",
        "local_to_utc": one_run(
            "select name, region, country, tz_id, created_date_local, created_date_utc from p"),
        "current_vs_forecast": one_run(
            "select name, current_temp_c, forecast_current_temp_diff from mg where day_diff = 0"),
        "current_vs_forecast_count": one_run(
            "select count(*) n_tiles from mg where day_diff = 0"),
        "hottest_current": _extreme("current_temp_c", True),
        "coldest_current": _extreme("current_temp_c", False),
        "highest_forecast": _extreme("forecast_maxtemp_c", True),
        "lowest_forecast": _extreme("forecast_mintemp_c", False),
        "hottest_current_rows": _extreme_rows("current_temp_c", "max"),
        "coldest_current_rows": _extreme_rows("current_temp_c", "min"),
        "highest_forecast_rows": _extreme_rows("forecast_maxtemp_c", "max"),
        "lowest_forecast_rows": _extreme_rows("forecast_mintemp_c", "min"),
        "latest_snapshot": one_run(f"select {mcols} from {LATEST} s"),
        "city_range": one_run(_city_range()),
        "city_detail": one_run(_city_detail()),
        "city_range_one": one_run(f"select * from ({_city_range()}) where name = '{CITY}'"),
        "city_detail_one": one_run(f"select * from ({_city_detail()}) where name = '{CITY}'"),
        "place_names": one_run("select name from loc"),
        "stats_table": one_run("select * from sx"),
    }
    runs = {
        "upsert_location": ("loc", "location"),
        "upsert_current": ("cur", "current_temp"),
        "upsert_forecast": ("fc", "forecast_temp"),
        "upsert_stats": ("sx", "stats"),
    }
    for key, (cte, table) in runs.items():
        schema, keys = S.TABLES[table]
        q[key] = two_runs(upsert_sql(f"{cte}1", f"{cte}2", keys, S.columns(schema)))
    chance = "; ".join(f"forecast.forecastday[{i}].day.daily_chance_of_rain: expected a whole number"
                       for i in range(len(D.HORIZON_DAYS)))
    violations = (
        "concat_ws('; ', "
        f"case when {RULE} % {D.AWARE_TIME_EVERY} = 0 then 'location.localtime: timezone-aware datetime' end, "
        "case when obs_ts is null then 'current: missing' "
        f"when {RULE} % {D.BAD_CODE_EVERY} = 0 then 'current.condition.code: expected a whole number' end, "
        f"case when {RULE} % {D.BAD_CHANCE_EVERY} = 0 then '{chance}' end)")
    localtime = (f"strftime(created_date_local, '%Y-%m-%d %H:%M') || "
                 f"case when {RULE} % {D.AWARE_TIME_EVERY} = 0 then '{D.AWARE_SUFFIX}' else '' end")
    fcols = ", ".join(S.columns(S.FORECAST_SCHEMA))
    ccols = ", ".join(S.columns(S.CURRENT_SCHEMA))
    q.update({
        "json_source": one_run(
            f"select name label, name, {localtime} localtime, obs_ts is not null has_current, "
            f"{len(D.HORIZON_DAYS)} n_forecast_days from p"),
        "explode_map": one_run(
            "select name label, cast(row_number() over (partition by d, "
            f"user_id // {D.PLACES_PER_DOCUMENT} order by user_id) - 1 as integer) pos, "
            "region, country from p"),
        "validate_records": one_run(
            f"select name label, {localtime} localtime, {violations} violations from p"),
        "location_table": valid_run(
            "select name, region, country, lat, lon, tz_id, "
            "cast(epoch(created_date_utc) as bigint) localtime_epoch, created_date_local localtime "
            "from p"),
        "unnest_struct": valid_run(f"select {ccols} from cur"),
        "explode_forecast": valid_run(f"select {fcols} from fc"),
        "flatten": valid_run(f"select {mcols} from mg"),
        "csv_roundtrip": one_run(f"select {mcols} from mg"),
        "parse_dates": one_run(
            "select name, region, country, created_date_local, created_date_utc, forecast_date, "
            "current_temp_last_updated from mg"),
        "snapshot_read": one_run(f"select {mcols} from mg"),
        "weather_pipeline": valid_run("select * from sx"),
        "stream_ingest": valid_run(f"select {mcols} from mg"),
        "pipeline_by_day": valid_run(f"select {mcols} from mg"),
        "pipeline_location": valid_run(
            "select name, region, country, lat, lon, tz_id, localtime_epoch, localtime from loc"),
    })
    q.update(_more(S))
    zone = _case("n.n_regionkey", list(enumerate(D.REGION_ZONES)))
    sp, au = D.TRANSITION_DAYS["default"]
    day = f"case when event_id % 2 = 0 then '{sp}' else '{au}' end"
    for tz, (s1, a1) in D.TRANSITION_DAYS.items():
        if tz != "default":
            day = (f"case when tz_id = '{tz}' then (case when event_id % 2 = 0 then '{s1}' "
                   f"else '{a1}' end) else {day} end")
    q["local_to_utc_transitions"] = (
        "select event_id, tz_id, local_time, timezone('UTC', timezone(tz_id, local_time)) utc_time "
        "from (select event_id, tz_id, make_timestamp(year(d), month(d), day(d), "
        "cast(floor(m / 60) as bigint), m % 60, 0) local_time from ("
        f"select event_id, tz_id, cast({day} as date) d, "
        f"(hour(ts) * 60 + minute(ts)) % {D.TRANSITION_WINDOW_MINUTES} m from ("
        f"select e.event_id, e.ts, {zone} tz_id from events e "
        "join nation n on n.n_nationkey = e.user_id % 25)))")
    q["local_to_utc_zones"] = _zones()
    q["upsert_merged"] = two_runs(_merged_recomputed(
        upsert_sql("mg1", "mg2", S.MERGED_KEYS, S.columns(S.MERGED_SCHEMA))))
    return q


def _zones() -> str:
    """The zone library's own answer for every wall time that the query can ask for."""
    changes, rows = D.zone_changes(), []
    for k, (zone, base) in enumerate(changes):
        tz = pytz.timezone(zone)
        times = [base + dt.timedelta(minutes=15 * n) for n in range(D.ZONE_SLOTS)]
        late = [int((t - tz.localize(t).astimezone(pytz.UTC).replace(tzinfo=None)).total_seconds()) for t in times]
        rows.append(f"({k}, '{zone}', timestamp '{base}', {late})")
    n = len(changes)
    return ("select event_id, tz_id, local_time, local_time - to_seconds(late[slot + 1]) utc_time from ("
            "select event_id, tz_id, slot, late, base + to_minutes(15 * slot) local_time from ("
            f"select event_id, event_id % {n} k, (event_id // {n}) % {D.ZONE_SLOTS} slot from events where event_id is not null) "
            f"join (values {', '.join(rows)}) z(k, tz_id, base, late) using (k))")
