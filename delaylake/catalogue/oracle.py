"""SQL for the checking engine, one statement per registered query.

Built from named parts. Each statement is its part and everything that part
needs, so the timelines, for example, are rebuilt here the plain way: all 13
hours of each trip joined with the hourly readings.
"""

from __future__ import annotations

import re

from delaylake.catalogue import stand_ins
from delaylake.operators.features import WEATHER_VARIABLES, weather_feature_names

PARTS: dict[str, str] = {}
ORACLE_SQL: dict[str, str] = {}


def _derived(columns: dict[str, str], source: str) -> str:
    return f"select {', '.join(f'{e} as {n}' for n, e in columns.items())} from {source}"


def _num(c: str) -> str:
    return f"try_cast({c} as double)"


def _int(c: str) -> str:
    return f"cast(trunc(try_cast({c} as double)) as integer)"


def _station(c: str) -> str:
    text = f"upper(trim({c}))"
    return (
        f"case when regexp_full_match({text}, '[0-9]{{1,4}}') "
        f"then lpad({text}, 5, '0') else {text} end"
    )


def _stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def _rounded(c: str, digits: int = 6) -> str:
    return f"round({c}, {digits})"


PARTS["raw_trips"] = _derived(
    stand_ins.TRIPS,
    "orders join customer on o_custkey = c_custkey "
    "join (values (1), (2)) copies(copy) on copy = 1 or o_orderkey % 41 = 0",
)
PARTS["raw_obs"] = _derived(stand_ins.OBSERVATIONS, "events")
PARTS["raw_offsets"] = _derived(stand_ins.OFFSETS, "nation")
PARTS["raw_zones"] = _derived(stand_ins.ZONES, "nation")
PARTS["raw_repeated"] = _derived(stand_ins.REPEATED_OFFSETS, "supplier")

PARTS["offsets"] = f"""
select {_station('WBAN')} as wban, {_int('AirportID')} as airport_id,
       {_int('TimeZone')} as tz_hour
from raw_offsets"""
PARTS["zones"] = f"""
select {_station('WBAN')} as wban, {_int('airport_id')} as airport_id,
       trim(timezone) as timezone
from raw_zones"""

PARTS["typed_trips"] = f"""
select cast(FL_DATE as date) as fl_date,
       {_int('OP_CARRIER_AIRLINE_ID')} as carrier, {_int('OP_CARRIER_FL_NUM')} as fl_num,
       {_int('ORIGIN_AIRPORT_ID')} as origin, {_int('DEST_AIRPORT_ID')} as dest,
       {_int('CRS_DEP_TIME')} as crs, {_num('CRS_ELAPSED_TIME')} as elapsed,
       {_num('ARR_DELAY_NEW')} as arr, {_int('CANCELLED')} as cancelled,
       {_int('DIVERTED')} as diverted, {_num('WEATHER_DELAY')} as wd, {_num('NAS_DELAY')} as nas
from raw_trips"""
PARTS["bronze_trips"] = """
select t.*, o.tz_hour as origin_tz, d.tz_hour as dest_tz,
       cast(coalesce(elapsed, 0) as integer) as elapsed_min,
       case when crs // 100 <= 23 and crs % 100 <= 59
            then t.fl_date + to_minutes((crs // 100) * 60 + crs % 100) end as dep_local,
       dep_local - to_hours(o.tz_hour) as dep_utc,
       dep_local - to_hours(o.tz_hour) + to_minutes(elapsed_min) as arr_utc,
       cast(year(t.fl_date) as integer) as y, strftime(t.fl_date, '%m') as m
from typed_trips t
left join offsets o on o.airport_id = t.origin
left join offsets d on d.airport_id = t.dest"""
PARTS["silver_trips"] = """
select carrier, crs, arr, origin, dest, fl_date, fl_num, dep_utc, arr_utc, y, m,
       coalesce(wd, 0) as wd, coalesce(nas, 0) as nas,
       cast(case y when 2009 then 0.657 when 2010 then 0.636 when 2011 then 0.633
                   when 2012 then 0.588 when 2013 then 0.583 else 0.58 end as double) as alpha,
       alpha * coalesce(nas, 0) as nasw,
       coalesce(wd, 0) + alpha * coalesce(nas, 0) as total_wd,
       arr - (cast(1 as double) - alpha) * coalesce(nas, 0) as arr_nasw_raw,
       carrier || '-' || case when fl_num >= 1000 then cast(fl_num as varchar)
         else lpad(cast(fl_num as varchar), 4, '0') end || '-'
         || strftime(fl_date, '%Y-%m-%d') || '-' || origin || '-' || dest as trip_key
from bronze_trips
where coalesce(cancelled, 0) = 0 and coalesce(diverted, 0) = 0"""

_OBS_NUMBERS = [
    "Visibility",
    "DryBulbFarenheit",
    "DryBulbCelsius",
    "DewPointFarenheit",
    "DewPointCelsius",
    "RelativeHumidity",
    "WindSpeed",
    "WindDirection",
    "Altimeter",
    "SeaLevelPressure",
    "StationPressure",
    "HourlyPrecip",
    "WetBulbFarenheit",
    "WetBulbCelsius",
]
PARTS["days"] = """
select "Date" as raw_date,
  case when length("Date") = 8
         then "Date"[1:4] || '-' || "Date"[5:6] || '-' || "Date"[7:8]
       when regexp_full_match("Date", '[0-9]{2}/[0-9]{2}/[0-9]{4}')
         then "Date"[7:10] || '-' || "Date"[1:2] || '-' || "Date"[4:5]
       when regexp_full_match("Date", '[0-9]{4}/[0-9]{2}/[0-9]{2}')
         then replace("Date", '/', '-')
       else "Date" end as day,
  * from raw_obs"""
PARTS["bronze_obs"] = f"""
select {_station('WBAN')} as wban, "Date" as raw_date, "Time" as raw_time,
       SkyCondition, WeatherType,
       {', '.join(f'{_num(c)} as {c}' for c in _OBS_NUMBERS)},
       case when length("Time") <= 4
            then try_strptime(day || ' ' || lpad("Time", 4, '0'), '%Y-%m-%d %H%M') end as obs_local,
       cast(year(obs_local) as integer) as y, strftime(obs_local, '%m') as m
from days"""
PARTS["silver_obs"] = """
select s.airport_id, b.wban, obs_local - to_hours(coalesce(tz_hour, 0)) as obs_utc,
       SkyCondition, WeatherType, Visibility,
       coalesce(DryBulbCelsius, (DryBulbFarenheit - 32) * (cast(5 as double) / 9)) as TempC,
       coalesce(DewPointCelsius, (DewPointFarenheit - 32) * (cast(5 as double) / 9)) as DewPointC,
       RelativeHumidity, WindSpeed as WindSpeedKt, WindDirection, Altimeter,
       SeaLevelPressure, StationPressure, HourlyPrecip,
       cast(year(obs_utc) as integer) as y, strftime(obs_utc, '%m') as m
from bronze_obs b join offsets s on s.wban = b.wban
where s.airport_id is not null"""
PARTS["bounds"] = """
select min(dep_utc) - interval 12 hour as low, max(arr_utc) + interval 12 hour as high
from silver_trips where dep_utc is not null and arr_utc is not null"""
PARTS["pruned_obs"] = """
select * from silver_obs
where obs_utc between (select low from bounds) and (select high from bounds)"""

_POINT = {
    "sky": "SkyCondition",
    "wxType": "WeatherType",
    "vis": "Visibility",
    "tempC": "TempC",
    "dewC": "DewPointC",
    "rh": "RelativeHumidity",
    "windKt": "WindSpeedKt",
    "windDir": "WindDirection",
    "altim": "Altimeter",
    "slp": "SeaLevelPressure",
    "stnp": "StationPressure",
    "precip": "HourlyPrecip",
}
_TIES = ", ".join(f"{c} nulls first" for c in _POINT.values())


def _hourly(source: str) -> str:
    return f"""
select airport_id, hour, wban, obs_utc,
       {', '.join(f'{c} as {n}' for n, c in _POINT.items())}
from (select *, date_trunc('hour', obs_utc) as hour,
             row_number() over (
               partition by airport_id, date_trunc('hour', obs_utc)
               order by obs_utc, wban, {_TIES}) as place
      from {source} where obs_utc is not null)
where place = 1 and epoch(obs_utc) - epoch(hour) <= 20 * 60"""


PARTS["hourly"] = _hourly("silver_obs")
PARTS["hourly_nearest"] = f"""
select airport_id, hour, wban, obs_utc,
       {', '.join(f'{c} as {n}' for n, c in _POINT.items())}
from (select *, row_number() over (
               partition by airport_id, hour
               order by abs(epoch(obs_utc) - epoch(hour)), obs_utc, wban, {_TIES}) as place
      from (select *, date_trunc('hour', obs_utc + interval 30 minute) as hour
            from silver_obs where obs_utc is not null))
where place = 1 and abs(epoch(obs_utc) - epoch(hour)) <= 20 * 60"""
PARTS["trips"] = """
select distinct * from silver_trips where dep_utc is not null and arr_utc is not null"""


def _timeline(airport: str, ts: str) -> str:
    return f"""
select t.trip_key, cast(g.pos as integer) as pos,
       date_trunc('hour', t.{ts}) - to_hours(cast(g.pos as integer)) as ts,
       {', '.join(f'h.{n}' for n in _POINT)}
from trips t
join range(13) g(pos) on true
left join hourly h
  on h.airport_id = t.{airport}
 and h.hour = date_trunc('hour', t.{ts}) - to_hours(cast(g.pos as integer))"""


PARTS["points_o"] = _timeline("origin", "dep_utc")
PARTS["points_d"] = _timeline("dest", "arr_utc")


def _ends(prefix: str) -> str:
    return f"""
select trip_key as end_key, 13 as {prefix}_points,
       cast(count(vis) as integer) as {prefix}_vis_seen,
       {_stamp('max(ts)')} as {prefix}_first, {_stamp('min(ts)')} as {prefix}_last,
       string_agg(coalesce(wxType, '-'), ',' order by pos) as {prefix}_weather
from points_{prefix} group by trip_key"""


PARTS["ends_o"] = _ends("o")
PARTS["ends_d"] = _ends("d")
_ENDS = ", ".join(
    f"{p}_{n}" for p in "od" for n in ("points", "vis_seen", "first", "last", "weather")
)
PARTS["joined"] = """
select t.*, o.* exclude (end_key), d.* exclude (end_key)
from trips t
join ends_o o on o.end_key = t.trip_key
join ends_d d on d.end_key = t.trip_key"""

PARTS["measures"] = """
select *, arr_c - (nas_c - nasw) as adjusted,
       greatest(adjusted, 0) as arr_nasw,
       wd > 0 or nasw > 0 as has_meteo,
       (wd + nasw) / greatest(greatest(adjusted, 0), 1) as ratio
from (select *, greatest(coalesce(arr, 0), 0) as arr_c, greatest(nas, 0) as nas_c
      from trips)"""
PARTS["ths"] = "select unnest([15, 30, 45, 60, 90]) as th"
PARTS["classes"] = """
select m.*, cast(th as integer) as th, arr_c >= th as late,
       arr_c >= th and has_meteo and arr_nasw > 0 and ratio >= 0.95 as d1,
       arr_c >= th and (wd > 0 or nasw >= th) as d2,
       arr_c >= th and (wd > 0 or nasw > 0) as d3,
       arr_c >= th as d4
from measures m join ths on true"""
PARTS["counts"] = """
select th, count(*) filter (where d1) as cnt_d1, count(*) filter (where d2) as cnt_d2,
       count(*) filter (where d3) as cnt_d3, count(*) filter (where d4) as cnt_d4,
       count(*) filter (where not late) as cnt_neg
from classes group by th"""


def _keys(seed: int) -> str:
    return f"""
select c.trip_key, d.ds, c.th,
       case when d.pos then 1 else 0 end as is_pos,
       case when c.late then 1 else 0 end as C
from (select *, ('0x' || md5('{seed}|' || trip_key)[1:8])::ubigint / 4294967296.0::double as draw
      from classes) c
join counts n on n.th = c.th
cross join lateral (values
  ('D1', c.d1, n.cnt_d1), ('D2', c.d2, n.cnt_d2),
  ('D3', c.d3, n.cnt_d3), ('D4', c.d4, n.cnt_d4)) d(ds, pos, positives)
where d.pos
   or (not c.late and d.positives > 0
       and c.draw < least(1.0::double, d.positives::double / greatest(n.cnt_neg, 1)))"""


PARTS["keys"] = _keys(1234)
PARTS["keys42"] = _keys(42)
PARTS["targets"] = """
select j.*, k.ds, k.th, k.is_pos, k.C as c_th,
       case when coalesce(j.arr, 0) >= 15 then 1 else 0 end as c_ref
from joined j join keys k on k.trip_key = j.trip_key"""
PARTS["flat_all"] = """
select trip_key, ds, th, cast(is_pos as double) as label, carrier as carrier_id,
       origin as origin_id, dest as dest_id, fl_num as flnum, crs as crs_dep_time,
       y as year, cast(m as integer) as month, (crs // 100) * 60 + crs % 100 as dep_minutes
from targets
where carrier is not null and origin is not null
  and dest is not null and fl_num is not null and crs is not null"""
PARTS["flat"] = "select * from flat_all where ds = 'D2' and th = 60"
PARTS["split"] = """
select ds, th, count(*) filter (where not held) as train_rows,
       count(*) filter (where not held and label = 1) as train_positives,
       count(*) filter (where held) as test_rows,
       count(*) filter (where held and label = 1) as test_positives
from (select *, ('0x' || md5('42|' || trip_key)[1:8])::ubigint / 4294967296.0::double < 0.2 as held
      from flat_all)
group by ds, th"""


def _end_features(prefix: str, hours: int) -> str:
    def at(h: int, v: str) -> str:
        return f"max(case when pos = {h} then {v} end)"

    def share(v: str) -> str:
        filled = " + ".join(f"coalesce({at(h, v)}, 0)" for h in range(hours))
        return f"({filled})"

    def seen(test: str) -> str:
        return f"coalesce(max(case when pos < {hours} and {test} then 1 end), 0)::double"

    columns = []
    for h in range(hours):
        for v in WEATHER_VARIABLES:
            columns.append(f"coalesce({at(h, v)}, 0) as {prefix}_h{h}_{v}")
            columns.append(
                f"case when {at(h, v)} is null then 1 else 0 end::double as {prefix}_h{h}_{v}_isna"
            )
    summaries = {
        "vis_avg": f"{share('vis')} / {hours}",
        "temp_avg": f"{share('tempC')} / {hours}",
        "wind_avg": f"{share('windKt')} / {hours}",
        "precip_sum": share("precip"),
        "has_precip": seen("precip > 0"),
        "has_heavy_precip": seen("precip >= 2"),
        "has_low_vis": seen("vis < 1"),
        "has_ts": seen("wxType like '%TS%'"),
        "has_sn": seen("wxType like '%SN%'"),
        "has_fg": seen("wxType like '%FG%'"),
    }
    columns += [f"{e} as {prefix}_{n}" for n, e in summaries.items()]
    return (
        f"select trip_key as end_key, {', '.join(columns)} "
        f"from points_{prefix} group by trip_key"
    )


PARTS["features_o"] = _end_features("o", 3)
PARTS["features_d"] = _end_features("d", 2)
PARTS["features"] = """
select f.*, o.* exclude (end_key), d.* exclude (end_key)
from flat f
join features_o o on o.end_key = f.trip_key
join features_d d on d.end_key = f.trip_key"""
_FEATURES = weather_feature_names(3, 2)
PARTS["variances"] = " union all ".join(
    f"select '{n}' as feature, coalesce(var_samp({n}), 0) as variance from features"
    for n in _FEATURES
)


def needs(sql: str) -> list[str]:
    """Parts a statement uses, directly or through other parts, in order."""
    used: set[str] = set()

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in used and re.search(rf"\b(from|join)\s+{name}\b", text):
                used.add(name)
                visit(PARTS[name])

    visit(sql)
    return [name for name in PARTS if name in used]


def oracle(name: str, sql: str) -> None:
    parts = ",\n".join(f"{n} as ({PARTS[n]})" for n in needs(sql))
    ORACLE_SQL[name] = f"with {parts}\n{sql}" if parts else sql


# ---- sources and sinks ---------------------------------------------------

oracle("src_csv_roundtrip", f"select {', '.join(stand_ins.TRIPS)} from raw_trips")
oracle(
    "src_table_roundtrip",
    f"""select carrier as OP_CARRIER_AIRLINE_ID, fl_num as FL_NUM,
        strftime(fl_date, '%Y-%m-%d') as FL_DATE, y as year, m as month,
        {_stamp('dep_utc')} as dep_ts_utc, {_rounded('total_wd')} as total_weather_delay
        from silver_trips""",
)
_PAIRS = f"""select distinct {_station('WBAN')} as wban, {_int('AirportID')} as airport,
             {_int('TimeZone')} as tz, {_int('zone_airport')} as zone_airport,
             trim(zone) as zone from raw_repeated"""
oracle(
    "dim_dedup",
    f"""select kind, key, a, b from (
    select 'station_offset' as kind, wban as key, airport::varchar as a, tz::varchar as b,
      row_number() over (partition by wban order by airport nulls first, tz nulls first) as place
      from ({_PAIRS})
    union all
    select 'airport_offset', airport::varchar, tz::varchar, null,
      row_number() over (partition by airport order by tz nulls first) from ({_PAIRS})
    union all
    select 'station_zone', wban, zone_airport::varchar, zone,
      row_number() over (partition by wban order by zone_airport nulls first, zone nulls first)
      from ({_PAIRS})
    union all
    select 'airport_zone', zone_airport::varchar, zone, null,
      row_number() over (partition by zone_airport order by zone nulls first)
      from (select wban, zone_airport, zone,
              row_number() over (partition by wban
                order by zone_airport nulls first, zone nulls first) as station_place
            from ({_PAIRS})) where station_place = 1
    ) where place = 1""",
)

# ---- scalar operators ----------------------------------------------------

oracle("date_normalize", "select raw_date, day from days")
oracle(
    "local_ts",
    f"""select carrier as OP_CARRIER_AIRLINE_ID, fl_num as FL_NUM,
        {_stamp('dep_local')} as from_date, {_stamp('dep_local')} as from_parts
        from bronze_trips""",
)
oracle(
    "local_ts_rolled",
    f"""select carrier as OP_CARRIER_AIRLINE_ID, fl_num as FL_NUM,
        {_stamp("case when crs = 2400 then fl_date + interval 1 day else dep_local end")}
          as dep_local from bronze_trips""",
)
oracle(
    "utc_shift",
    f"""select carrier as OP_CARRIER_AIRLINE_ID, fl_num as FL_NUM,
        origin_tz::double as origin_tz, elapsed_min, {_stamp('dep_local')} as dep_local,
        {_stamp('dep_utc')} as dep_utc, {_stamp('arr_utc')} as arr_utc from bronze_trips""",
)
oracle(
    "year_month",
    """select y as year, m as month, count(*) as n from bronze_obs
       where obs_local is not null group by y, m""",
)
oracle("entity_key", "select trip_key, fl_num as FL_NUM from silver_trips")

# ---- bronze and silver ---------------------------------------------------

oracle(
    "role_join_tz",
    """select carrier as OP_CARRIER_AIRLINE_ID, fl_num as FL_NUM, origin as origin_airport_id,
       dest as dest_airport_id, origin_tz::double as origin_tz, dest_tz::double as dest_tz
       from bronze_trips""",
)
oracle(
    "trips_bronze",
    f"""select strftime(fl_date, '%Y-%m-%d') as FL_DATE, carrier as OP_CARRIER_AIRLINE_ID,
        fl_num as FL_NUM, origin as origin_airport_id, dest as dest_airport_id,
        crs as CRS_DEP_TIME, elapsed as CRS_ELAPSED_TIME, arr as ARR_DELAY_NEW,
        cancelled as CANCELLED, diverted::double as DIVERTED, wd as WEATHER_DELAY,
        nas as NAS_DELAY, {_stamp('dep_utc')} as dep_ts_utc, {_stamp('arr_utc')} as arr_ts_utc,
        y as year, m as month from bronze_trips""",
)
oracle(
    "trips_silver",
    f"""select carrier as OP_CARRIER_AIRLINE_ID, fl_num as FL_NUM,
        strftime(fl_date, '%Y-%m-%d') as FL_DATE, origin as origin_airport_id,
        dest as dest_airport_id, crs as CRS_DEP_TIME, {_stamp('dep_utc')} as dep_ts_utc,
        {_stamp('arr_utc')} as arr_ts_utc, y as year, m as month, arr as ARR_DELAY_NEW,
        wd as WEATHER_DELAY, nas as NAS_DELAY, alpha as alpha_nas,
        {_rounded('nasw')} as NAS_WEATHER_DELAY, {_rounded('total_wd')} as total_weather_delay,
        {_rounded('arr_nasw_raw')} as ARR_DELAY_NASW from silver_trips""",
)
oracle(
    "obs_bronze",
    f"""select wban as WBAN, SkyCondition, WeatherType, {', '.join(_OBS_NUMBERS)},
        {_stamp('obs_local')} as obs_local, y::double as year, m as month from bronze_obs""",
)
oracle(
    "obs_silver",
    f"""select airport_id, wban as WBAN, {_stamp('obs_utc')} as obs_utc, SkyCondition,
        WeatherType, Visibility, {_rounded('TempC')} as TempC,
        {_rounded('DewPointC')} as DewPointC, RelativeHumidity, WindSpeedKt, WindDirection,
        Altimeter, SeaLevelPressure, StationPressure, HourlyPrecip, y::double as year,
        m as month from silver_obs""",
)
oracle(
    "obs_utc_iana",
    f"""select z.airport_id, z.timezone, {_stamp('obs_local')} as obs_local,
        {_stamp('utc')} as obs_utc, wban as WBAN, Visibility, DryBulbFarenheit, WindSpeed,
        HourlyPrecip, cast(year(utc) as double) as year, strftime(utc, '%m') as month
        from (select z.airport_id, z.timezone, b.*,
                timezone('UTC', timezone(coalesce(z.timezone, 'UTC'), b.obs_local)) as utc
              from bronze_obs b join zones z on z.wban = b.wban
              where exists (select 1 from silver_trips t
                            where z.airport_id in (t.origin, t.dest))) z""",
)
oracle(
    "obs_airport_semi",
    """select airport_id, count(*) as n from silver_obs s
       where airport_id in (select origin from bronze_trips)
          or airport_id in (select dest from bronze_trips) group by airport_id""",
)
oracle(
    "airports_union",
    """select origin as airport_id from silver_trips
       union select dest from silver_trips""",
)
oracle(
    "join_loss_report",
    """select count(*) as rows_before, count(o.wban) as rows_after,
       count(*) - count(o.wban) as rows_lost,
       round(100.0::double * (count(*) - count(o.wban)) / count(*), 6) as loss_pct,
       100.0::double * (count(*) - count(o.wban)) / count(*) > 15 as alarm
       from bronze_obs b left join offsets o on o.wban = b.wban""",
)

# ---- timelines and the joined table --------------------------------------

oracle(
    "obs_temporal_prune",
    f"""select airport_id, wban as WBAN, {_stamp('obs_utc')} as obs_utc, Visibility,
        HourlyPrecip from pruned_obs""",
)
_POINT_ROUNDED = ", ".join(
    n if n in ("sky", "wxType") else f"{_rounded(n)} as {n}" for n in _POINT
)
oracle(
    "hourly_obs",
    f"""select airport_id, {_stamp('hour')} as obs_hour, wban as WBAN,
        {_stamp('obs_utc')} as obs_utc, {_POINT_ROUNDED} from hourly""",
)
oracle(
    "hourly_obs_nearest",
    f"""select airport_id, {_stamp('hour')} as obs_hour, wban as WBAN,
        {_stamp('obs_utc')} as obs_utc, {_POINT_ROUNDED} from hourly_nearest""",
)
oracle(
    "obs_points",
    f"select airport_id, {_stamp('obs_utc')} as o_ts, "
    + ", ".join(
        f"{c if n in ('sky', 'wxType') else _rounded(c)} as o_{n}" for n, c in _POINT.items()
    )
    + " from silver_obs",
)
for _prefix, _name in (("o", "timeline_origin"), ("d", "timeline_dest")):
    oracle(
        _name,
        f"select trip_key, pos, {_stamp('ts')} as ts, {_POINT_ROUNDED} from points_{_prefix}",
    )
oracle(
    "jt_base",
    f"""select trip_key, origin as origin_airport_id, dest as dest_airport_id,
        {_stamp('dep_utc')} as dep_ts_utc, {_stamp('arr_utc')} as arr_ts_utc,
        arr as ARR_DELAY_NEW, {_rounded('nasw')} as NAS_WEATHER_DELAY, y as year, m as month,
        {_ENDS} from joined""",
)
oracle(
    "jt_labeled",
    f"""select trip_key, carrier, fl_num as flnum, strftime(fl_date, '%Y-%m-%d') as date,
        crs as crs_dep_scheduled_hhmm, arr as arr_delay_new, wd as weather_delay,
        nas as nas_delay, {_rounded('nasw')} as nas_weather_delay,
        case when arr >= 15 then 1 else 0 end as C, y as year, m as month, {_ENDS}
        from joined""",
)
oracle(
    "label_threshold",
    """select trip_key, arr as arr_delay_new, case when arr >= 60 then 1 else 0 end as C
       from trips""",
)

# ---- targets -------------------------------------------------------------

oracle(
    "ratio_metrics",
    f"""select trip_key, arr_c as ARR_DELAY_NEW, wd as WEATHER_DELAY, nas_c as NAS_DELAY,
        {_rounded('nasw')} as NAS_WEATHER_DELAY, {_rounded('arr_nasw')} as ARR_NASW,
        {_rounded('ratio')} as ratio_adj, has_meteo from measures""",
)
oracle("class_counts", "select * from counts")
oracle("balanced_keys", "select * from keys42 where th = 60")
oracle("keys_all", "select * from keys")
oracle(
    "targets_all",
    f"""select trip_key, ds, th, is_pos, c_ref, c_th, y as year, m as month, {_ENDS}
        from targets""",
)
oracle(
    "target_slice",
    "select is_pos, count(*) as n from targets where ds = 'D2' and th = 60 group by is_pos",
)
oracle(
    "target_sample",
    """select carrier, fl_num as flnum, strftime(fl_date, '%Y-%m-%d') as date,
       c_ref as C, is_pos
       from targets where ds = 'D2' and th = 60 order by trip_key limit 20""",
)
oracle(
    "target_reattach",
    f"""select trip_key, ds, th, is_pos, c_ref as C, carrier,
        {', '.join(c for c in _ENDS.split(', ') if c.startswith('o_'))}
        from targets where th = 60""",
)
_EXPLAINED = "has_meteo and arr_nasw > 0"
oracle(
    "tau_grid",
    f"""select tau, count(*) filter (where {_EXPLAINED} and ratio >= tau) as count
        from measures
        join (select unnest([0.8, 0.85, 0.9, 0.92, 0.95, 0.98, 1.0])::double as tau) on true
        group by tau""",
)
oracle(
    "tau_one",
    f"""select count(*) as total_rows, count(*) filter (where has_meteo) as rows_with_meteo,
        count(*) filter (where {_EXPLAINED} and abs(ratio - 1) <= 1e-6) as tau1_strict,
        count(*) filter (where {_EXPLAINED} and ratio >= 1.0::double - 0.01::double) as tau1_loose
        from measures""",
)
oracle(
    "ratio_hist",
    """select case when isnan(ratio) or isinf(ratio) then 'NaN/Inf'
         when ratio < 0 then '<0.00' when ratio >= 1.2::double then '>=1.20'
         else printf('[%.2f,%.2f)', floor(ratio / 0.05::double) * 0.05::double,
                     floor(ratio / 0.05::double) * 0.05::double + 0.05::double) end as bucket,
       count(*) as count from measures group by 1""",
)

# ---- quality reports -----------------------------------------------------

oracle(
    "nulls_wide",
    "select "
    + ", ".join(
        f"""count(*) filter (where "{c}" is null or trim("{c}") = ''
            or lower("{c}") in ('na', 'null')) as "{c}\""""
        for c in stand_ins.OBSERVATIONS
    )
    + ", count(*) as _rows from raw_obs",
)
_OBS_TYPES = (
    [("WBAN", "wban", "string"), ("Date", "raw_date", "string"), ("Time", "raw_time", "string")]
    + [(c, c, "string") for c in ("SkyCondition", "WeatherType")]
    + [(c, c, "double") for c in _OBS_NUMBERS]
    + [("obs_local_naive", "obs_local", "timestamp"), ("year", "y", "int"), ("month", "m", "string")]
)
oracle(
    "nulls_long",
    " union all ".join(
        f"""select '{name}' as "column", '{dtype}' as dtype,
            count(*) filter (where {c} is null) as nulls,
            count(*) filter (where {f'isnan({c})' if dtype == 'double' else 'false'}) as nans,
            count(*) as total,
            round((count(*) filter (where {c} is null))::double / count(*), 6) as null_rate,
            round((count(*) filter
              (where {f'isnan({c})' if dtype == 'double' else 'false'}))::double
              / count(*), 6) as nan_rate
            from bronze_obs"""
        for name, c, dtype in _OBS_TYPES
    ),
)
oracle(
    "obs_check",
    " union all ".join(
        f"""select '{c}' as field, true as present,
            (count(*) filter (where {c} is null))::double as nulls,
            round(100.0::double * (count(*) filter (where {c} is null)) / count(*), 6) as null_pct,
            count(*) as total, count(distinct wban) as stations from bronze_obs"""
        for c in [*_OBS_NUMBERS[:12], "SkyCondition", "WeatherType"]
    )
    + """ union all select 'TempC', false, null, null, count(*), count(distinct wban)
          from bronze_obs""",
)
oracle(
    "uniques_exact",
    """select count(distinct carrier) as OP_CARRIER_AIRLINE_ID,
       count(distinct fl_num) as FL_NUM, count(distinct origin) as origin_airport_id,
       count(distinct dest) as dest_airport_id, count(distinct y) as year,
       count(distinct m) as month, count(*) as _rows from bronze_trips""",
)
oracle(
    "delay_quantiles",
    " union all ".join(
        f"""select '{name}' as "column", """
        + ", ".join(
            f"{_rounded(f'quantile_disc({c}, {q})')} as {n}"
            for n, q in (("p50", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99))
        )
        + " from silver_trips"
        for name, c in (
            ("ARR_DELAY_NEW", "arr"),
            ("WEATHER_DELAY", "wd"),
            ("NAS_DELAY", "nas"),
            ("total_weather_delay", "total_wd"),
        )
    ),
)
_NO_CAUSE, _CAUSE = "wd = 0 and nas = 0", "(wd <> 0 or nas <> 0)"
oracle(
    "delay_rules",
    " union all ".join(
        f"""select '{label}' as "check", count(*) filter (where {test}) as "rows"
            from silver_trips"""
        for label, test in (
            ("bothZero -> arr<15 (OK)", f"{_NO_CAUSE} and arr < 15"),
            ("bothZero -> arr>=15 (VIOL)", f"{_NO_CAUSE} and arr >= 15"),
            ("nonZero -> arr>=15 (OK)", f"{_CAUSE} and arr >= 15"),
            ("nonZero -> arr<15 (VIOL)", f"{_CAUSE} and arr < 15"),
            ("total rows", "true"),
        )
    ),
)
_SHOWN = """strftime(fl_date, '%Y-%m-%d') as FL_DATE, fl_num as FL_NUM,
  origin as origin_airport_id, dest as dest_airport_id, arr as ARR_DELAY_NEW,
  wd as WEATHER_DELAY, nas as NAS_DELAY, round(total_wd, 6) as total_weather_delay"""
oracle(
    "rule_violations",
    " union all ".join(
        f"""select * from (select {_SHOWN}, '{tag}' as rule from silver_trips where {test}
            order by fl_date, fl_num, origin, dest, arr, wd, nas, total_wd limit 50)"""
        for tag, test in (
            ("bothZero->arr>=15", f"{_NO_CAUSE} and arr >= 15"),
            ("nonZero->arr<15", f"{_CAUSE} and arr < 15"),
        )
    ),
)

# ---- diagnostics ---------------------------------------------------------

oracle(
    "array_population",
    " union all ".join(
        f"""select '{a}' as timeline, count(*) as filled, avg({p}_points) as mean_size,
            stddev_samp({p}_points) as std_size, min({p}_points) as min_size,
            max({p}_points) as max_size, count(*) filter (where {p}_points = 0) as empty,
            count(*) filter (where o_points > 0 and d_points > 0) as both_filled,
            count(*) as total,
            round(100.0::double * (count(*) filter (where {p}_points = 0)) / count(*), 6)
              as empty_pct from joined"""
        for p, a in (("o", "Wo"), ("d", "Wd"))
    ),
)
oracle(
    "array_size_hist",
    " union all ".join(
        f"""select '{a}' as timeline, {p}_points as size, count(*) as n from joined
            group by {p}_points"""
        for p, a in (("o", "Wo"), ("d", "Wd"))
    ),
)
_ALL_NULL = " and ".join(f"{n} is null" for n in _POINT)
oracle(
    "struct_null_rates",
    " union all ".join(
        f"""select '{a}' as timeline, '{label}' as field,
            count(*) filter (where {test}) as nulls, count(*) as total,
            round(100.0::double * (count(*) filter (where {test})) / count(*), 6) as null_pct
            from points_{p} where pos = 0"""
        for p, a in (("o", "Wo"), ("d", "Wd"))
        for label, test in [(f"{p}_{n}", f"{n} is null") for n in _POINT]
        + [("all fields", _ALL_NULL)]
    ),
)
oracle(
    "uniques_approx",
    " union all ".join(
        f"""select '{name}' as "column", count(distinct {c}) as distinct_values, true as close
            from silver_trips"""
        for name, c in (
            ("FL_NUM", "fl_num"),
            ("origin_airport_id", "origin"),
            ("dest_airport_id", "dest"),
            ("year", "y"),
            ("month", "m"),
        )
    ),
)
oracle("feature_variance", "select feature, round(variance, 4) as variance from variances")
oracle(
    "variance_extremes",
    """select feature, round(variance, 4) as variance, "end" from (
       select feature, variance, 'top' as "end",
              row_number() over (order by round(variance, 6) desc, feature) as place from variances
       union all
       select feature, variance, 'bottom',
              row_number() over (order by round(variance, 6), feature desc) from variances)
       where place <= 20""",
)
oracle(
    "feature_stats",
    " union all ".join(
        f"""select '{n}' as feature, round(avg({n}), 6) as mean,
            round(stddev_samp({n}), 6) as std, round(min({n}), 6) as min,
            round(max({n}), 6) as max from features"""
        for n in [
            f"{p}_{s}"
            for p in "od"
            for s in ("vis_avg", "temp_avg", "wind_avg", "precip_sum")
        ]
    ),
)
_SERVED = "(select origin as a from silver_trips union select dest from silver_trips)"
_WEATHER = "(select distinct airport_id as a from silver_obs)"
oracle(
    "coverage_overlap",
    f"""select (select count(*) from {_WEATHER}) as weather_airports,
        (select count(distinct origin) from silver_trips) as origin_airports,
        (select count(distinct dest) from silver_trips) as dest_airports,
        (select count(*) from {_SERVED}) as trip_airports,
        (select count(*) from ({_SERVED} intersect {_WEATHER})) as in_both,
        (select count(*) from ({_SERVED} except {_WEATHER})) as trips_only,
        (select count(*) from ({_WEATHER} except {_SERVED})) as weather_only""",
)
oracle(
    "coverage_missing",
    f"""select a as airport_id, 'weather' as missing from ({_SERVED} except {_WEATHER})
        union all
        select a, 'trips' from ({_WEATHER} except {_SERVED})""",
)
oracle(
    "temporal_coverage",
    f"""select 'weather' as source, {_stamp('min(obs_utc)')} as min_ts,
        {_stamp('max(obs_utc)')} as max_ts, count(*) as "rows" from silver_obs
        union all
        select 'trips', {_stamp('min(dep_utc)')}, {_stamp('max(dep_utc)')}, count(*)
        from silver_trips""",
)
oracle(
    "obs_per_station",
    """select airport_id, count(*) as obs_count from silver_obs group by airport_id
       order by obs_count desc, airport_id limit 20""",
)

_BUCKETS = ORACLE_SQL["ratio_hist"].rsplit("select case", 1)[1]
oracle(
    "report_sets",
    f"""select 'trips_nulls' as report, 1::bigint as n
        union all select unnest(['trips_uniques', 'readings_nulls', 'readings_uniques', 'tau_one']), 1
        union all select 'nulls_report', 17
        union all select 'uniques_report', 5
        union all select 'quantiles_report', 4
        union all select 'delay_rules', 5
        union all select 'delay_rules_violations_sample',
          (select least(50, count(*)) from silver_trips where {_NO_CAUSE} and arr >= 15)
          + (select least(50, count(*)) from silver_trips where {_CAUSE} and arr < 15)
        union all select 'counts_by_tau', 7
        union all select 'hist_ratio_adj', count(*) from (select case{_BUCKETS})""",
)
oracle(
    "diagnostic_set",
    f"""select report, cast(n as bigint) as n from (values ('array_population', 2), ('struct_nulls', 26),
          ('observation_check', 14), ('coverage', 1), ('temporal_coverage', 2),
          ('variance_extremes', 40), ('variance_counts', 1), ('feature_statistics', 8)) fixed(report, n)
        union all select unnest(['newest_origin_points', 'newest_dest_points']),
          (select least(5, count(*)) from targets where ds = 'D2' and th = 60)
        union all select 'array_sizes', (select count(distinct o_points) + count(distinct d_points)
          from targets where ds = 'D2' and th = 60)
        union all select 'observation_sample', (select least(10, count(*)) from bronze_obs)
        union all select 'missing_airports', (select count(*) from ({_SERVED} except {_WEATHER}))
        union all select 'per_airport', (select least(20, count(*)) from {_WEATHER})
        union all select 'feature_sample', (select least(10, count(*)) from flat)""",
)

# ---- features and models -------------------------------------------------

oracle("flat_features", "select * from flat")
oracle(
    "wx_features",
    "select trip_key, label, "
    + ", ".join(f"{_rounded(n)} as {n}" for n in _FEATURES)
    + " from features",
)
oracle(
    "train_test_split",
    """select trip_key, label,
       case when ('0x' || md5('42|' || trip_key)[1:8])::ubigint / 4294967296.0::double < 0.2
            then 'test' else 'train' end as part from flat""",
)
_SEEN_AVERAGES = ", ".join(
    f"round(coalesce(avg({v}) filter (where pos < {{hours}}), 0), 6) as {{p}}_{n}_avg"
    for n, v in (("vis", "vis"), ("temp", "tempC"), ("wind", "windKt"))
)
oracle(
    "wx_ignore_missing",
    f"""select trip_key, o.* exclude (k), d.* exclude (k) from flat
        join (select trip_key as k, {_SEEN_AVERAGES.format(p="o", hours=3)}
              from points_o group by trip_key) o on o.k = flat.trip_key
        join (select trip_key as k, {_SEEN_AVERAGES.format(p="d", hours=2)}
              from points_d group by trip_key) d on d.k = flat.trip_key""",
)
oracle(
    "ml_rf",
    f"""select train_rows, train_positives, test_rows, test_positives, true as areas_fit,
        {len(weather_feature_names(3, 3)) + 6}::bigint as features, 1.0::double as importance
        from split where ds = 'D2' and th = 60""",
)
oracle(
    "ml_grid",
    """select tag, s.ds, s.th, origin_hours, dest_hours,
       case when train_positives > 0 and train_positives < train_rows and test_rows > 0
            then 'ok' else 'empty' end as status,
       train_rows, train_positives, test_rows, test_positives
       from split s join (
         select study || ':' || ds || ':' || th || 'min:o' || o || ':d' || d as tag, ds, th,
                o as origin_hours, d as dest_hours
         from (select 'baseline' as study, 'D2' as ds, 60 as th, 0 as o, 0 as d
           union all select 'window', 'D2', 60, h, 0 from (select unnest([1, 3, 5, 7, 9, 11]) as h)
           union all select 'window', 'D2', 60, 0, h from (select unnest([1, 3, 5, 7, 9, 11]) as h)
           union all select 'window', 'D2', 60, 7, 7
           union all select 'threshold', 'D2', t, 7, 7 from (select unnest([15, 30, 45, 60, 90]) as t)
           union all select 'dataset', unnest(['D1', 'D3', 'D4']), 60, 7, 7)) e on e.ds = s.ds and e.th = s.th""",
)
oracle(
    "stage_rerun",
    f"""select trip_key, ds, th, is_pos, c_ref, y as year, m as month,
        {', '.join(c for c in _ENDS.split(', ') if c.startswith('o_'))}
        from targets where th = 60""",
)
oracle(
    "clf_metrics",
    """select round(avg(((arr_c >= 60) = (arr_nasw >= 50))::integer), 6) as accuracy,
       round(avg((arr_nasw >= 50)::integer) filter (where arr_c >= 60), 6) as recall,
       round(avg((arr_c >= 60)::integer) filter (where arr_nasw >= 50), 6) as "precision"
       from measures""",
)
oracle(
    "gold_incremental",
    """select ds, th, y as year, m as month, count(*) as n, sum(is_pos)::bigint as positives,
       sum(o_vis_seen)::bigint as o_vis_seen, y = 2014 as joined_last
       from targets where th = 60 group by ds, th, y, m""",
)
oracle(
    "delay_quantile_sketches",
    " union all ".join(
        f"""select '{name}' as "column", count({c}) as n, true as p50_held, true as p90_held,
            true as p95_held, true as p99_held from silver_trips"""
        for name, c in (
            ("ARR_DELAY_NEW", "arr"),
            ("WEATHER_DELAY", "wd"),
            ("NAS_DELAY", "nas"),
            ("total_weather_delay", "total_wd"),
        )
    ),
)
oracle(
    "equal_keys",
    """select trip_key, ds, th, is_pos, is_pos as C from (
       select c.trip_key, d.ds, c.th, case when d.pos then 1 else 0 end as is_pos, c.late, d.positives,
         row_number() over (partition by d.ds, c.th, c.late order by c.draw, c.trip_key) as place
       from (select *, ('0x' || md5('42|' || trip_key)[1:15])::bigint as draw from classes) c
       join counts n on n.th = c.th
       cross join lateral (values
         ('D1', c.d1, n.cnt_d1), ('D2', c.d2, n.cnt_d2),
         ('D3', c.d3, n.cnt_d3), ('D4', c.d4, n.cnt_d4)) d(ds, pos, positives))
       where is_pos = 1 or (not late and place <= positives)""",
)
oracle(
    "uniques_sketched",
    " union all ".join(
        f"""select '{name}' as "column", count(*) as "rows", count(distinct {c}) as distinct_values, true as "close"
            from silver_trips"""
        for name, c in (
            ("FL_NUM", "fl_num"),
            ("origin_airport_id", "origin"),
            ("dest_airport_id", "dest"),
            ("year", "y"),
            ("month", "m"),
        )
    ),
)
_PRICE, _DAY = "cast(o_totalprice as decimal(18, 2))", "strftime(o_orderdate, '%Y-%m-%d')"
oracle(
    "src_csv_inferred",
    f"""select o_orderkey as key, case when o_orderkey % 97 <> 5 then round({_PRICE}::double, 6) end as price,
       {_DAY} as placed, o_orderpriority as priority, 'int,double,date,string' as types
       from orders where o_orderkey % 97 not in (1, 2, 3, 4)""",
)
oracle(
    "src_csv_quarantine",
    f"""select o_orderkey::varchar as key,
       case o_orderkey % 97 when 3 then 'unknown' when 4 then 'n/a' else {_PRICE}::varchar end as price,
       case o_orderkey % 97 when 1 then null when 4 then 'soon' else {_DAY} end as placed,
       case o_orderkey % 97
         when 1 then o_orderkey || '|' || {_PRICE}
         when 2 then o_orderkey || '|' || {_PRICE} || '|' || {_DAY} || '|' || o_orderpriority || '|more' end as line,
       case o_orderkey % 97 when 3 then 'price' when 4 then 'price,placed' else '' end as misfits
       from orders where o_orderkey % 97 in (1, 2, 3, 4)""",
)
