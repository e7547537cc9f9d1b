"""Raw trips, observations and mappings derived from the given tables.

Every row of the source table takes part. The expressions are plain SQL that
Spark and the checking engine both accept, so both sides start from the same
raw text; all typing, parsing and joining is done by the operators.

* trips: ``orders`` joined with ``customer``; delays, cancellations, unknown
  airports, copies, five-digit numbers, years before 1970 and dirty text follow
  from the order key
* observations: ``events``; station, measures and date spelling follow from
  user, value and event id; two stations in 27 are unknown to the mapping
* mappings: ``nation`` (clean) and ``supplier`` (several rows per station)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _text(expression: str) -> str:
    return f"cast({expression} as string)"


def _padded(expression: str, width: int) -> str:
    return f"lpad({_text(expression)}, {width}, '0')"


_DELAY = "((o_orderkey * 37) % 140)"
_CAUSE = "o_orderkey % 11"

TRIPS = {
    "FL_DATE": (
        f"{_text('case when o_orderkey % 101 = 0 then 1969 else 2012 + o_orderkey % 3 end')} || '-01-' || "
        f"{_padded('5 + dayofyear(o_orderdate) % 22', 2)}"
    ),
    "OP_CARRIER_AIRLINE_ID": _text("19000 + o_orderkey % 20"),
    "OP_CARRIER_FL_NUM": _text(
        "cast(floor(o_orderkey / 20) as bigint) + case when o_orderkey % 31 = 0 then 10000 else 0 end"
    ),
    "ORIGIN_AIRPORT_ID": _text("10000 + o_custkey % 26"),
    "DEST_AIRPORT_ID": _text("10000 + c_nationkey"),
    "CRS_DEP_TIME": (
        "case when o_orderkey % 501 = 0 then '2400' when o_orderkey % 307 = 0 then '12345' else "
        f"{_text('((o_orderkey * 7) % 24) * 100 + (o_orderkey * 13) % 60')} end"
    ),
    "CRS_ELAPSED_TIME": (
        "case when o_orderkey % 53 = 0 then null else "
        f"{_text('30 + o_orderkey % 300')} || '.0' end"
    ),
    "ARR_DELAY_NEW": (
        f"case when o_orderkey % 89 = 0 then null else {_text(_DELAY)} || '.00' end"
    ),
    "CANCELLED": "case when o_orderkey % 97 = 0 then '1.00' else '0.00' end",
    "DIVERTED": (
        "case when o_orderkey % 193 = 0 then '1.00' "
        "when o_orderkey % 7 = 0 then null else '0.00' end"
    ),
    "WEATHER_DELAY": (
        f"case when {_CAUSE} = 0 then "
        f"{_text(f'cast({_DELAY} - floor({_DELAY} / 2) as bigint)')} "
        f"when {_CAUSE} = 3 then {_text(f'cast(floor({_DELAY} / 3) as bigint)')} "
        f"when {_CAUSE} between 4 and 7 then null else '0' end"
    ),
    "NAS_DELAY": (
        "case when o_orderkey % 211 = 0 then 'M' "
        f"when {_CAUSE} = 0 then {_text(f'cast(floor({_DELAY} / 2) as bigint)')} "
        f"when {_CAUSE} in (1, 2) then {_text(f'{_DELAY} % 40')} "
        f"when {_CAUSE} between 4 and 7 then null else '0' end"
    ),
}

_STATION = "(user_id % 27) * 37 + 3"
_CENTS = "cast(round(value * 100) as bigint)"
_YEAR = _text("case when event_id % 37 = 0 then 1969 else 2012 + event_id % 3 end")
_DAY = _padded("day(ts)", 2)

OBSERVATIONS = {
    "WBAN": (
        f"case event_id % 5 when 0 then ' ' || {_padded(_STATION, 5)} || ' ' "
        f"when 1 then {_text(_STATION)} else {_padded(_STATION, 5)} end"
    ),
    "Date": (
        "case when event_id % 307 = 0 then 'bad' "
        f"when event_id % 4 = 0 then {_YEAR} || '01' || {_DAY} "
        f"when event_id % 4 = 1 then {_YEAR} || '-01-' || {_DAY} "
        f"when event_id % 4 = 2 then '01/' || {_DAY} || '/' || {_YEAR} "
        f"else {_YEAR} || '/01/' || {_DAY} end"
    ),
    "Time": (
        "case when event_id % 311 = 0 then '12345' else "
        f"{_text('hour(ts) * 100 + minute(ts)')} end"
    ),
    "SkyCondition": "case when event_id % 13 = 0 then ' ' else upper(event_type) end",
    "WeatherType": (
        "case event_type when 'error' then '+TSRA' when 'click' then 'SN' "
        "when 'view' then 'BR FG' when 'signup' then 'NA' else null end"
    ),
    "Visibility": (
        "case when event_id % 17 = 0 then 'M' else "
        f"{_text(f'{_CENTS} % 11')} || '.' || {_padded(f'{_CENTS} % 100', 2)} end"
    ),
    "DryBulbFarenheit": _text(f"{_CENTS} % 100"),
    "DryBulbCelsius": (
        f"case when event_id % 3 = 0 then 'M' else {_text(f'{_CENTS} % 40 - 10')} end"
    ),
    "DewPointFarenheit": (
        f"case when event_id % 19 = 0 then '' else {_text(f'{_CENTS} % 80')} end"
    ),
    "DewPointCelsius": (
        f"case when event_id % 4 = 0 then null else {_text(f'{_CENTS} % 30 - 10')} end"
    ),
    "WetBulbFarenheit": _text(f"{_CENTS} % 90"),
    "WetBulbCelsius": _text(f"{_CENTS} % 33"),
    "RelativeHumidity": _text(f"{_CENTS} % 101"),
    "WindSpeed": f"case when event_id % 23 = 0 then 'VR' else {_text(f'{_CENTS} % 50')} end",
    "WindDirection": _text(f"({_CENTS} % 37) * 10"),
    "Altimeter": f"'29.' || {_padded(f'{_CENTS} % 100', 2)}",
    "SeaLevelPressure": (
        f"case when event_id % 6 = 0 then null else '30.' || {_padded(f'{_CENTS} % 97', 2)} end"
    ),
    "StationPressure": f"'28.' || {_padded(f'{_CENTS} % 89', 2)}",
    "HourlyPrecip": (
        "case event_id % 5 when 0 then '' when 1 then 'T' else "
        f"{_text(f'{_CENTS} % 4')} || '.' || {_padded(f'{_CENTS} % 10', 2)} end"
    ),
}

OFFSETS = {
    "WBAN": _padded("n_nationkey * 37 + 3", 5),
    "AirportID": _text("10000 + n_nationkey"),
    "TimeZone": f"case when n_nationkey % 9 = 8 then null else {_text('n_nationkey % 12 - 6')} end",
}

ZONES = {
    "WBAN": f"' ' || {_padded('n_nationkey * 37 + 3', 5)}",
    "airport_id": _text("10000 + n_nationkey"),
    "timezone": (
        "case n_regionkey when 0 then 'America/New_York' when 1 then ' Europe/Paris' "
        "when 2 then 'Asia/Tokyo' when 3 then 'Australia/Sydney ' else null end"
    ),
}

REPEATED_OFFSETS = {
    "WBAN": _padded("s_nationkey * 37 + 3", 5),
    "AirportID": _text("10000 + s_nationkey"),
    "TimeZone": _text("s_suppkey % 7 - 3"),
    "zone_airport": _text("10000 + s_nationkey + s_suppkey % 2"),
    "zone": "case s_suppkey % 3 when 0 then 'Asia/Tokyo' when 1 then ' UTC ' else null end",
}


# Some trips come twice, as they do in files that overlap.
COPIES = "case when o_orderkey % 41 = 0 then array(1, 2) else array(1) end"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _derived(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{e} as `{n}`" for n, e in columns.items()))


def raw_trips(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = (table(spark, folder, t) for t in ("orders", "customer"))
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return _derived(placed.select("*", F.explode(F.expr(COPIES)).alias("copy")), TRIPS)


def raw_observations(spark: SparkSession, folder: str) -> DataFrame:
    return _derived(table(spark, folder, "events"), OBSERVATIONS)


def offset_mapping(spark: SparkSession, folder: str) -> DataFrame:
    return _derived(table(spark, folder, "nation"), OFFSETS)


def zone_mapping(spark: SparkSession, folder: str) -> DataFrame:
    return _derived(table(spark, folder, "nation"), ZONES)


def repeated_mapping(spark: SparkSession, folder: str) -> DataFrame:
    return _derived(table(spark, folder, "supplier"), REPEATED_OFFSETS)


LINE_COLUMNS = ["key", "price", "placed", "priority"]
# The kind of damage goes by the key; the SQL check has the same rules.
DAMAGED = """case cast(o_orderkey as bigint) % 97
  when 1 then concat_ws('|', o_orderkey, o_totalprice)
  when 2 then concat_ws('|', o_orderkey, o_totalprice, day, o_orderpriority, 'more')
  when 3 then concat_ws('|', o_orderkey, 'unknown', day, o_orderpriority)
  when 4 then concat_ws('|', o_orderkey, 'n/a', 'soon', o_orderpriority)
  when 5 then concat_ws('|', o_orderkey, '', day, o_orderpriority)
  else concat_ws('|', o_orderkey, o_totalprice, day, o_orderpriority) end as value"""


def damaged_lines(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr(
        "cast(o_orderkey as string) as o_orderkey",
        "cast(o_totalprice as decimal(18, 2)) as o_totalprice",
        "date_format(o_orderdate, 'yyyy-MM-dd') as day",
        "o_orderpriority",
    )
    return orders.selectExpr(DAMAGED)
