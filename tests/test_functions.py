"""Scalar operators on hand-written edge rows."""

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from delaylake.functions import clock, paths, values


def column(spark, dtype, items):
    data = [(i, v) for i, v in enumerate(items)]
    return spark.createDataFrame(data, f"i int, v {dtype}").orderBy("i")


def apply(spark, dtype, items, f):
    return [r[0] for r in column(spark, dtype, items).select(f(F.col("v"))).collect()]


def test_normalize_date(spark):
    given = ["20120115", "2012-01-15", "01/15/2012", "2012/01/15", "bad", "1/5/12", None]
    assert apply(spark, "string", given, clock.normalize_date) == [
        *["2012-01-15"] * 4,
        "bad",
        "1/5/12",
        None,
    ]


def test_text_timestamp_of_any_form(spark):
    data = [("20120115", "12345"), ("20120115", "5"), ("01/15/2012", "930"), ("bad", "930"), ("2012/01/15", "2400"), (None, "1")]
    df = spark.createDataFrame(data, "d string, t string")
    got = [r[0] for r in df.select(clock.text_timestamp(F.col("d"), F.col("t"))).collect()]
    assert got == [None, datetime(2012, 1, 15, 0, 5), datetime(2012, 1, 15, 9, 30), None, None, None]


@pytest.mark.parametrize("dtype", ["int", "string"])
def test_local_timestamp(spark, dtype):
    hhmm = [0, 5, 59, 100, 930, 2359, 2400, 1260, None]
    items = [None if v is None else (v if dtype == "int" else str(v)) for v in hhmm]
    got = apply(
        spark, dtype, items, lambda v: clock.local_timestamp(F.lit(date(2012, 1, 15)), v)
    )
    day = lambda h, m: datetime(2012, 1, 15, h, m)
    assert got == [
        day(0, 0), day(0, 5), day(0, 59), day(1, 0), day(9, 30), day(23, 59), None, None, None,
    ]


def test_midnight_at_the_end_of_the_day(spark):
    rolled = lambda v: clock.local_timestamp(F.lit(date(2012, 1, 31)), v, roll_2400=True)
    got = apply(spark, "int", [2400, 2359, 12400, None], rolled)
    assert got == [datetime(2012, 2, 1), datetime(2012, 1, 31, 23, 59), None, None]


def test_numbers(spark):
    given = ["1.5", "M", "", " ", "0.00", None]
    assert apply(spark, "string", given, values.real_number) == [1.5, None, None, None, 0.0, None]
    assert apply(spark, "string", given, values.whole_number) == [1, None, None, None, 0, None]


def test_station_id(spark):
    given = ["03013", "3013", " 3013 ", "a12", "123456", None]
    assert apply(spark, "string", given, values.station_id) == [
        "03013", "03013", "03013", "A12", "123456", None,
    ]


def test_utc_shift_and_zone(spark):
    noon = datetime(2012, 7, 1, 12)
    df = spark.createDataFrame([(noon, -5, "America/New_York"), (noon, None, None)], "t timestamp, o int, z string")
    got = df.select(
        clock.local_to_utc(F.col("t"), F.col("o")), clock.zone_to_utc(F.col("t"), F.col("z"))
    ).collect()
    assert tuple(got[0]) == (datetime(2012, 7, 1, 17), datetime(2012, 7, 1, 16))
    assert tuple(got[1]) == (None, noon)


def test_add_minutes_drops_subseconds(spark):
    df = spark.createDataFrame([(datetime(2012, 1, 1, 23, 59, 30, 500000),)], "t timestamp")
    got = df.select(clock.add_minutes(F.col("t"), F.lit(1))).first()[0]
    assert got == datetime(2012, 1, 2, 0, 0, 30)


def test_trip_key(spark):
    data = [(1, 12, date(2012, 1, 2), 10, 20), (None, 12345, date(2012, 1, 2), 10, 20)]
    df = spark.createDataFrame(data, "c int, n int, d date, o int, e int")
    got = [r[0] for r in df.select(values.trip_key(*(F.col(c) for c in "cndoe"))).collect()]
    assert got == ["1-0012-2012-01-02-10-20", "12345-2012-01-02-10-20"]


def test_celsius(spark):
    df = spark.createDataFrame([(5.0, 100.0), (None, 50.0), (None, None)], "c double, f double")
    got = [r[0] for r in df.select(values.celsius(F.col("c"), F.col("f"))).collect()]
    assert got == [5.0, pytest.approx(10.0), None]


def test_minutes_of_day_and_month(spark):
    assert apply(spark, "int", [0, 59, 930, 2359], clock.minutes_of_day) == [0, 59, 570, 1439]
    assert apply(spark, "timestamp", [datetime(2012, 1, 5)], clock.month_column) == ["01"]


def test_unit_hash_ignores_partitioning(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    draw = values.unit_hash(F.col("k"), 42)
    one = rows(df.coalesce(1).select("k", draw.alias("u")), "k")
    many = rows(df.repartition(7).select("k", draw.alias("u")), "k")
    assert one == many
    share = sum(u < 0.25 for _, u in one) / len(one)
    assert all(0 <= u < 1 for _, u in one) and 0.2 < share < 0.3


def test_paths(spark):
    df = spark.sql("select struct(1 as Arr_Delay, struct(2 as x) as g) as F, 3 as flat")
    assert paths.has_path(df.schema, "f.arr_delay") and paths.has_path(df.schema, "F.g.x")
    assert not paths.has_path(df.schema, "F.none") and not paths.has_path(df.schema, "flat.x")
    got = df.select(
        paths.coalesce_paths(df, ["F.none", "F.arr_delay"], F.lit(0.0)),
        paths.coalesce_paths(df, ["none"], F.lit(7.0)),
        paths.column_or_null(df, "none", "double"),
        paths.column_or(df, "flat", F.lit(0)),
    ).first()
    assert tuple(got) == (1.0, 7.0, None, 3)
