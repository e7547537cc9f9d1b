"""Hourly readings and timelines, against brute force over plain Python rows."""

import random
import re
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from delaylake import session
from delaylake.operators import timeline

OBS = (
    "airport_id int, WBAN string, obs_utc timestamp, SkyCondition string, "
    "WeatherType string, Visibility double"
)
TRIP = (
    "trip_key string, origin_airport_id int, dest_airport_id int, dep_ts_utc timestamp, "
    "arr_ts_utc timestamp, ARR_DELAY_NEW double, WEATHER_DELAY double, NAS_DELAY double, "
    "NAS_WEATHER_DELAY double, OP_CARRIER_AIRLINE_ID int, FL_NUM int, FL_DATE date, "
    "CRS_DEP_TIME int, year int, month string"
)
T0 = datetime(2012, 1, 10)


def observation(airport, wban, at, vis):
    return (airport, wban, at, None, None, vis)


def trip(key, o, d, dep, arr, delay=0.0):
    return (key, o, d, dep, arr, delay, 0.0, 0.0, 0.0, 1, 2, T0.date(), 900, 2012, "01")


@pytest.fixture(scope="module")
def world(spark):
    rnd = random.Random(5)
    obs = [
        observation(rnd.randrange(4), f"{rnd.randrange(3):05d}", T0 + timedelta(minutes=rnd.randrange(4 * 1440)), float(i))
        for i in range(1500)
    ]
    flown = []
    for i in range(400):
        dep = T0 + timedelta(minutes=rnd.randrange(-600, 5 * 1440))
        # Airport 1 gets most trips, airport 9 has no weather.
        o = rnd.choice([1, 1, 1, 0, 2, 3, 9])
        flown.append(trip(f"k{i}", o, rnd.choice([0, 1, 2, 9]), dep, dep + timedelta(minutes=rnd.randrange(900))))
    flown.append(trip("late", 1, 2, None, None))
    return obs, flown


def expected_hourly(obs):
    best = {}
    for a, w, at, _, _, vis in obs:
        hour = at.replace(minute=0, second=0)
        if (at - hour).total_seconds() <= 1200:
            key, rank = (a, hour), (at, w, vis)
            if key not in best or rank < best[key]:
                best[key] = rank
    return best


def test_hourly_edges(spark):
    h = T0
    minutes = {0: 19, 1: 20, 2: 20 + 1 / 60, 3: 53}
    obs = [observation(1, "a", h + timedelta(hours=k, minutes=m), float(k)) for k, m in minutes.items()]
    obs += [observation(1, "c", h + timedelta(hours=5), 2.0), observation(1, "b", h + timedelta(hours=5), 3.0)]
    got = timeline.hourly_observations(spark.createDataFrame(obs, OBS))
    assert rows(got.select("obs_hour", "WBAN", "vis"), "obs_hour") == [
        (h, "a", 0.0),
        (h + timedelta(hours=1), "a", 1.0),
        (h + timedelta(hours=5), "b", 3.0),
    ]


def test_hourly_matches_brute_force(spark, world):
    obs, _ = world
    want = {k: (w, vis) for k, (_, w, vis) in expected_hourly(obs).items()}
    for parts in (1, 7):
        df = spark.createDataFrame(obs, OBS).repartition(parts)
        got = timeline.hourly_observations(df).select("airport_id", "obs_hour", "WBAN", "vis").collect()
        assert {(r[0], r[1]): (r[2], r[3]) for r in got} == want


@pytest.mark.parametrize("shift_days", [0, -16_000])
def test_join_matches_brute_force(spark, world, shift_days):
    """Shifted, the days lie before 1970 and hours count below zero."""
    shift = timedelta(days=shift_days)
    obs = [(a, w, at + shift, *rest) for a, w, at, *rest in world[0]]
    flown = [
        (k, o, d, dep and dep + shift, arr and arr + shift, *rest)
        for k, o, d, dep, arr, *rest in world[1]
    ]
    trips = spark.createDataFrame(flown, TRIP)
    got = timeline.join_weather(trips, spark.createDataFrame(obs, OBS))
    best = expected_hourly(obs)

    def points(airport, ts):
        hour = ts.replace(minute=0, second=0)
        steps = [hour - timedelta(hours=i) for i in range(13)]
        return [(s, best[airport, s][2] if (airport, s) in best else None) for s in steps]

    out = got.select("trip_key", "Wo.o_ts", "Wo.o_vis", "Wd.d_ts", "Wd.d_vis").collect()
    assert len(out) == len(flown) - 1
    by_key = {t[0]: t for t in flown}
    for key, ots, ovis, dts, dvis in out:
        t = by_key[key]
        assert list(zip(ots, ovis)) == points(t[1], t[3]), key
        assert list(zip(dts, dvis)) == points(t[2], t[4]), key


def test_all_points_have_times_and_descend(spark, world):
    obs, flown = world
    got = timeline.join_weather(spark.createDataFrame(flown, TRIP), spark.createDataFrame(obs, OBS))
    for (ts,) in got.select("Wd.d_ts").collect():
        assert len(ts) == 13 and all(a - b == timedelta(hours=1) for a, b in zip(ts, ts[1:]))


def test_copies_of_a_trip_collapse(spark, world):
    obs, flown = world
    trips = spark.createDataFrame(flown + flown[:50] + [flown[0]] * 30, TRIP)
    got = timeline.join_weather(trips, spark.createDataFrame(obs, OBS))
    assert got.count() == len(flown) - 1
    assert got.select("trip_key").distinct().count() == len(flown) - 1


def test_prune_keeps_what_trips_need(spark, world):
    obs, flown = world
    few = spark.createDataFrame(flown[:1], TRIP)
    kept = timeline.within_trip_times(spark.createDataFrame(obs, OBS), few)
    low, high = flown[0][3] - timedelta(hours=12), flown[0][4] + timedelta(hours=12)
    assert kept.count() == sum(low <= o[2] <= high for o in obs)
    none = few.filter("false")
    assert timeline.within_trip_times(spark.createDataFrame(obs, OBS), none).count() == len(obs)


def test_nearest_hour_takes_readings_from_both_sides(spark):
    minutes = {0: 53, 1: 39, 3: 40, 5: 31, 6: 10}
    obs = [observation(1, "a", T0 + timedelta(hours=k, minutes=m), float(k)) for k, m in minutes.items()]
    df = spark.createDataFrame(obs, OBS)
    got = timeline.hourly_observations(df, mode="nearest")
    assert rows(got.select("obs_hour", "vis"), "obs_hour") == [
        (T0 + timedelta(hours=1), 0.0),
        (T0 + timedelta(hours=4), 3.0),
        (T0 + timedelta(hours=6), 6.0),
    ]
    with pytest.raises(ValueError):
        timeline.hourly_observations(df, mode="last")


def test_label(spark, world):
    obs, _ = world
    flown = [trip(str(i), 1, 2, T0, T0, d) for i, d in enumerate((59.9, 60.0, None))]
    base = timeline.join_weather(spark.createDataFrame(flown, TRIP), spark.createDataFrame(obs, OBS))
    got = timeline.label_trips(base, 60).select("F.trip_key", "C")
    assert rows(got, "trip_key") == [("0", 0), ("1", 1), ("2", 0)]


def test_observation_point_fills_missing_columns(spark):
    df = spark.createDataFrame([(T0, 3.0)], "obs_utc timestamp, Visibility double")
    point = df.select(timeline.observation_point(df, "o").alias("p")).first()["p"].asDict()
    assert point["o_ts"] == T0 and point["o_vis"] == 3.0 and point["o_sky"] is None
    assert len(point) == 13


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def by_key(df):
    return {r["trip_key"]: (r["Wo"], r["Wd"]) for r in df.select("trip_key", "Wo", "Wd").collect()}


def far_world(world):
    """Arrivals on the day itself, days later and days earlier, no weather, and copies of a trip."""
    obs, flown = world
    odd = [
        trip(f"far{i}", i % 4, (i + 1) % 4, T0 + timedelta(hours=40), T0 + timedelta(hours=40 + h))
        for i, h in enumerate((0, 1, 9, 20, 30, 55, 200, -30))
    ]
    odd.append(trip("nowhere", None, None, T0, T0))
    return obs, flown + odd + flown[:20]


def test_cells_give_the_same_timelines(spark, world, no_broadcast):
    obs, flown = far_world(world)
    trips, seen = spark.createDataFrame(flown, TRIP), spark.createDataFrame(obs, OBS)
    got = timeline.join_weather(trips, seen)
    base = timeline.unique_trips(timeline.complete_trips(trips))
    strips = timeline.weather_strips(timeline.hourly_observations(seen))
    plain = timeline.attach_timeline(timeline.attach_timeline(base, strips, "o"), strips, "d")
    want = by_key(plain)
    assert by_key(got) == want and got.count() == len(want) and {*got.columns} == {*plain.columns}
    for cells in (timeline.Cells(3), timeline.Cells(2, {timeline_day(T0): 7, timeline_day(T0) + 1: 1})):
        cut = timeline.attach_both(base, strips, trips, cells)
        assert by_key(cut) == want and cut.count() == len(want)


def timeline_day(at):
    return (at - datetime(1970, 1, 1)).days


def exchanged(df, capsys):
    """The input columns of each exchange of the plan."""
    capsys.readouterr()
    df.explain("formatted")
    nodes = re.split(r"\n\(\d+\) ", capsys.readouterr().out)
    return [n for n in nodes if n.startswith("Exchange")]


def test_no_row_with_a_timeline_is_moved(spark, world, no_broadcast, capsys):
    obs, flown = world
    trips, seen = spark.createDataFrame(flown, TRIP), spark.createDataFrame(obs, OBS)
    got = timeline.join_weather(trips, seen)
    moved = exchanged(got, capsys)
    assert moved and not [n for n in moved if "Wo#" in n]
    base, strips = timeline.complete_trips(trips), timeline.weather_strips(timeline.hourly_observations(seen))
    plain = timeline.attach_timeline(timeline.attach_timeline(base, strips, "o"), strips, "d")
    assert [n for n in exchanged(plain, capsys) if "Wo#" in n]


def test_no_row_with_a_timeline_is_sorted(spark, world, no_broadcast, capsys):
    obs, flown = world
    got = timeline.join_weather(spark.createDataFrame(flown, TRIP), spark.createDataFrame(obs, OBS))
    capsys.readouterr()
    got.explain("formatted")
    nodes = re.split(r"\n\(\d+\) ", capsys.readouterr().out)
    joins = [n.split()[0] for n in nodes if "Join type: LeftOuter" in n]
    assert joins == ["ShuffledHashJoin"] * 2
    assert not [n for n in nodes if n.startswith("Sort") and "Wo#" in n]


def test_small_strips_are_joined_plainly(spark, world, capsys):
    obs, flown = world
    got = timeline.join_weather(spark.createDataFrame(flown, TRIP), spark.createDataFrame(obs, OBS))
    capsys.readouterr()
    got.explain("formatted")
    assert "_part#" not in capsys.readouterr().out


def test_crowded_days_get_more_parts(spark):
    crowd = [trip(f"c{i}", 1, 2, T0, T0) for i in range(300)]
    calm = [trip(f"d{i}", 1, 2, T0 + timedelta(days=i % 20 + 1), T0 + timedelta(days=i)) for i in range(40)]
    cells = timeline.trip_cells(spark.createDataFrame(crowd + calm, TRIP), cell_trips=50)
    assert cells == timeline.Cells(2, {timeline_day(T0): 6})
    placed = spark.createDataFrame(crowd, TRIP).withColumns(cells.columns())
    assert placed.select("_part").distinct().count() == 6
    none = spark.createDataFrame([], TRIP)
    assert timeline.trip_cells(none) == timeline.Cells()


def test_no_trips_no_rows_without_broadcast(spark, world, no_broadcast):
    none = spark.createDataFrame([], TRIP)
    assert timeline.join_weather(none, spark.createDataFrame(world[0], OBS)).count() == 0


def test_broadcast_limit_reads_sizes(spark, no_broadcast):
    assert session.broadcast_limit(spark) == -1
    for text, size in (("10MB", 10 << 20), ("7", 7), ("3k", 3 << 10), ("10485760b", 10 << 20)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert session.broadcast_limit(spark) == size


def test_readings_are_rounded_before_the_trips_take_them(spark):
    from delaylake.catalogue import queries

    plan = queries.timeline_dest(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join LeftOuter", 1)
    assert "round(" not in above and "round(" in below


def test_copies_are_chosen_among_dealt_rows(spark):
    """The sort of the choice never holds a whole split of the files; one row per key, the smallest."""
    from delaylake.operators.trips import unique_trips

    df = spark.sql("select concat('k', id % 3) as trip_key, 9 - id as a from range(0, 9, 1, 4) union all select null, 5L union all select null, 4L")
    plan = unique_trips(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan.rsplit("SortAggregate", 1)[1]
    got = sorted((r["trip_key"] or "", r["a"]) for r in unique_trips(df).collect())
    assert got == [("", 4), ("k0", 3), ("k1", 2), ("k2", 1)]
