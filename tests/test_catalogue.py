"""Every registered query against its SQL on the small tables."""

import re

import check
import pytest

import __spark_entry__ as spark_entry
from delaylake.catalogue import oracle, queries
from delaylake.operators import targets

SF = "/root/testdata/sf0.001"
QUERIES = spark_entry.queries()
ORACLES = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return check.duck(SF)


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(queries.QUERIES) == set(oracle.ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF).toArrow()
    theirs = check.arrow(duck.sql(ORACLES[name]))
    assert check.differences(ours, theirs) == []
    assert ours.num_rows > 0


@pytest.mark.parametrize("name", ["obs_airport_semi", "obs_utc_iana"])
def test_readings_are_not_shuffled_for_their_airport(spark, name):
    """Also where no table is small enough to be broadcast by its size."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    given = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        physical = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, given)
    assert "strategy=broadcast" in plan
    readings = [b for b in physical.split("Exchange hashpartitioning(airport_id") if "event_id" in b]
    assert len(readings) <= 2 and "SortMergeJoin [airport_id" not in physical.split("event_id")[0][-4000:]


def test_stored_targets_hold_a_trip_once(spark):
    stored = queries.stored_targets(spark, SF)
    assert stored.count() == stored.select("trip_key").distinct().count() > 0


def test_stored_targets_are_joined_by_the_slices_that_read_them(spark):
    """The files hold no timelines, and a slice attaches those of its own trips only."""
    stored = queries.stored_targets(spark, SF)
    [path] = [p for (_, name, sf), p in queries._STORED.items() if (name, sf) == ("targets", SF)][-1:]
    assert set(spark.read.parquet(path).columns) == {"F", "C", "trip_key", "year", "month", "members"}
    plan = targets.target_slice(stored)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join LeftOuter", 1)
    assert "D2-60" in below and not re.search(r"^ *\+- Filter", above, re.M)
    lazy = targets.target_slice(queries.packed_targets(spark, SF, targets.THRESHOLDS))
    key = ["trip_key", "is_pos", "Wo", "Wd"]
    ours, theirs = (sorted(map(str, df.select(*key).collect())) for df in (targets.target_slice(stored), lazy))
    assert ours == theirs


def test_a_slice_chooses_its_trips_before_the_weather(spark):
    """No trip is multiplied by the datasets, and the slice's filter lies below the timelines' joins."""
    rows = targets.target_slice(queries.packed_targets(spark, SF))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join LeftOuter", 1)
    assert "Generate inline(filter" not in plan
    assert "D2-60" in below and not re.search(r"^ *\+- Filter", above, re.M)


def test_entry(spark):
    assert spark_entry.entry(spark).limit(1).count() == 1
