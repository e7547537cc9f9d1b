"""Raw files to reports, with stored tables and without."""

import os

import pytest
from conftest import rows

from delaylake.catalogue import stand_ins
from delaylake.operators import targets
from delaylake.plans import stages
from delaylake.sources import files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")

    def save(df, folder, suffix):
        """Two files per source, as two months would be."""
        os.makedirs(base / folder, exist_ok=True)
        pdf = df.toPandas()
        for i, month in enumerate(("201201", "201202")):
            pdf.iloc[i::2].to_csv(base / folder / f"{month}{suffix}", index=False)

    save(stand_ins.raw_trips(spark, SF), "trips", ".csv")
    save(stand_ins.raw_observations(spark, SF), "obs", "hourly.txt")
    mapping = base / "mapping.csv"
    stand_ins.offset_mapping(spark, SF).toPandas().to_csv(mapping, index=False)
    return stages.RawInputs(
        str(base / "trips"), str(base / "obs"), str(mapping), ["201201", "201202"]
    )


@pytest.fixture(scope="module")
def stored(spark, raw, tmp_path_factory):
    lake = stages.Lake(str(tmp_path_factory.mktemp("lake")))
    return lake, stages.run_gold(spark, raw, lake)


COLUMNS = ["trip_key", "ds", "th", "is_pos", "C", "year", "month"]


def test_paths_of_months(raw):
    assert raw.trip_files[0].endswith("/201201.csv")
    assert raw.observation_files[1].endswith("/201202hourly.txt")


def test_gold_builds_missing_stages(spark, raw, stored):
    lake, table = stored
    for name in (stages.BRONZE_TRIPS, stages.SILVER_OBSERVATIONS):
        for month in raw.months:
            assert files.table_exists(spark, f"{lake.path(name)}/{stages.input_part(month)}")
    for e in stages.manifest(spark, lake):
        assert files.table_exists(spark, f"{lake.path(stages.GOLD_JOINED)}/{e.joined}")
        assert files.table_exists(spark, f"{lake.path(stages.GOLD_TARGETS)}/{e.targets}")
    assert not files.table_exists(spark, lake.path("none"))
    assert table.columns == targets.TARGET_COLUMNS and table.count() > 0
    assert {r[0] for r in table.select("month").distinct().collect()} == {"01"}


def test_stored_and_direct_targets_agree(spark, raw, stored, tmp_path):
    _, table = stored
    direct = stages.run_gold(spark, raw, stages.Lake(str(tmp_path)), store=False)
    shown = [*COLUMNS, "Wo.o_vis", "Wd.d_tempC"]
    keys = ["trip_key", "ds", "th"]
    assert rows(direct.select(*shown), *keys) == rows(table.select(*shown), *keys)
    assert not os.listdir(tmp_path)


def per_threshold(table):
    return {r[0]: r[1] for r in table.groupBy("th").count().collect()}


def test_rerun_of_one_threshold_keeps_the_others(spark, raw, stored):
    lake, table = stored
    before = per_threshold(table)
    labels = rows(table.select("trip_key", "ds", "th", "C"), "trip_key", "ds", "th")
    again = stages.run_gold(spark, raw, lake, thresholds=[30])
    assert per_threshold(again) == {30: before[30]}
    every = stages.read_targets(spark, lake)
    assert per_threshold(every) == before
    assert rows(every.select("trip_key", "ds", "th", "C"), "trip_key", "ds", "th") == labels


def test_months_arrive_and_stay(spark, raw, stored, tmp_path):
    _, table = stored
    lake = stages.Lake(str(tmp_path))
    one = stages.run_gold(spark, raw.only("201201"), lake, thresholds=[60]).count()
    both = stages.targets_table(spark, raw, lake, thresholds=[60])
    assert one < both.count() == table.filter("th = 60").count()
    # The second month alone leaves the first one stored, and shrinks what the targets cover.
    second = stages.run_gold(spark, raw.only("201202"), lake, thresholds=[60])
    assert second.count() < both.count()
    assert rows(stages.read_targets(spark, lake).groupBy().count()) == [(second.count(),)]
    for month in raw.months:
        assert files.table_exists(spark, f"{lake.path(stages.BRONZE_TRIPS)}/{stages.input_part(month)}")
    trips, _ = stages.run_bronze(spark, raw, lake)
    assert trips.count() == stages.bronze_frames(spark, raw)[0].count()


def test_a_broken_write_is_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert files.table_exists(spark, path)
    os.remove(f"{path}/_SUCCESS")
    assert not files.table_exists(spark, path)


def test_headers_may_differ_in_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,z,x\n20,30,10\n")
    got = files.read_delimited(spark, [str(tmp_path / f) for f in ("a.csv", "b.csv")], columns=["x", "y"])
    assert rows(got, "x") == [("1", "2"), ("10", "20")]
    with pytest.raises(ValueError, match="z"):
        files.read_delimited(spark, [str(tmp_path / f) for f in ("b.csv", "a.csv")], columns=["z"])


def test_a_loss_in_the_station_join_is_told(spark, raw, tmp_path):
    few = tmp_path / "few.csv"
    few.write_text("WBAN,AirportID,TimeZone\n00003,10000,-6\n")
    short = stages.RawInputs(raw.trips_folder, raw.observations_folder, str(few), ["201201"])
    with pytest.warns(UserWarning, match="without an airport"):
        stages.run_silver(spark, short, stages.Lake(str(tmp_path / "lake")))


def test_slice_prunes_partitions(spark, raw, stored):
    lake, table = stored
    plan = targets.target_slice(table)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ds#" in plan.split("PartitionFilters")[1][:400]
    read = stages.targets_table(spark, raw, lake)
    assert read.schema == table.schema


def test_reports(spark, raw, stored, tmp_path):
    lake, _ = stored
    found = stages.run_diagnostics(spark, raw, lake, ds="D4", th=15, origin_hours=2, dest_hours=0)
    assert {"array_population", "struct_nulls", "variance_extremes", "station_join_loss"} <= set(found)
    for name, df in found.items():
        assert df.count() > 0, name
    trips, obs = stages.run_silver(spark, raw, lake)
    reports = {**stages.silver_reports(trips), **stages.bronze_reports(*stages.bronze_frames(spark, raw))}
    reports.update(stages.ratio_reports(stages.gold_joined(trips, obs)))
    stages.write_reports(reports, str(tmp_path))
    assert set(os.listdir(tmp_path)) == set(reports)
    back = files.read_delimited(spark, [str(tmp_path / "delay_rules")])
    assert back.columns == ["check", "rows"] and back.count() == 5
    with pytest.raises(ValueError):
        stages.run_diagnostics(spark, raw, lake, ds="D9")


def test_join_loss_of_raw_files(spark, raw):
    _, obs = stages.bronze_frames(spark, raw)
    loss = stages.join_loss(spark, raw, obs).first()
    assert loss["rows_before"] == obs.count() and 0 <= loss["loss_pct"] < 15


def test_bad_inputs(spark, raw):
    trips = files.read_delimited(spark, raw.trip_files)
    with pytest.raises(ValueError, match="NAS_DELAY"):
        files.require_columns(trips.drop("NAS_DELAY"), ["NAS_DELAY"])
    with pytest.raises(ValueError, match="a"):
        files.reject_duplicate_columns(spark.sql("select 1 as a, 2 as A"))
