"""Gold month by month: what is read and written again, broken runs, clean-up."""

import glob
import os
import shutil

import pytest
from conftest import rows

from delaylake.catalogue import stand_ins
from delaylake.operators import targets
from delaylake.plans import stages, versions
from delaylake.sources import files

SF = "/root/testdata/sf0.001"
YEARS = ["201201", "201301", "201401"]
KEYS = ["trip_key", "ds", "th"]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """One input per year, so that inputs are months of their own; the first has all other dates."""
    base = tmp_path_factory.mktemp("years")
    sources = {
        "trips": (stand_ins.raw_trips(spark, SF), "FL_DATE", ".csv"),
        "obs": (stand_ins.raw_observations(spark, SF), "Date", "hourly.txt"),
    }
    for folder, (df, column, suffix) in sources.items():
        os.makedirs(base / folder)
        pdf = df.toPandas()
        year = pdf[column].str.extract("((?<=^)201[34]|(?<=/)201[34]$)")[0].fillna("2012")
        for month in YEARS:
            pdf[year == month[:4]].to_csv(base / folder / f"{month}{suffix}", index=False)
    mapping = base / "mapping.csv"
    stand_ins.offset_mapping(spark, SF).toPandas().to_csv(mapping, index=False)
    return stages.RawInputs(str(base / "trips"), str(base / "obs"), str(mapping), YEARS)


def upto(raw, n):
    return stages.RawInputs(raw.trips_folder, raw.observations_folder, raw.mapping_file, YEARS[:n])


@pytest.fixture(scope="module")
def whole(spark, raw, tmp_path_factory):
    lake = stages.Lake(str(tmp_path_factory.mktemp("whole")))
    return rows(stages.run_gold(spark, raw, lake, [60], store=False).select(*KEYS, "is_pos", "C", "Wo.o_vis", "Wd.d_vis"), *KEYS)


@pytest.fixture(scope="module")
def two(spark, raw, tmp_path_factory):
    """A lake after the first two inputs; tests work on copies."""
    root = str(tmp_path_factory.mktemp("two"))
    stages.run_gold(spark, upto(raw, 2), stages.Lake(root), [60])
    return root


def copy(two, tmp_path):
    shutil.copytree(two, tmp_path / "lake")
    return stages.Lake(str(tmp_path / "lake"))


def places(spark, lake):
    return {e.part: (e.joined, e.targets) for e in stages.manifest(spark, lake)}


def wipe(folder):
    """Take the data and leave the markers: whoever reads it again finds nothing."""
    found = glob.glob(f"{folder}/**/*.parquet", recursive=True)
    assert found
    for name in found:
        os.remove(name)


def test_a_new_month_reads_and_writes_its_own_part_only(spark, raw, two, whole, tmp_path):
    lake = copy(two, tmp_path)
    before = places(spark, lake)
    for month in YEARS[:2]:
        for name in (stages.BRONZE_TRIPS, stages.BRONZE_OBSERVATIONS, stages.SILVER_TRIPS, stages.SILVER_OBSERVATIONS):
            wipe(f"{lake.path(name)}/{stages.input_part(month)}")
    table = stages.run_gold(spark, raw, lake, [60])
    after = places(spark, lake)
    assert {p: after[p][0] for p in before} == {p: v[0] for p, v in before.items()}
    assert sorted(set(after) - set(before)) == [stages.Part(2014, "01")]
    assert rows(table.select(*KEYS, "is_pos", "C", "Wo.o_vis", "Wd.d_vis"), *KEYS) == whole


def test_counts_of_parts_add_up(spark, raw, two):
    lake = stages.Lake(two)
    entries = stages.manifest(spark, lake)
    joined = stages._read_joined(spark, lake, {e.part: e.joined for e in entries})
    want = targets.class_counts(targets.delay_measures(joined), [60]).first()
    assert [sum(e.counts[i] for e in entries) for i in range(5)] == list(want)[1:]
    grid = targets.dataset_grid(targets.class_counts(targets.delay_measures(joined), [60]))
    cells = {(c["ds"], c["th"]): c["share"] for c in grid.first()["grid"]["cells"]}
    assert stages._total_shares(entries) == cells


def test_late_readings_renew_the_parts_that_look_at_them(spark, raw, two, tmp_path):
    lake = copy(two, tmp_path)
    before = places(spark, lake)
    # The third input again, its readings now of the year before.
    for folder in ("trips", "obs"):
        shutil.copytree(os.path.join(os.path.dirname(raw.trips_folder), folder), tmp_path / folder)
    late = tmp_path / "obs" / "201401hourly.txt"
    late.write_text((tmp_path / "obs" / "201301hourly.txt").read_text())
    moved = stages.RawInputs(str(tmp_path / "trips"), str(tmp_path / "obs"), raw.mapping_file, YEARS)
    stages.run_gold(spark, moved, lake, [60])
    after = places(spark, lake)
    same = {p for p in before if after[p][0] == before[p][0]}
    assert stages.Part(2013, "01") not in same and stages.Part(2012, "01") in same


def test_a_grown_share_renews_targets_but_not_joined_trips(spark, raw, two, tmp_path, monkeypatch):
    lake = copy(two, tmp_path)
    monkeypatch.setattr(stages, "RESERVE", 1.0)
    before = places(spark, lake)
    want = rows(stages.read_targets(spark, lake).select(*KEYS), *KEYS)
    entries = [stages.replace(e, kept=(0.0,) * 4, targets="version-none") for e in stages.manifest(spark, lake)]
    schema = stages.StructType.fromDDL(stages.MANIFEST)
    versions.commit(spark, lake.path(stages.GOLD_MANIFEST), [e.row() for e in entries], schema)
    stages.run_gold(spark, upto(raw, 2), lake, [60])
    after = places(spark, lake)
    assert all(after[p][0] == before[p][0] and after[p][1] != "version-none" for p in before)
    assert rows(stages.read_targets(spark, lake).select(*KEYS), *KEYS) == want


def test_refreshed_inputs_are_joined_again(spark, raw, two, tmp_path):
    lake = copy(two, tmp_path)
    before = places(spark, lake)
    stages.run_gold(spark, upto(raw, 2), lake, [60], refresh=["201301"])
    after = places(spark, lake)
    assert after[stages.Part(2013, "01")] != before[stages.Part(2013, "01")]
    assert after[stages.Part(2012, "01")] == before[stages.Part(2012, "01")]


@pytest.mark.parametrize("broken", ["write_table", "commit", "half a manifest"])
def test_a_broken_run_keeps_the_old_state(spark, raw, two, tmp_path, monkeypatch, broken):
    lake = copy(two, tmp_path)
    want = rows(stages.read_targets(spark, lake).select(*KEYS), *KEYS)
    state = stages.manifest(spark, lake)

    def stop(*args, **options):
        raise RuntimeError("executor lost")

    if broken == "half a manifest":
        os.makedirs(f"{lake.path(stages.GOLD_MANIFEST)}/0000000007/_temporary/0")
    else:
        real = files.write_table
        if broken == "write_table":
            monkeypatch.setattr(files, "write_table", lambda df, path, *a, **b: stop() if "/gold/targets" in path else real(df, path, *a, **b))
        else:
            monkeypatch.setattr(versions, "commit", stop)
        with pytest.raises(RuntimeError):
            stages.run_gold(spark, raw, lake, [60])
        monkeypatch.undo()
    assert stages.manifest(spark, lake) == state
    assert rows(stages.read_targets(spark, lake).select(*KEYS), *KEYS) == want
    # The next run goes through, and clean-up takes what the broken one left.
    stages.run_gold(spark, raw, lake, [60])
    now = stages.manifest(spark, lake)
    gone = stages.vacuum(spark, lake)
    assert (len(gone) > 0) == (broken != "half a manifest") and stages.manifest(spark, lake) == now
    assert len(files.subfolders(spark, lake.path(stages.GOLD_MANIFEST))) == 1
    assert stages.read_targets(spark, lake).count() > 0


def test_what_is_not_stored_is_told(spark, raw, two, tmp_path):
    with pytest.raises(ValueError, match="no targets"):
        stages.read_targets(spark, stages.Lake(str(tmp_path / "empty")))
    with pytest.raises(ValueError, match="90"):
        stages.read_targets(spark, stages.Lake(two), [60, 90])


def test_two_writers_of_one_number(spark, tmp_path):
    schema = stages.StructType.fromDDL("a int")
    path = str(tmp_path / "m")
    assert versions.current(spark, path, schema) == []
    versions.commit(spark, path, [(1,)], schema)
    versions.commit(spark, path, [(2,), (3,)], schema)
    assert rows(spark.createDataFrame(versions.current(spark, path, schema))) == [(2,), (3,)]
    spark.range(1).write.parquet(f"{path}/0000000003")
    with pytest.raises(Exception, match="already exists"):
        spark.range(1).write.mode("errorifexists").parquet(f"{path}/0000000003")
    assert versions.remove_former(spark, path) == 2


def test_key_sketches_scan_a_new_month_only(spark, raw, two, tmp_path):
    lake = copy(two, tmp_path)
    before = stages.key_report(spark, upto(raw, 2), lake).collect()
    stages.run_silver(spark, raw, lake)
    for month in YEARS[:2]:
        wipe(f"{lake.path(stages.SILVER_TRIPS)}/{stages.input_part(month)}")
    spark.catalog.clearCache()
    after = {r["column"]: r for r in stages.key_report(spark, raw, lake).collect()}
    n = files.read_table(spark, lake.path(stages.SILVER_TRIPS), parts=[stages.input_part(YEARS[2])]).count()
    assert {r["rows"] for r in after.values()} == {before[0]["rows"] + n} and n > 0
    assert after["FL_NUM"]["approx_distinct"] >= max(r["approx_distinct"] for r in before if r["column"] == "FL_NUM")


def test_a_month_built_again_gets_a_new_sketch(spark, raw, two, tmp_path):
    lake = copy(two, tmp_path)
    stages.key_report(spark, upto(raw, 1), lake)
    path = f"{lake.path(stages.SILVER_SKETCHES)}/{stages.input_part(YEARS[0])}"
    assert files.table_exists(spark, path)
    stages.run_silver(spark, upto(raw, 1), lake, refresh=[YEARS[0]])
    assert not files.table_exists(spark, path)


@pytest.mark.parametrize("limit", ["-1", "1g"])
def test_gold_stores_no_timelines_and_reads_them(spark, raw, two, whole, tmp_path, limit):
    """Stored rows are narrow; the strips of each build give the timelines, dealt by cells or broadcast."""
    lake = copy(two, tmp_path)
    name, given = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, limit)
    try:
        table = stages.run_gold(spark, raw, lake, [60])
        assert rows(table.select(*KEYS, "is_pos", "C", "Wo.o_vis", "Wd.d_vis"), *KEYS) == whole
        trips, observations = stages.run_silver(spark, raw, lake)
        shown = ["F.trip_key", "C", "Wo", "Wd"]
        want = rows(stages.gold_joined(trips, observations).select(*shown), "trip_key")
        assert rows(stages.read_joined(spark, lake).select(*shown), "trip_key") == want
    finally:
        spark.conf.set(name, given)
    entries = stages.manifest(spark, lake)
    builds = {e.joined for e in entries}
    assert len(builds) > 1
    for folder in [*(f"{lake.path(stages.GOLD_JOINED)}/{v}" for v in builds),
                   *(f"{lake.path(stages.GOLD_TARGETS)}/{e.targets}" for e in entries)]:
        assert not {"Wo", "Wd"} & set(files.read_table(spark, folder).columns)
    assert set(files.subfolders(spark, lake.path(stages.GOLD_STRIPS))) == {f"build={v}" for v in builds}


def test_clean_up_takes_the_strips_of_former_builds(spark, raw, two, tmp_path):
    lake = copy(two, tmp_path)
    before = {e.joined for e in stages.manifest(spark, lake)}
    stages.run_gold(spark, upto(raw, 2), lake, [60], refresh=YEARS[:2])
    assert {f"build={v}" for v in before} <= set(stages.vacuum(spark, lake))
    assert stages.read_targets(spark, lake).count() > 0
