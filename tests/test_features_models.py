"""Features on hand-written timelines and a small forest."""

import random
import time
from multiprocessing.pool import ThreadPool

import pytest
from conftest import rows
from pyspark.sql import functions as F

from delaylake.operators import features
from delaylake.plans import models

VARS = ("vis", "tempC", "dewC", "rh", "windKt", "windDir", "altim", "slp", "stnp", "precip")


def point_type(p):
    return f"struct<{p}_ts: timestamp, {p}_sky: string, {p}_wxType: string, " + ", ".join(
        f"{p}_{v}: double" for v in VARS
    ) + ">"


def with_timelines(spark, wo, wd="[]"):
    return spark.sql(
        f"""select 'k' as trip_key, from_json('{wo}', 'array<{point_type("o")}>') as Wo,
                   from_json('{wd}', 'array<{point_type("d")}>') as Wd"""
    )


def test_names():
    assert features.weather_feature_names(0, 0) == []
    names = features.weather_feature_names(1, 2)
    assert len(names) == 3 * 20 + 20 and len(set(names)) == len(names)
    assert names[:2] == ["o_h0_vis", "o_h0_vis_isna"] and names[-1] == "d_has_fg"
    assert len(features.weather_feature_names(7, 7)) == 300


def test_weather_features(spark):
    df = with_timelines(
        spark,
        '[{"o_vis": 0.99, "o_tempC": 3, "o_precip": 1.99, "o_wxType": "+TSRA"}, {"o_vis": 1.0}]',
        '[{"d_vis": 1.0, "d_precip": 2.0, "d_wxType": "SN FG"}]',
    )
    wide = features.weather_features(df, 3, 1)
    assert set(features.weather_feature_names(3, 1)) <= set(wide.columns)
    r = wide.first()
    assert (r["o_h0_vis"], r["o_h0_vis_isna"], r["o_h2_vis"], r["o_h2_vis_isna"]) == (0.99, 0, 0, 1)
    assert r["o_vis_avg"] == pytest.approx(1.99 / 3) and r["o_temp_avg"] == pytest.approx(1)
    assert (r["o_has_precip"], r["o_has_heavy_precip"], r["o_has_low_vis"]) == (1, 0, 1)
    assert (r["o_has_ts"], r["o_has_sn"], r["o_has_fg"]) == (1, 0, 0)
    assert (r["d_has_heavy_precip"], r["d_has_low_vis"], r["d_has_sn"], r["d_has_fg"]) == (1, 0, 1, 1)
    assert "d_h0_vis" not in features.weather_features(df, 1, 0).columns


def targets_frame(spark, n=600):
    rnd = random.Random(3)
    data = []
    for i in range(n):
        pos = i % 2
        vis = rnd.random() + (0 if pos else 0.8)
        hhmm = None if i == 0 else rnd.randrange(24) * 100 + rnd.randrange(60)
        data.append((f"k{i}", "D2", 60, pos, i % 5, i % 7, i % 6, i, hhmm, 2012, f"{1 + i % 12:02d}", vis))
    df = spark.createDataFrame(
        data,
        "trip_key string, ds string, th int, is_pos int, carrier int, o int, d int, n int, "
        "hhmm int, year int, month string, vis double",
    )
    nulls = ", ".join(f"cast(null as double) as {{p}}_{v}" for v in VARS[1:])
    return df.selectExpr(
        "trip_key", "ds", "th", "is_pos", "is_pos as C", "year", "month",
        "struct(carrier, n as flnum, o as origin_airport_id, d as dest_airport_id, "
        "hhmm as crs_dep_scheduled_hhmm, trip_key) as F",
        f"array(struct(cast(null as string) as o_wxType, vis as o_vis, {nulls.format(p='o')})) as Wo",
        f"array(struct(cast(null as string) as d_wxType, vis as d_vis, {nulls.format(p='d')})) as Wd",
    )


def test_flat_features_drop_incomplete_rows(spark):
    flat = features.flat_features(targets_frame(spark, 20))
    assert flat.count() == 19
    r = flat.filter("trip_key = 'k3'").first()
    assert r["month"] == 4 and r["label"] == 1.0
    assert r["dep_minutes"] == r["crs_dep_time"] // 100 * 60 + r["crs_dep_time"] % 100


def test_split_is_a_partition(spark):
    table = targets_frame(spark)
    train, test, names = features.prepare_dataset(table, "D2", 60, origin_hours=1, dest_hours=1)
    a = {r[0] for r in train.select("trip_key").collect()}
    b = {r[0] for r in test.select("trip_key").collect()}
    assert not a & b and len(a | b) == 599 and 0.12 < len(b) / 599 < 0.28
    again, _, _ = features.prepare_dataset(table.repartition(5), "D2", 60)
    assert {r[0] for r in again.select("trip_key").collect()} == a
    assert names == features.weather_feature_names(1, 1)


def test_metrics_undefined_are_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    assert rows(models.classification_metrics(df)) == [(0.5, 0.0, None)]
    none = models.classification_metrics(df.filter("label = 0"))
    assert rows(none) == [(1.0, None, None)]


def test_default_grid():
    grid = models.default_experiments()
    assert len(grid) == 22 and len({e.tag for e in grid}) == 22
    assert {(e.ds, e.th) for e in grid} == {
        *(("D2", t) for t in (15, 30, 45, 60, 90)), ("D1", 60), ("D3", 60), ("D4", 60),
    }
    stages = models.forest_pipeline([]).getStages()
    forest = stages[-1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMaxBins()) == (200, 15, 512)


def test_experiments_learn_and_skip_empty(spark):
    table = targets_frame(spark).cache()
    small = models.ForestSettings(trees=8, depth=4)
    got = models.run_experiments(
        spark,
        table,
        [models.Experiment("D2", 60, 1, 0, "fit"), models.Experiment("D1", 60, 1, 0, "none")],
        forest=small,
    )
    by_tag = {r["tag"]: r for r in got.collect()}
    assert by_tag["fit"]["status"] == "ok" and by_tag["fit"]["auc_roc"] > 0.75
    assert by_tag["none"]["status"] == "empty" and by_tag["none"]["auc_roc"] is None
    train, test, names = features.prepare_dataset(table, "D2", 60, origin_hours=1)
    model, scores = models.fit_and_score(train, test, names, small)
    ranking = rows(models.feature_importances(spark, model))
    assert ranking[0][0] in ("o_h0_vis", "o_vis_avg") and set(scores) == {
        "auc_roc", "auc_pr", "accuracy", "recall", "precision",
    }


def test_windows_of_a_slice_hold_the_features_of_each(spark):
    table = targets_frame(spark, 40)
    windows = [(0, 0), (1, 0), (0, 2), (3, 2)]
    wide = features.slice_windows(table, "D2", 60, windows=windows).cache()
    for o, d in windows:
        plain, _, names = features.prepare_dataset(table, "D2", 60, origin_hours=o, dest_hours=d)
        train, _, same_names = features.windowed_dataset(wide, features.FeatureSettings(), o, d)
        assert same_names == names
        ours = [(r["trip_key"], *r["weather"]) for r in train.orderBy("trip_key").collect()]
        assert ours == rows(plain.select("trip_key", *names), "trip_key")


def test_vectors_equal_those_of_the_assembler(spark):
    train, test, names = features.prepare_dataset(targets_frame(spark), "D2", 60, origin_hours=1)
    indexer, assembler, _ = models.forest_pipeline(names).getStages()
    known = indexer.fit(train.filter("carrier_id <> 3"))
    ours = models.assembled(test, known, assembler, names)
    theirs = assembler.transform(known.transform(test)).select("label", "features")
    assert ours.schema["features"].metadata == theirs.schema["features"].metadata
    vectors = [sorted((r["label"], *r["features"].toArray()) for r in df.collect()) for df in (ours, theirs)]
    assert vectors[0] == vectors[1]
    with pytest.raises(Exception, match="null or NaN"):
        odd = test.withColumn("o_h0_vis", F.lit(float("nan")))
        models.assembled(odd, known, assembler, names).collect()


def test_features_of_a_slice_are_computed_once(spark, monkeypatch):
    built, kept = [], set()
    several, write = features.several_windows, models.files.write_table
    monkeypatch.setattr(features, "several_windows", lambda *a: built.append(a[1]) or several(*a))
    monkeypatch.setattr(models.files, "write_table", lambda df, path, *a: kept.add(path) or write(df, path, *a))
    grid = [models.Experiment("D2", 60, o, d, f"{o}{d}") for o, d in ((0, 0), (1, 0), (0, 1), (1, 1))]
    forest = models.ForestSettings(trees=2, depth=2)
    got = models.run_experiments(spark, targets_frame(spark, 200), grid, forest=forest, at_once=2)
    assert [r["status"] for r in got.collect()] == ["ok"] * 4
    assert built == [[(0, 0), (1, 0), (0, 1), (1, 1)]]
    assert len(kept) == 1 and not models.files.table_exists(spark, kept.pop())


def test_room_is_shared_and_what_exceeds_it_goes_alone():
    room, most = models.Room(10), []

    def hold(n):
        with room.taken(n):
            most.append((room.held, n))
            time.sleep(0.02)

    with ThreadPool(6) as pool:
        pool.map(hold, [4, 4, 4, 25, 4, 4, 25, 10], chunksize=1)
    assert len(most) == 8 and room.held == 0
    assert all(held <= 10 or held == n == 25 for held, n in most)
