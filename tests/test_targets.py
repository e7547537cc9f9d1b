"""Measures, dataset rules, balancing and the two ways to build the targets."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from delaylake.operators import ratios, targets

FLAT = (
    "trip_key string, ARR_DELAY_NEW double, WEATHER_DELAY double, NAS_DELAY double, "
    "NAS_WEATHER_DELAY double"
)


def flat(spark, data):
    return spark.createDataFrame(data, FLAT)


def test_measures_edges(spark):
    data = [
        ("null", None, None, None, 0.0),
        ("neg", -5.0, 0.0, 0.0, 0.0),
        ("clamp", 10.0, 0.0, 40.0, 20.0),
        ("small", 0.5, 0.5, 0.0, 0.0),
    ]
    got = {r["trip_key"]: r for r in targets.delay_measures(flat(spark, data)).collect()}
    assert got["null"]["ARR_DELAY_NEW"] == 0 and not got["null"]["has_meteo"]
    assert got["neg"]["ARR_DELAY_NEW"] == 0
    assert got["clamp"]["ARR_NASW"] == 0 and got["clamp"]["ratio_adj"] == 20
    assert got["small"]["ratio_adj"] == 0.5  # the denominator is at least one minute


def test_measures_without_weather_share(spark):
    df = flat(spark, [("a", 50.0, 0.0, 10.0, None)])
    derived = targets.delay_measures(df.drop("NAS_WEATHER_DELAY")).first()
    assert derived["NAS_WEATHER_DELAY"] == pytest.approx(5.8)
    filled = ratios.ratio_measures(df).first()
    assert filled["NAS_WEATHER_DELAY"] == pytest.approx(5.8)
    nested = df.select(F.struct(*(F.col(c).alias(c.lower()) for c in df.columns)).alias("F"))
    assert targets.delay_measures(nested).first()["ARR_DELAY_NEW"] == 50


def test_rules_on_both_sides(spark):
    th = 60
    data = [
        ("d1_in", 100.0, 95.0, 0.0, 0.0),
        ("d1_out", 100.0, 94.9, 0.0, 0.0),
        ("nas_eq", 200.0, 0.0, 100.0, 60.0),
        ("nas_lt", 200.0, 0.0, 100.0, 59.0),
        ("plain", 60.0, 0.0, 0.0, 0.0),
        ("early", 59.0, 59.0, 0.0, 0.0),
    ]
    m = targets.delay_measures(flat(spark, data))
    found = {
        ds: {r[0] for r in m.filter(rule).select("trip_key").collect()}
        for ds, rule in targets.positive_rules(th).items()
    }
    assert found["D1"] == {"d1_in"}
    assert found["D2"] == {"d1_in", "d1_out", "nas_eq"}
    assert found["D3"] == {"d1_in", "d1_out", "nas_eq", "nas_lt"}
    assert found["D4"] == {"d1_in", "d1_out", "nas_eq", "nas_lt", "plain"}


def test_balancing_branches(spark):
    late = [(f"p{i}", 30.0, 0.0, 0.0, 0.0) for i in range(300)]
    early = [(f"n{i}", 0.0, 0.0, 0.0, 0.0) for i in range(3000)]
    keys = targets.balanced_keys(flat(spark, late + early), [15, 60]).cache()
    n = {(r[0], r[1], r[2]): r[3] for r in keys.groupBy("ds", "th", "is_pos").count().collect()}
    assert n["D4", 15, 1] == 300 and 240 < n["D4", 15, 0] < 360
    # No positives: the dataset stays empty.
    assert not any(k[0] in ("D1", "D2", "D3") or k[1] == 60 for k in n)
    # More positives than negatives: all negatives.
    keys = targets.balanced_keys(flat(spark, late + early[:100]), [15])
    assert keys.filter("ds = 'D4' and is_pos = 0").count() == 100
    # No negatives at all.
    assert targets.balanced_keys(flat(spark, late), [15]).count() == 300


def test_keys_do_not_depend_on_partitioning(spark):
    data = [(f"k{i}", float(i * 37 % 140), float(i % 3), float(i % 5), float(i % 5) / 2) for i in range(2000)]
    one = targets.balanced_keys(flat(spark, data).coalesce(1))
    many = targets.balanced_keys(flat(spark, data).repartition(9))
    order = ["trip_key", "ds", "th"]
    assert rows(one, *order) == rows(many, *order)
    # Nested: D1, D2 within D3 within D4, for positives and negatives.
    member = {}
    for key, ds, th, pos, _ in one.collect():
        member.setdefault((ds, th, pos), set()).add(key)
    for th in targets.THRESHOLDS:
        for pos in (0, 1):
            d3 = member[("D3", th, pos)]
            assert member.get(("D1", th, pos), set()) <= d3
            assert member.get(("D2", th, pos), set()) <= d3 <= member[("D4", th, pos)]


def joined(spark, data):
    df = flat(spark, data)
    packed = F.struct(
        F.lit(1).alias("carrier"), F.lit(2).alias("flnum"), F.lit(None).cast("date").alias("date"),
        F.col("ARR_DELAY_NEW").alias("arr_delay_new"), F.col("WEATHER_DELAY").alias("weather_delay"),
        F.col("NAS_DELAY").alias("nas_delay"), F.col("NAS_WEATHER_DELAY").alias("nas_weather_delay"),
        "trip_key",
    )
    none = F.array().cast("array<struct<x: int>>")
    return df.select(
        packed.alias("F"), none.alias("Wo"), none.alias("Wd"),
        (F.col("ARR_DELAY_NEW") >= 15).cast("int").alias("C"),
        F.lit(2012).alias("year"), F.lit("01").alias("month"),
    )


def test_direct_targets_equal_joined_keys(spark):
    data = [(f"k{i}", float(i * 37 % 140), float(i % 3), float(i % 5), float(i % 5) / 2) for i in range(1500)]
    jt = joined(spark, data)
    direct = targets.build_targets(jt, targets.target_grid(jt))
    by_join = targets.target_columns(targets.attach_keys(jt, targets.balanced_keys(jt)))
    cols = ["trip_key", "ds", "th", "is_pos", "C"]
    assert rows(direct.select(*cols), *cols) == rows(by_join.select(*cols), *cols)
    assert direct.columns == by_join.columns == targets.TARGET_COLUMNS

    grid = targets.target_grid(flat(spark, data))
    chosen = targets.trips_in_targets(flat(spark, data), grid)
    assert rows(chosen.select("trip_key"), "trip_key") == rows(
        direct.select("trip_key").distinct(), "trip_key"
    )


def test_slice_reports(spark):
    data = [(f"k{i}", float(i * 37 % 140), 1.0, 0.0, 0.0) for i in range(200)]
    jt = joined(spark, data)
    table = targets.build_targets(jt, targets.target_grid(jt))
    assert sum(r["count"] for r in targets.class_balance(table).collect()) == targets.target_slice(table).count()
    assert targets.slice_sample(table, n=7).count() == 7


def test_missing_key_is_an_error(spark):
    with pytest.raises(ValueError):
        targets.delay_measures(spark.range(1))


@pytest.mark.parametrize(
    "ratio, label",
    [
        (-0.01, "<0.00"),
        (0.0, "[0.00,0.05)"),
        (0.05, "[0.05,0.10)"),
        (0.15, "[0.10,0.15)"),
        (0.30, "[0.25,0.30)"),
        (1.1999, "[1.15,1.20)"),
        (1.20, ">=1.20"),
        (float("nan"), "NaN/Inf"),
        (float("inf"), "NaN/Inf"),
    ],
)
def test_ratio_bucket(spark, ratio, label):
    df = spark.createDataFrame([(ratio,)], "r double")
    assert df.select(ratios.ratio_bucket(F.col("r"))).first()[0] == label


def drawn_by_hand(data, thresholds, seed):
    """Rows (key, delay, weather, nas, nas weather), unique: the smallest draws among the negatives."""
    import hashlib

    def draw(key):
        return int(hashlib.md5(f"{seed}|{key}".encode()).hexdigest()[:15], 16), key

    def member(ds, row, th):
        key, delay, weather, nas, share = row
        adjusted = max(delay - (nas - share), 0)
        explained = (weather > 0 or share > 0) and adjusted > 0 and (weather + share) / max(adjusted, 1) >= 0.95
        rest = {"D1": explained, "D2": weather > 0 or share >= th, "D3": weather > 0 or share > 0, "D4": True}
        return delay >= th and rest[ds]

    out = set()
    for th in thresholds:
        negatives = sorted((r[0] for r in data if r[1] < th), key=draw)
        for ds in targets.DATASETS:
            positives = [r[0] for r in data if member(ds, r, th)]
            out |= {(k, ds, th, 1) for k in positives} | {(k, ds, th, 0) for k in negatives[: len(positives)]}
    return out


@pytest.mark.parametrize("bits", [1, 4, 16])
def test_classes_of_equal_size(spark, bits):
    data = [
        (f"k{i}", float(i * 7 % 200), float(i % 5 == 0), float(i % 11), float(i % 11) * (i % 2))
        for i in range(600)
    ]
    got = targets.equal_keys(flat(spark, data + data[:40]).repartition(5), seed=3, bits=bits)
    found = [tuple(r) for r in got.select("trip_key", "ds", "th", "is_pos").collect()]
    want = drawn_by_hand(data, targets.THRESHOLDS, 3)
    assert len(found) == len(want) and set(found) == want


def test_equal_classes_at_the_limits(spark):
    late_row = ("late", 100.0, 5.0, 0.0, 0.0)
    early = [(f"e{i}", 0.0, 0.0, 0.0, 0.0) for i in range(3)]
    many_late = [(f"l{i}", 100.0, 5.0, 0.0, 0.0) for i in range(9)]

    def sizes(data):
        got = targets.equal_keys(flat(spark, data), [60]).where("ds = 'D4'").groupBy("is_pos").count()
        return {r["is_pos"]: r["count"] for r in got.collect()}

    assert sizes(early) == {}
    assert sizes([late_row]) == {1: 1}
    assert sizes([late_row, *early]) == {0: 1, 1: 1}
    assert sizes([*many_late, *early]) == {0: 3, 1: 9}
    assert targets.equal_keys(flat(spark, [])).count() == 0


def test_packed_slices_are_those_of_the_expanded_rows(spark):
    data = [
        (f"k{i}", float(i * 7 % 130) if i % 17 else None, float(i % 5 * 20), float(i % 3 * 40), float(i % 3 * 20))
        for i in range(400)
    ]
    measures = targets.delay_measures(flat(spark, data))
    grid = targets.dataset_grid(targets.class_counts(measures)).scalar()
    carried = {"F": F.struct("trip_key"), "Wo": F.lit(1), "Wd": F.lit(2), "C": F.lit(0), "year": F.lit(2012), "month": F.lit("01")}
    args = (measures.withColumns(carried), grid, targets.TAU, targets.GOLD_SEED)
    expanded = targets.expand_targets(*args).select(*targets.TARGET_COLUMNS)
    packed = targets.pack_targets(*args)
    assert packed.count() == packed.select("trip_key").distinct().count() > 0
    held = 0
    for ds in targets.DATASETS:
        for th in targets.THRESHOLDS:
            want = targets.target_slice(expanded, ds, th)
            got = targets.target_slice(packed, ds, th)
            assert got.dtypes == want.dtypes
            assert rows(got, "trip_key") == rows(want, "trip_key")
            held += got.count()
    assert held == expanded.count() > packed.count()
