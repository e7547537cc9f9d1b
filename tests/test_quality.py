"""Reports on small frames with known content."""

from conftest import rows

from delaylake.operators import diagnostics, dimensions, observations, quality, ratios, trips

SILVER = (
    "FL_NUM int, origin_airport_id int, dest_airport_id int, ARR_DELAY_NEW double, "
    "WEATHER_DELAY double, NAS_DELAY double, total_weather_delay double"
)


def silver(spark):
    data = [
        (1, 1, 2, 10.0, 0.0, 0.0, 0.0),
        (2, 1, 2, 20.0, 0.0, 0.0, 0.0),
        (3, 2, 1, 20.0, 5.0, 0.0, 5.0),
        (4, 2, 3, 5.0, 0.0, 2.0, 1.0),
        (5, 2, 3, None, 0.0, 2.0, 1.0),
        (6, 2, 3, 15.0, -1.0, 0.0, float("nan")),
    ]
    return spark.createDataFrame(data, SILVER)


def test_missing_counts_by_type(spark):
    data = [(None, None), ("", 1.0), ("  ", float("nan")), ("NA", 2.0), ("Null", 3.0), ("x", 4.0)]
    df = spark.createDataFrame(data, "s string, d double")
    assert rows(quality.missing_counts(df)) == [(5, 2, 6)]


def test_null_rates(spark):
    got = {r["column"]: r for r in quality.null_rates(silver(spark)).collect()}
    assert (got["ARR_DELAY_NEW"]["nulls"], got["ARR_DELAY_NEW"]["null_rate"]) == (1, 0.166667)
    assert (got["total_weather_delay"]["nans"], got["total_weather_delay"]["nan_rate"]) == (1, 0.166667)
    assert got["FL_NUM"]["dtype"] == "int" and got["FL_NUM"]["nans"] == 0
    assert quality.null_rates(silver(spark)).first()["column"] == "ARR_DELAY_NEW"
    empty = quality.null_rates(silver(spark).filter("false")).first()
    assert empty["total"] == 0 and empty["null_rate"] is None


def test_distinct_reports(spark):
    df = silver(spark)
    exact = quality.distinct_counts(df, ["FL_NUM", "origin_airport_id", "none"], approximate=False)
    assert exact.columns == ["FL_NUM", "origin_airport_id", "_rows"] and rows(exact) == [(6, 2, 6)]
    got = dict(rows(quality.key_cardinalities(df)))
    assert got == {"FL_NUM": 6, "dest_airport_id": 3, "origin_airport_id": 2}
    assert rows(quality.key_cardinalities(spark.range(3))) == [("__no_columns__", 0)]


def test_delay_rules_and_violations(spark):
    assert dict(rows(quality.delay_rules(silver(spark)))) == {
        "bothZero -> arr<15 (OK)": 1,
        "bothZero -> arr>=15 (VIOL)": 1,
        "nonZero -> arr>=15 (OK)": 2,
        "nonZero -> arr<15 (VIOL)": 1,
        "total rows": 6,
    }
    bad = quality.rule_violations(silver(spark)).select("FL_NUM", "rule")
    assert sorted(rows(bad)) == [(2, "bothZero->arr>=15"), (4, "nonZero->arr<15")]
    many = silver(spark).crossJoin(spark.range(80))
    assert quality.rule_violations(many, per_rule=50).count() == 100


def test_quantiles(spark):
    df = spark.range(1, 1001).selectExpr("cast(id as double) as ARR_DELAY_NEW")
    assert rows(quality.delay_quantiles(df)) == [("ARR_DELAY_NEW", 500.0, 900.0, 950.0, 990.0)]


def test_observation_check(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "WBAN string, Visibility double")
    got = rows(quality.observation_check(df, ["Visibility", "TempC"]))
    assert got[0][:2] == ("Visibility", True) and got[0][2] == 2 and got[0][4:] == (3, 2)
    assert got[1][:3] == ("TempC", False, None)


def test_dedup_is_deterministic(spark):
    data = [("00003", 2, 5), ("3", 1, None), (" 3 ", 1, 4), ("9", None, None)] * 3
    df = spark.createDataFrame(data, "WBAN string, AirportID int, TimeZone int")
    for parts in (1, 5):
        got = dimensions.station_offsets(df.repartition(parts))
        assert sorted(rows(got)) == [("00003", 1, None), ("00009", None, None)]
    zones = spark.createDataFrame(
        [("3", "1", " UTC "), ("4", "1", None)], "WBAN string, airport_id string, timezone string"
    )
    assert rows(dimensions.airport_zones(zones)) == [(1, None)]


def test_join_loss(spark):
    obs = spark.createDataFrame([("a",)] * 4 + [("b",)], "WBAN string")
    known = spark.createDataFrame([("a", 1)], "WBAN string, airport_id int")
    assert rows(observations.station_join_loss(obs, known)) == [(5, 4, 1, 20.0, True)]
    assert rows(observations.station_join_loss(obs.filter("false"), known)) == [(0, 0, 0, None, None)]


def test_coverage(spark):
    obs = spark.createDataFrame([(1,), (1,), (7,)], "airport_id int")
    flown = spark.createDataFrame([(1, 2), (1, 3)], "origin_airport_id int, dest_airport_id int")
    assert rows(diagnostics.coverage_counts(obs, flown)) == [(2, 1, 2, 3, 1, 2, 1)]
    assert sorted(rows(diagnostics.airports_without_weather(obs, flown))) == [(2,), (3,)]
    assert rows(diagnostics.airports_without_trips(obs, flown)) == [(7,)]
    assert sorted(rows(trips.served_airports(flown))) == [(1,), (2,), (3,)]
    assert rows(diagnostics.observations_per_airport(obs, 1)) == [(1, 2)]


def timelines(spark):
    point = "struct<o_ts: timestamp, o_sky: string, o_wxType: string, " + ", ".join(
        f"o_{n}: double" for n in ("vis", "tempC", "dewC", "rh", "windKt", "windDir", "altim", "slp", "stnp", "precip")
    ) + ">"
    return spark.sql(
        f"""select from_json(wo, 'array<{point}>') as Wo,
               from_json(wd, 'array<{point.replace("o_", "d_")}>') as Wd
            from values ('[{{"o_vis": 1.0}}, {{}}]', '[{{}}]'), ('[{{}}]', '[]'), ('[]', '[]') t(wo, wd)"""
    )


def test_array_reports(spark):
    got = {r["timeline"]: r for r in diagnostics.array_population(timelines(spark)).collect()}
    assert (got["Wo"]["empty"], got["Wd"]["empty"], got["Wo"]["both_filled"]) == (1, 2, 1)
    assert (got["Wo"]["max_size"], got["Wo"]["mean_size"], got["Wo"]["std_size"]) == (2, 1.0, 1.0)
    assert rows(diagnostics.array_size_histogram(timelines(spark))) == [
        ("Wd", 0, 2), ("Wd", 1, 1), ("Wo", 0, 1), ("Wo", 1, 1), ("Wo", 2, 1),
    ]
    nulls = {(r[0], r[1]): (r[2], r[3]) for r in diagnostics.struct_null_rates(timelines(spark)).collect()}
    assert nulls["Wo", "o_vis"] == (1, 2) and nulls["Wo", "o_sky"] == (2, 2)
    assert nulls["Wo", "all fields"] == (1, 2) and nulls["Wd", "all fields"] == (1, 2)


def test_variances(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (3.0, 5.0, 2.5)], "a double, b double, c double")
    got = diagnostics.feature_variances(df, ["a", "b", "c"])
    assert rows(got) == [("a", 2.0), ("c", 0.125), ("b", 0.0)]
    assert rows(diagnostics.variance_counts(got)) == [(1, 2, 3)]
    assert rows(diagnostics.variance_extremes(got, 1)) == [("a", 2.0, "top"), ("b", 0.0, "bottom")]
    both = rows(diagnostics.variance_extremes(got, 2).select("feature", "end"), "end", "feature")
    assert both == [("b", "bottom"), ("c", "bottom"), ("a", "top"), ("c", "top")]
    assert rows(diagnostics.feature_variances(df.limit(1), ["a"])) == [("a", 0.0)]


def test_tau_reports(spark):
    df = spark.createDataFrame(
        [(100.0, 100.0), (100.0, 99.5), (100.0, 80.0), (100.0, 0.0)],
        "ARR_NASW double, w double",
    ).selectExpr("ARR_NASW", "w > 0 as has_meteo", "w / 100 as ratio_adj")
    assert rows(ratios.tau_one_counts(df)) == [(4, 3, 1, 2)]
    assert dict(rows(ratios.tau_counts(df, [1.0, 0.8, 0.8, 0.9]))) == {0.8: 3, 0.9: 2, 1.0: 1}


def test_sketches_of_months_merge(spark):
    df = spark.range(50_000).selectExpr(
        "2012 + id % 2 as year", "'01' as month", "cast(pmod(id * 7919, 50000) as double) as ARR_DELAY_NEW",
        "cast(null as double) as WEATHER_DELAY", "cast(if(id % 3 = 0, null, 5) as double) as NAS_DELAY",
    )
    found = {r["column"]: r for r in quality.sketched_quantiles(quality.delay_sketches(df)).collect()}
    spread, none, same = (found[c] for c in ("ARR_DELAY_NEW", "WEATHER_DELAY", "NAS_DELAY"))
    assert spread["n"] == 50_000 and abs(spread["p50"] - 25_000) < 500 and abs(spread["p99"] - 49_500) < 500
    assert none["n"] == 0 and none["p50"] is None and none["p99"] is None
    assert same["n"] == df.where("NAS_DELAY is not null").count() and same["p50"] == same["p99"] == 5.0
    errors = {r["column"]: r for r in quality.rank_errors(df, quality.sketched_quantiles(quality.delay_sketches(df))).collect()}
    assert errors["NAS_DELAY"]["p90"] == 0.0 and errors["ARR_DELAY_NEW"]["p90"] < 0.01
    wrong = spark.createDataFrame([("ARR_DELAY_NEW", 0.0, 0.0, 0.0, 0.0)], "column string, p50 double, p90 double, p95 double, p99 double")
    assert abs(quality.rank_errors(df, wrong).first()["p50"] - 0.5) < 0.001
    assert quality.sketched_quantiles(quality.delay_sketches(df.where("false"))).where("n > 0").count() == 0


def test_key_sketches_of_groups_unite(spark):
    df = spark.range(6000).selectExpr(
        "cast(id % 5000 as int) as FL_NUM", "cast(null as int) as origin_airport_id",
        "cast(id % 7 as string) as dest_airport_id", "cast(2012 + id % 2 as int) as year", "'01' as month"
    )
    sketches = quality.key_sketches(df, by=["year"])
    assert sketches.count() == 2
    found = {r["column"]: (r["approx_distinct"], r["rows"]) for r in quality.sketched_cardinalities(sketches).collect()}
    assert abs(found.pop("FL_NUM")[0] - 5000) <= 3 * 0.0065 * 5000
    assert found == {"dest_airport_id": (7, 6000), "year": (2, 6000), "month": (1, 6000), "origin_airport_id": (0, 6000)}
    none = quality.sketched_cardinalities(quality.key_sketches(df.where("false"), by=["year"]))
    assert {(r["approx_distinct"], r["rows"]) for r in none.collect()} == {(0, 0)}
