"""Weather-related delay measures and the balanced target datasets D1 to D4.

A threshold is a delay in minutes. For each threshold four notions of "late because of weather" give the positives; negatives are
trips that were not late, thinned to about the number of positives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylake.functions import values
from delaylake.functions.paths import coalesce_paths, first_path
from delaylake.operators.dimensions import keep_smallest

# Thresholds, ratio bound and seeds of the published datasets.
THRESHOLDS = (15, 30, 45, 60, 90)
TAU = 0.95
GOLD_SEED = 1234
DEFAULT_SEED = 42
DATASETS = ("D1", "D2", "D3", "D4")

# Spellings under which a frame may hold each measure.
ARRIVAL_DELAY = ("F.arr_delay_new", "arr_delay_new")
WEATHER_DELAY = ("F.weather_delay", "weather_delay")
NAS_DELAY = ("F.nas_delay", "nas_delay")
NAS_WEATHER = ("F.nas_weather_delay", "nas_weather_delay")
ALPHA = ("F.alpha_nas", "alpha_nas")
KEY = ("F.trip_key", "trip_key")
DEFAULT_ALPHA = 0.58

MEASURES = [
    "ARR_DELAY_NEW",
    "WEATHER_DELAY",
    "NAS_DELAY",
    "NAS_WEATHER_DELAY",
    "ARR_NASW",
    "has_meteo",
    "ratio_adj",
]


def key_column(df: DataFrame) -> Column:
    path = first_path(df, KEY)
    if path is None:
        raise ValueError("no trip_key in the frame, neither nested nor flat")
    return F.col(path)


def delay_measures(
    df: DataFrame,
    min_denominator: float = 1.0,
    fill_nas_weather: bool = False,
    also_keep: Sequence[str] = (),
) -> DataFrame:
    """Delays clamped at zero and the measures derived from them.

    Works on joined trips (struct ``F``) and on flat silver trips alike.
    ``fill_nas_weather`` derives a null weather part of the NAS delay from its
    share; otherwise only a missing column is derived.
    """

    for candidates in (ARRIVAL_DELAY, WEATHER_DELAY, NAS_DELAY):
        if first_path(df, candidates) is None:
            raise ValueError(f"no column {candidates[-1]} in the frame, neither nested nor flat")

    def clamped(candidates):
        return F.greatest(coalesce_paths(df, candidates, F.lit(0.0)), F.lit(0.0))

    given = first_path(df, NAS_WEATHER)
    extra = [c for c in also_keep if c not in ("trip_key", *MEASURES)]
    flat = df.select(
        key_column(df).alias("trip_key"),
        *extra,
        clamped(ARRIVAL_DELAY).alias("ARR_DELAY_NEW"),
        clamped(WEATHER_DELAY).alias("WEATHER_DELAY"),
        clamped(NAS_DELAY).alias("NAS_DELAY"),
        coalesce_paths(df, ALPHA, F.lit(DEFAULT_ALPHA)).alias("_alpha"),
        (F.col(given).cast("double") if given else F.lit(None).cast("double")).alias(
            "_nas_weather"
        ),
    )
    derived = F.col("NAS_DELAY") * F.col("_alpha")
    if given is None:
        nas_weather = derived
    elif fill_nas_weather:
        nas_weather = F.coalesce(F.col("_nas_weather"), derived)
    else:
        nas_weather = F.col("_nas_weather")
    with_share = flat.withColumn("NAS_WEATHER_DELAY", nas_weather)
    weather_part = F.col("WEATHER_DELAY") + F.col("NAS_WEATHER_DELAY")
    other_nas = F.col("NAS_DELAY") - F.col("NAS_WEATHER_DELAY")
    adjusted = F.greatest(F.col("ARR_DELAY_NEW") - other_nas, F.lit(0.0))
    return with_share.select(
        "trip_key",
        *extra,
        "ARR_DELAY_NEW",
        "WEATHER_DELAY",
        "NAS_DELAY",
        "NAS_WEATHER_DELAY",
        adjusted.alias("ARR_NASW"),
        ((F.col("WEATHER_DELAY") > 0) | (F.col("NAS_WEATHER_DELAY") > 0)).alias("has_meteo"),
        (weather_part / F.greatest(adjusted, F.lit(min_denominator))).alias("ratio_adj"),
    )


def late(threshold: int | str) -> str:
    """SQL text; ``threshold`` is a number of minutes or a column name."""
    return f"ARR_DELAY_NEW >= {threshold}"


def positive_rules(threshold: int | str, tau: float = TAU) -> dict[str, str]:
    """Membership of the positives, as SQL on the columns of :func:`delay_measures`."""
    explained = f"has_meteo and ARR_NASW > 0 and ratio_adj >= {tau!r}D"
    return {
        "D1": f"{late(threshold)} and {explained}",
        "D2": f"{late(threshold)} and (WEATHER_DELAY > 0 or NAS_WEATHER_DELAY >= {threshold})",
        "D3": f"{late(threshold)} and (WEATHER_DELAY > 0 or NAS_WEATHER_DELAY > 0)",
        "D4": late(threshold),
    }


COUNTS = [f"cnt_{ds.lower()}" for ds in DATASETS] + ["cnt_neg"]


def class_counts(
    measures: DataFrame,
    thresholds: Sequence[int] = THRESHOLDS,
    tau: float = TAU,
    by: Sequence[str] = (),
) -> DataFrame:
    """``(th, cnt_d1 .. cnt_d4, cnt_neg)``, all thresholds from one scan, per group of ``by``.

    Counts of groups add up, so those of a part can be kept and merged.
    """
    sums, rows = [], []
    for th in thresholds:
        named = {
            **{f"cnt_{d.lower()}": rule for d, rule in positive_rules(th, tau).items()},
            "cnt_neg": f"not {late(th)}",
        }
        sums += [F.expr(f"count_if({rule}) as {n}_{th}") for n, rule in named.items()]
        rows.append(f"struct({th} as th, {', '.join(f'{n}_{th} as {n}' for n in named)})")
    return measures.groupBy(*by).agg(*sums).selectExpr(*by, f"inline(array({', '.join(rows)}))")


def dataset_grid(counts: DataFrame) -> DataFrame:
    """One row, one struct: ``cells``, an ``array<struct<ds, th, share>>`` of all
    datasets and thresholds, and ``largest``, the largest share per threshold.

    ``share`` is the part of the negatives to keep: positives over negatives,
    at most 1; without positives no negative is kept either.
    """
    shares = {
        ds: f"if(cnt_{ds.lower()} <= 0, 0D, "
        f"least(1D, cnt_{ds.lower()} / greatest(cnt_neg, 1)))"
        for ds in DATASETS
    }
    cells = ", ".join(f"struct('{d}' as ds, th, {s} as share)" for d, s in shares.items())
    per_threshold = counts.selectExpr(
        "th", f"array({cells}) as cells", f"greatest({', '.join(shares.values())}) as top"
    )
    return per_threshold.agg(
        F.expr(
            "struct(flatten(collect_list(cells)) as cells, "
            "map_from_entries(collect_list(struct(th, top))) as largest)"
        ).alias("grid")
    )


def kept_shares(counts: Sequence[int]) -> dict[str, float]:
    """The shares of :func:`dataset_grid` from summed counts in the order of ``COUNTS``."""
    negatives = max(counts[-1], 1)
    return {
        ds: min(1.0, n / negatives) if n > 0 else 0.0 for ds, n in zip(DATASETS, counts)
    }


def literal_cells(shares: dict[tuple[str, int], float]) -> Column:
    """The grid of :func:`dataset_grid` from known shares per dataset and threshold."""
    cells = [
        f"named_struct('ds', '{ds}', 'th', {th}, 'share', {share!r}D)"
        for (ds, th), share in sorted(shares.items())
    ]
    return F.expr(f"named_struct('cells', array({', '.join(cells)}))")


def drawn_rows(rows: DataFrame, shares: dict[tuple[str, int], float], seed: int) -> DataFrame:
    """Targets with all positives, and the negatives that the shares leave."""
    pairs = ", ".join(f"'{member_key(ds, th)}', {share!r}D" for (ds, th), share in sorted(shares.items()))
    share = F.expr(f"try_element_at(map({pairs}), concat(ds, '-', th))")
    return rows.filter((F.col("is_pos") == 1) | (values.unit_hash(F.col("trip_key"), seed) < share))


def _with_cells(measures: DataFrame, grid: Column, tau: float, seed: int) -> DataFrame:
    """Add ``_cells``, the entries of the grid that a trip belongs to.

    One hash per trip decides all draws, so the negatives of a smaller dataset
    are also negatives of a larger one. Nothing is shuffled.
    """
    drawn = measures.withColumns(
        {
            "_draw": values.unit_hash(F.col("trip_key"), seed),
            "_grid": grid.getField("cells"),
        }
    )
    tests = [f"(c.ds = '{d}' and {rule})" for d, rule in positive_rules("c.th", tau).items()]
    tests.append(f"(not {late('c.th')} and _draw < c.share)")
    return drawn.withColumn("_cells", F.expr(f"filter(_grid, c -> {' or '.join(tests)})")).drop(
        "_draw", "_grid"
    )


def expand_targets(measures: DataFrame, grid: Column, tau: float, seed: int) -> DataFrame:
    """One row per trip and dataset it belongs to, with ``ds, th, is_pos``.

    ``grid`` is the scalar subquery of :func:`dataset_grid`, a few entries. Each
    trip keeps the entries it belongs to and only those become rows.
    """
    carried = [f"`{c}`" for c in measures.columns]
    members = _with_cells(measures, grid, tau, seed).selectExpr(*carried, "inline(_cells)")
    return members.withColumn("is_pos", F.expr(f"if({late('th')}, 1, 0)")).drop("share")


def member_key(ds: str, th: int) -> str:
    return f"{ds}-{th}"


def pack_targets(measures: DataFrame, grid: Column, tau: float, seed: int) -> DataFrame:
    """One row per trip that belongs to some dataset, with the map ``members`` of ``D2-60`` to ``is_pos``.

    The rows of :func:`expand_targets` without writing a trip once per dataset.
    A slice is a filter on the trip's own row, which Spark moves below the joins
    that the trip's timelines come from.
    """
    entry = f"struct(concat(c.ds, '-', c.th) as key, if({late('c.th')}, 1, 0) as value)"
    members = F.expr(f"map_from_entries(transform(_cells, c -> {entry}))")
    packed = _with_cells(measures, grid, tau, seed).withColumn("members", members).drop("_cells")
    return packed.filter(F.size("members") > 0)


def balanced_keys(
    df: DataFrame,
    thresholds: Sequence[int] = THRESHOLDS,
    tau: float = TAU,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """``(trip_key, ds, th, is_pos, C)`` for all datasets and thresholds.

    Copies of a trip count once, as in the targets. Two scans of the narrow
    measures in all, one to count and one to draw, for any number of thresholds.
    """
    measures = unique_measures(df)
    grid = dataset_grid(class_counts(measures, thresholds, tau)).scalar()
    keys = expand_targets(measures, grid, tau, seed)
    return keys.selectExpr("trip_key", "ds", "th", "is_pos", f"if({late('th')}, 1, 0) as C")


def draw_limits(
    measures: DataFrame,
    counts: DataFrame,
    thresholds: Sequence[int] = THRESHOLDS,
    seed: int = DEFAULT_SEED,
    bits: int = 16,
) -> DataFrame:
    """``(ds, th, last)``: the last negative to keep, so that as many are kept as there are positives.

    ``last`` is the struct of draw and key of the n-th smallest negative, null where
    none is kept. The first ``bits`` of the draws are counted; cumulated, they
    tell the bin that holds the n-th. Only negatives of those bins, one in
    ``2 ** bits`` per dataset and threshold, are put in order.
    """
    drawn = measures.select(
        "trip_key", "ARR_DELAY_NEW", values.draw_number(F.col("trip_key"), seed).alias("draw")
    ).withColumn("bin", F.shiftright("draw", values.DRAW_BITS - bits))
    sums = [F.expr(f"count_if(not {late(th)}) as n{th}") for th in thresholds]
    per_th = ", ".join(f"struct({th} as th, n{th} as held)" for th in thresholds)
    bins = drawn.groupBy("bin").agg(*sums).selectExpr("bin", f"inline(array({per_th}))")
    up_to = F.sum("held").over(Window.partitionBy("th").orderBy("bin"))
    sizes = ", ".join(
        f"struct('{ds}' as ds, least(cnt_{ds.lower()}, cnt_neg) as n)" for ds in DATASETS
    )
    wanted = counts.selectExpr("th", f"inline(array({sizes}))")
    edge = (
        wanted.join(bins.where("held > 0").withColumn("up_to", up_to), "th")
        .where("n > up_to - held and n <= up_to")
        .selectExpr("ds", "th", "bin", "n - (up_to - held) as nth")
    )
    place = F.row_number().over(Window.partitionBy("ds", "th").orderBy("draw", "trip_key"))
    last = (
        drawn.join(edge, "bin")
        .where(f"not {late('th')}")
        .withColumn("place", place)
        .where("place = nth")
        .selectExpr("ds", "th", "struct(draw, trip_key) as last")
    )
    return wanted.select("ds", "th").join(last, ["ds", "th"], "left")


def equal_keys(
    df: DataFrame,
    thresholds: Sequence[int] = THRESHOLDS,
    tau: float = TAU,
    seed: int = DEFAULT_SEED,
    bits: int = 16,
) -> DataFrame:
    """:func:`balanced_keys` with exactly as many negatives as positives, or all where there are fewer.

    Two scans of the narrow measures more than the draw by shares. Which
    negatives are kept depends on the keys and the seed only.
    """
    measures = unique_measures(df)
    limits = draw_limits(measures, class_counts(measures, thresholds, tau), thresholds, seed, bits)
    cells = limits.agg(F.collect_list(F.struct("ds", "th", "last")).alias("cells")).scalar()
    tests = [f"(c.ds = '{d}' and {rule})" for d, rule in positive_rules("c.th", tau).items()]
    tests.append(f"(not {late('c.th')} and struct(_draw, trip_key) <= c.last)")
    drawn = measures.withColumns(
        {"_draw": values.draw_number(F.col("trip_key"), seed), "_cells": cells}
    )
    members = drawn.selectExpr("*", f"inline(filter(_cells, c -> {' or '.join(tests)}))")
    label = f"if({late('th')}, 1, 0)"
    return members.selectExpr("trip_key", "ds", "th", f"{label} as is_pos", f"{label} as C")


def unique_measures(df: DataFrame, **options) -> DataFrame:
    """:func:`delay_measures` with one row per trip: the smallest of its copies."""
    return keep_smallest(delay_measures(df, **options), ["trip_key"])


def attach_keys(joined: DataFrame, keys: DataFrame, with_class: bool = True) -> DataFrame:
    """Joined trips of a key table, by ``trip_key``.

    The join type is left to Spark, since the key table grows with the trips.
    A key listed twice attaches its trip once.
    """
    names = ["trip_key", "ds", "th"] + (["is_pos"] if with_class else [])
    wanted = [c for c in names if c in keys.columns]
    keyed = joined.withColumn("trip_key", key_column(joined))
    return keyed.join(keys.select(*wanted).distinct(), "trip_key", "inner")


TARGET_COLUMNS = [
    "F",
    "Wo",
    "Wd",
    "C",
    "trip_key",
    "year",
    "month",
    "ds",
    "th",
    "is_pos",
]


#: Of packed targets, a row per trip.
PACKED_COLUMNS = ["F", "Wo", "Wd", "C", "trip_key", "year", "month", "members"]


def target_columns(attached: DataFrame) -> DataFrame:
    return attached.select(*TARGET_COLUMNS)


def target_grid(
    trips: DataFrame, thresholds: Sequence[int] = THRESHOLDS, tau: float = TAU
) -> Column:
    """Scalar subquery of :func:`dataset_grid` over all trips, joined or flat, one row each."""
    return dataset_grid(class_counts(delay_measures(trips), thresholds, tau)).scalar()


def trips_in_targets(
    trips: DataFrame, grid: Column, thresholds: Sequence[int] = THRESHOLDS, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Flat trips that belong to at least one dataset.

    Applied before the weather is attached, this keeps the other trips out of
    the two wide joins. D4 holds every late trip, so the lowest threshold
    covers all positives.
    """
    delay = F.greatest(coalesce_paths(trips, ARRIVAL_DELAY, F.lit(0.0)), F.lit(0.0))
    drawn = trips.withColumns(
        {"_delay": delay, "_draw": values.unit_hash(key_column(trips), seed)}
    )
    largest = grid.getField("largest")
    wanted = F.col("_delay") >= min(thresholds)
    for th in thresholds:
        share = F.try_element_at(largest, F.lit(th))
        wanted = wanted | ((F.col("_delay") < th) & (F.col("_draw") < share))
    return drawn.filter(wanted).drop("_delay", "_draw")


def build_targets(
    joined: DataFrame,
    grid: Column,
    tau: float = TAU,
    seed: int = DEFAULT_SEED,
    packed: bool = False,
) -> DataFrame:
    """The targets table from labeled joined trips, without joining keys back.

    Membership follows from a trip's own row and the counts in ``grid``, see
    :func:`target_grid`. The timelines are read once, and absent where the trips
    have none. ``packed`` leaves one row per trip (:func:`pack_targets`).
    """
    carried = [c for c in ("F", "Wo", "Wd", "C", "year", "month") if c in joined.columns]
    measures = delay_measures(joined, also_keep=carried)
    if packed:
        rows = pack_targets(measures, grid, tau, seed)
        return rows.select(*(c for c in PACKED_COLUMNS if c in rows.columns))
    rows = expand_targets(measures, grid, tau, seed)
    return rows.select(*(c for c in TARGET_COLUMNS if c in rows.columns))


def target_slice(targets: DataFrame, ds: str = "D2", th: int = 60) -> DataFrame:
    """One dataset at one threshold; prunes the partitions of a stored table.

    Takes packed targets as well; the slice has the same columns.
    """
    if "members" not in targets.columns:
        return targets.filter((F.col("ds") == ds) & (F.col("th") == th))
    is_pos = F.try_element_at("members", F.lit(member_key(ds, th)))
    rows = targets.withColumns({"ds": F.lit(ds), "th": F.lit(th), "is_pos": is_pos})
    return rows.filter(F.col("is_pos").isNotNull()).select(*TARGET_COLUMNS)


def class_balance(targets: DataFrame, ds: str = "D2", th: int = 60) -> DataFrame:
    return target_slice(targets, ds, th).groupBy("is_pos").count().orderBy("is_pos")


def slice_sample(targets: DataFrame, ds: str = "D2", th: int = 60, n: int = 20) -> DataFrame:
    """The first ``n`` rows of a slice by key, for inspection."""
    return (
        target_slice(targets, ds, th)
        .orderBy("trip_key")
        .limit(n)
        .select("F.carrier", "F.flnum", "F.date", "C", "is_pos")
    )
