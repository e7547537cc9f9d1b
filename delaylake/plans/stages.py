"""Stages: raw files -> bronze -> silver -> gold -> reports.

Each stage is a function of frames plus a ``run_*`` function that stores its
tables and rebuilds missing inputs. Stored tables cut the lineage between
stages: a lost executor costs the current stage only, and every later stage
scans columns and partitions instead of recomputing.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delaylake.operators import diagnostics, quality, ratios, targets
from delaylake.operators.dimensions import airport_offsets, station_offsets
from delaylake.operators.features import (
    flat_features,
    weather_feature_names,
    weather_features,
)
from delaylake.operators.observations import (
    bronze_observations,
    silver_observations,
    station_join_loss,
)
from delaylake.operators.timeline import (
    JT_TRIP_COLUMNS,
    LOOKBACK_HOURS,
    attach_observed,
    attach_stored,
    complete_trips,
    hourly_observations,
    join_weather,
    label_trips,
    weather_strips,
    with_ends,
    within_trip_times,
)
from delaylake.operators.trips import (
    bronze_trips,
    clean_trips,
    unique_trips,
    with_trip_key,
)
from delaylake.plans import versions
from delaylake.sources import files
from delaylake.sources.schemas import OBSERVATION_COLUMNS, TRIP_COLUMNS


@dataclass(frozen=True)
class RawInputs:
    """Raw file locations. ``months`` are file stems such as ``201201``."""

    trips_folder: str
    observations_folder: str
    mapping_file: str
    months: Sequence[str]

    def only(self, month: str) -> RawInputs:
        return replace(self, months=[month])

    @property
    def trip_files(self) -> list[str]:
        return files.monthly_paths(self.trips_folder, self.months, ".csv")

    @property
    def observation_files(self) -> list[str]:
        return files.monthly_paths(self.observations_folder, self.months, "hourly.txt")


@dataclass(frozen=True)
class Lake:
    """Locations of the stage tables below one root folder."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


BRONZE_TRIPS = "bronze/trips"
BRONZE_OBSERVATIONS = "bronze/observations"
SILVER_TRIPS = "silver/trips"
SILVER_OBSERVATIONS = "silver/observations"
SILVER_EXTENTS = "silver/extents"
SILVER_SKETCHES = "silver/key_sketches"
GOLD_JOINED = "gold/joined"
GOLD_TARGETS = "gold/targets"
GOLD_STRIPS = "gold/strips"
# Manifests of tables that held timelines lie in gold/manifest: such a lake builds its gold again.
GOLD_MANIFEST = "gold/manifest_strips"

MONTHS = ("year", "month")
SLICES = ("ds", "th", "year", "month")
# The label C of joined trips means this threshold in every run.
LABEL_TH = targets.THRESHOLDS[0]


def input_part(month: str) -> str:
    """The folder of what one input month gave: it is written and replaced as a whole."""
    return f"input={month}"


def _write_month(
    lake: Lake, names: Sequence[str], frames: Sequence[DataFrame], month: str
) -> None:
    for name, df in zip(names, frames):
        files.reject_duplicate_columns(df)
        files.write_table(df, f"{lake.path(name)}/{input_part(month)}", MONTHS)


def _by_month(
    spark: SparkSession,
    raw: RawInputs,
    lake: Lake,
    names: Sequence[str],
    shapes: Sequence[DataFrame],
    build: Callable[[RawInputs], Sequence[DataFrame]],
    refresh: Sequence[str],
    before: Callable[[str], None] = lambda month: None,
) -> list[DataFrame]:
    """The tables of the requested months: stored ones are read, missing ones built and stored.

    Months outside the request stay as they are. ``refresh`` names months to
    build again although they are stored. ``before`` is called before a month is written.
    """
    for month in raw.months:
        done = all(
            files.table_exists(spark, f"{lake.path(n)}/{input_part(month)}") for n in names
        )
        if not done or month in refresh:
            before(month)
            _write_month(lake, names, build(raw.only(month)), month)
    parts = [input_part(m) for m in raw.months]
    return [
        files.read_table(spark, lake.path(n), df.schema, parts) for n, df in zip(names, shapes)
    ]


def bronze(
    raw_trips: DataFrame, raw_observations: DataFrame, mapping: DataFrame
) -> tuple[DataFrame, DataFrame]:
    return (
        bronze_trips(raw_trips, airport_offsets(mapping)),
        bronze_observations(raw_observations),
    )


def silver(
    trips: DataFrame, observations: DataFrame, mapping: DataFrame
) -> tuple[DataFrame, DataFrame]:
    return clean_trips(trips), silver_observations(observations, station_offsets(mapping))


def gold_joined(trips: DataFrame, observations: DataFrame) -> DataFrame:
    """Joined trips, labeled at ``LABEL_TH``."""
    keyed = with_trip_key(trips)
    return label_trips(join_weather(keyed, observations, all_trips=trips), LABEL_TH)


def gold_stored(trips: DataFrame, observations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`gold_joined` as it is stored: labeled trips without timelines, and the strips they come from.

    A trip's timelines are 26 points that many trips share; the strips have
    each point twice at most, however many the trips.
    """
    base = unique_trips(complete_trips(with_trip_key(trips)).select(*JT_TRIP_COLUMNS))
    near = within_trip_times(observations, trips)
    return label_trips(base, LABEL_TH), weather_strips(hourly_observations(near))


def gold_targets(
    joined: DataFrame,
    thresholds: Sequence[int] = targets.THRESHOLDS,
    tau: float = targets.TAU,
    seed: int = targets.GOLD_SEED,
) -> DataFrame:
    """Targets of stored joined trips: two narrow scans and one wide one.

    The membership of a trip follows from its own row and 25 counts, so no key
    table has to be joined back.
    """
    grid = targets.target_grid(joined, thresholds, tau)
    return targets.build_targets(joined, grid, tau, seed)


def gold_targets_direct(
    trips: DataFrame,
    observations: DataFrame,
    thresholds: Sequence[int] = targets.THRESHOLDS,
    tau: float = targets.TAU,
    seed: int = targets.GOLD_SEED,
    packed: bool = False,
) -> DataFrame:
    """The same targets of silver tables, without storing the joined trips.

    Weather is attached only to trips that belong to some dataset; of
    ``packed`` targets, one row per trip, a slice attaches it to its own trips:
    the datasets of a trip are a column before the joins, so that a filter on
    them passes these whatever the counts come from.
    """
    chosen, grid = _chosen_trips(trips, thresholds, tau, seed)
    if packed:
        rows = with_ends(targets.build_targets(label_trips(chosen, LABEL_TH), grid, tau, seed, packed))
        return attach_observed(rows, observations, chosen, trips).select(*targets.PACKED_COLUMNS)
    joined = join_weather(chosen, observations, deduplicate=False, all_trips=trips)
    return targets.build_targets(label_trips(joined, LABEL_TH), grid, tau, seed)


def _chosen_trips(
    trips: DataFrame, thresholds: Sequence[int], tau: float, seed: int
) -> tuple[DataFrame, Column]:
    """Trips of some dataset, one row each, and the grid of the datasets."""
    keyed = with_trip_key(trips)
    timed = unique_trips(complete_trips(keyed).select(*JT_TRIP_COLUMNS))
    grid = targets.target_grid(timed, thresholds, tau)
    return targets.trips_in_targets(timed, grid, thresholds, seed), grid


def packed_targets_stored(
    trips: DataFrame,
    observations: DataFrame,
    thresholds: Sequence[int] = targets.THRESHOLDS,
    tau: float = targets.TAU,
    seed: int = targets.GOLD_SEED,
) -> tuple[DataFrame, DataFrame]:
    """Packed targets as they are stored: without timelines, and the strips they come from.

    :func:`attach_stored` gives a slice its timelines.
    """
    chosen, grid = _chosen_trips(trips, thresholds, tau, seed)
    rows = targets.build_targets(label_trips(chosen, LABEL_TH), grid, tau, seed, packed=True)
    return rows, weather_strips(hourly_observations(within_trip_times(observations, trips)))


MAPPING_COLUMNS = ["WBAN", "AirportID", "TimeZone"]


def raw_mapping(spark: SparkSession, raw: RawInputs) -> DataFrame:
    return files.read_delimited(spark, [raw.mapping_file], columns=MAPPING_COLUMNS)


def bronze_frames(spark: SparkSession, raw: RawInputs) -> tuple[DataFrame, DataFrame]:
    """Bronze frames of the raw files, nothing stored."""
    return bronze(
        files.read_delimited(spark, raw.trip_files, columns=TRIP_COLUMNS),
        files.read_delimited(spark, raw.observation_files, columns=OBSERVATION_COLUMNS),
        raw_mapping(spark, raw),
    )


def _no_rows(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))


def shapes(spark: SparkSession) -> dict[str, DataFrame]:
    """Empty frames with the columns of the stage tables; no input is touched."""
    mapping = _no_rows(spark, MAPPING_COLUMNS)
    b = bronze(_no_rows(spark, TRIP_COLUMNS), _no_rows(spark, OBSERVATION_COLUMNS), mapping)
    s = silver(*b, mapping)
    joined, strips = gold_stored(*s)
    return {
        BRONZE_TRIPS: b[0],
        BRONZE_OBSERVATIONS: b[1],
        SILVER_TRIPS: s[0],
        SILVER_OBSERVATIONS: s[1],
        GOLD_JOINED: joined,
        GOLD_STRIPS: strips.withColumn("build", F.lit("")),
        GOLD_TARGETS: gold_targets(joined),
    }


def run_bronze(
    spark: SparkSession,
    raw: RawInputs,
    lake: Lake,
    store: bool = True,
    refresh: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    if not store:
        return bronze_frames(spark, raw)
    names, shape = [BRONZE_TRIPS, BRONZE_OBSERVATIONS], shapes(spark)
    build = lambda part: bronze_frames(spark, part)
    return tuple(
        _by_month(spark, raw, lake, names, [shape[n] for n in names], build, refresh)
    )


def run_silver(
    spark: SparkSession,
    raw: RawInputs,
    lake: Lake,
    store: bool = True,
    refresh: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Silver tables; a station join that loses too many readings raises a warning."""

    def build(part: RawInputs) -> tuple[DataFrame, DataFrame]:
        again = [m for m in part.months if m in refresh]
        trips, observations = run_bronze(spark, part, lake, store, again)
        loss = join_loss(spark, part, observations).first()
        if loss["alarm"]:
            warnings.warn(
                f"months {', '.join(part.months)}: {loss['loss_pct']:.1f} % of the observations "
                "are at stations without an airport",
                stacklevel=2,
            )
        return silver(trips, observations, raw_mapping(spark, raw))

    if not store:
        return build(raw)
    names, shape = [SILVER_TRIPS, SILVER_OBSERVATIONS], shapes(spark)

    def forget(month: str) -> None:
        """What is known of a build of the month goes before the next is written."""
        for name in (SILVER_EXTENTS, SILVER_SKETCHES):
            files.remove_folder(spark, f"{lake.path(name)}/{input_part(month)}")

    return tuple(
        _by_month(spark, raw, lake, names, [shape[n] for n in names], build, refresh, forget)
    )


def key_report(spark: SparkSession, raw: RawInputs, lake: Lake) -> DataFrame:
    """Distinct keys of the stored silver trips, from a sketch per input month.

    A month is scanned once, when its sketch is absent: after a new month only
    that one. Months that are not stored yet are built first.
    """
    run_silver(spark, raw, lake)
    shape = shapes(spark)[SILVER_TRIPS].schema
    for month in raw.months:
        path = f"{lake.path(SILVER_SKETCHES)}/{input_part(month)}"
        if not files.table_exists(spark, path):
            trips = files.read_table(spark, lake.path(SILVER_TRIPS), shape, [input_part(month)])
            files.write_table(quality.key_sketches(trips), path)
    parts = [input_part(m) for m in raw.months]
    return quality.sketched_cardinalities(
        files.read_table(spark, lake.path(SILVER_SKETCHES), parts=parts)
    )


# ---- gold, part by part ---------------------------------------------------
#
# The joined trips and the targets are kept per part: a year and month of trips. A part depends on the
# input months whose trips fall into it and on those whose readings its trips can look back to. Only parts
# whose inputs changed are joined again. Class counts are kept per part and add up. Each part stores somewhat
# more negatives than are drawn (RESERVE), so new totals seldom touch the targets of old parts; a reader
# keeps exactly those that the current totals draw. Neither table holds timelines: the strips are stored
# beside each version of the joined trips, and a reader gets both timelines from them.

RESERVE = 1.25
COUNT_COLUMNS = targets.COUNTS
KEPT_COLUMNS = [f"kept_{ds.lower()}" for ds in targets.DATASETS]
EXTENT = "source string, year int, month string, low timestamp, high timestamp, build string"
MANIFEST = (
    "year int, month string, th int, months string, inputs string, joined string, targets string, "
    + ", ".join(f"{c} bigint" for c in COUNT_COLUMNS)
    + ", "
    + ", ".join(f"{c} double" for c in KEPT_COLUMNS)
)


@dataclass(frozen=True, order=True)
class Part:
    """A month of trips."""

    year: int
    month: str


@dataclass(frozen=True)
class Entry:
    """What the manifest knows of one part at one threshold."""

    part: Part
    th: int
    months: str
    inputs: str
    joined: str
    targets: str
    counts: tuple[int, ...]
    kept: tuple[float, ...]

    @staticmethod
    def of(row) -> Entry:
        return Entry(
            Part(row["year"], row["month"]),
            *(row[n] for n in ("th", "months", "inputs", "joined", "targets")),
            tuple(row[c] for c in COUNT_COLUMNS),
            tuple(row[c] for c in KEPT_COLUMNS),
        )

    def row(self) -> tuple:
        fixed = (self.part.year, self.part.month, self.th, self.months, self.inputs)
        return (*fixed, self.joined, self.targets, *self.counts, *self.kept)


def _extent_path(lake: Lake, month: str) -> str:
    return f"{lake.path(SILVER_EXTENTS)}/{input_part(month)}"


def _write_extent(spark: SparkSession, lake: Lake, month: str) -> None:
    """The months that an input's trips and readings fall into, and the times its trips look at.

    A narrow scan of the input just stored; ``build`` tells one build of the input from the next.
    """
    shape, parts = shapes(spark), [input_part(month)]
    trips, readings = (
        files.read_table(spark, lake.path(n), shape[n].schema, parts)
        for n in (SILVER_TRIPS, SILVER_OBSERVATIONS)
    )
    back = F.expr(f"interval {LOOKBACK_HOURS + 1} hours")
    flown = complete_trips(trips).select("year", "month", "dep_ts_utc", "arr_ts_utc")
    reach = flown.groupBy("year", "month").agg(
        (F.min(F.least("dep_ts_utc", "arr_ts_utc")) - back).alias("low"),
        F.max(F.greatest("dep_ts_utc", "arr_ts_utc")).alias("high"),
    )
    seen = readings.filter("obs_utc is not null").groupBy("year", "month")
    times = seen.agg(F.min("obs_utc").alias("low"), F.max("obs_utc").alias("high"))
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(EXTENT)]
    build = F.lit(uuid.uuid4().hex[:12]).alias("build")
    rows = [df.select(F.lit(s).alias("source"), "*", build).select(*columns) for s, df in (("trips", reach), ("readings", times))]
    files.write_table(rows[0].unionByName(rows[1]).coalesce(1), _extent_path(lake, month))


def _month_number(year: int, month: int | str) -> int:
    return year * 12 + int(month) - 1


@dataclass
class _Reach:
    """The inputs of a part and the months of readings that its trips look at."""

    inputs: str
    readings: set[int]


def gold_parts(spark: SparkSession, raw: RawInputs, lake: Lake) -> dict[Part, _Reach]:
    """The parts that the requested input months make up, from a few rows per input month."""
    extents: dict[str, list] = {}
    for month in raw.months:
        if not files.table_exists(spark, _extent_path(lake, month)):
            _write_extent(spark, lake, month)
        found = files.read_table(spark, _extent_path(lake, month), StructType.fromDDL(EXTENT)).select(
            "source", "year", "month", "build",
            *(F.year(c).alias(f"{c}_year") for c in ("low", "high")),
            *(F.month(c).alias(f"{c}_month") for c in ("low", "high")),
        ).collect()
        extents[month] = found
    readings: dict[str, set[int]] = {
        m: {_month_number(r["year"], r["month"]) for r in rows if r["source"] == "readings"}
        for m, rows in extents.items()
    }
    looked: dict[Part, set[int]] = {}
    givers: dict[Part, set[str]] = {}
    for input_month, rows in extents.items():
        for r in rows:
            if r["source"] == "trips":
                part = Part(r["year"], r["month"])
                low = _month_number(r["low_year"], r["low_month"])
                high = _month_number(r["high_year"], r["high_month"])
                looked.setdefault(part, set()).update(range(low, high + 1))
                givers.setdefault(part, set()).add(input_month)
    builds = {m: rows[0]["build"] for m, rows in extents.items() if rows}
    parts = {}
    for part, months in looked.items():
        used = givers[part] | {m for m, seen in readings.items() if seen & months}
        parts[part] = _Reach(",".join(f"{m}:{builds[m]}" for m in sorted(used)), months)
    return parts


def manifest(spark: SparkSession, lake: Lake) -> list[Entry]:
    """The current state of gold: one entry per part and threshold."""
    return [Entry.of(r) for r in versions.current(spark, lake.path(GOLD_MANIFEST), StructType.fromDDL(MANIFEST))]


def _in_parts(parts: Sequence[Part]) -> Column:
    """Rows of some parts; prunes the folders of tables split by year and month."""
    months: dict[int, list[str]] = {}
    for part in sorted(parts):
        months.setdefault(part.year, []).append(part.month)
    tests = [(F.col("year") == y) & F.col("month").isin(ms) for y, ms in months.items()]
    return reduce(lambda a, b: a | b, tests)


def _read_trips(spark: SparkSession, lake: Lake, places: dict[Part, str]) -> DataFrame:
    """The stored trips of some parts, without timelines; no other part is listed or read."""
    schema = shapes(spark)[GOLD_JOINED].schema
    folders: dict[str, list[str]] = {}
    for part, version in sorted(places.items()):
        folders.setdefault(version, []).append(f"year={part.year}/month={part.month}")
    return reduce(
        DataFrame.unionByName,
        [files.read_table(spark, f"{lake.path(GOLD_JOINED)}/{v}", schema, parts) for v, parts in folders.items()],
    )


def _with_weather(
    spark: SparkSession, lake: Lake, rows: DataFrame, builds: dict[tuple, str], by: Sequence[str]
) -> DataFrame:
    """Both timelines from the stored strips; ``builds`` names their version per value of the columns ``by``."""
    named = (x for key, v in sorted(builds.items()) for x in ("/".join(map(str, key)), v))
    build = F.try_element_at(F.create_map(*map(F.lit, named)), F.concat_ws("/", *by))
    parts = [f"build={v}" for v in sorted(set(builds.values()))]
    strips = files.read_table(spark, lake.path(GOLD_STRIPS), shapes(spark)[GOLD_STRIPS].schema, parts)
    return attach_stored(rows.withColumn("build", build), strips, ["build"]).drop("build")


def _read_joined(spark: SparkSession, lake: Lake, places: dict[Part, str]) -> DataFrame:
    """The joined trips of some parts, with both timelines."""
    builds = {(p.year, p.month): version for p, version in places.items()}
    return _with_weather(spark, lake, _read_trips(spark, lake, places), builds, MONTHS)


def read_joined(spark: SparkSession, lake: Lake) -> DataFrame:
    """The current joined trips of all parts; those of the lowest threshold, should a part have several builds."""
    entries = sorted(manifest(spark, lake), key=lambda e: e.th, reverse=True)
    if not entries:
        raise ValueError(f"no joined trips stored in {lake.path(GOLD_JOINED)}")
    return _read_joined(spark, lake, {e.part: e.joined for e in entries})


def _total_shares(entries: Sequence[Entry]) -> dict[tuple[str, int], float]:
    """The share of negatives to draw per dataset and threshold, from the counts of all parts."""
    sums: dict[int, list[int]] = {}
    for e in entries:
        old = sums.get(e.th, [0] * len(COUNT_COLUMNS))
        sums[e.th] = [a + b for a, b in zip(old, e.counts)]
    return {(ds, th): s for th, n in sums.items() for ds, s in targets.kept_shares(n).items()}


def read_targets(
    spark: SparkSession, lake: Lake, thresholds: Sequence[int] | None = None
) -> DataFrame:
    """The current targets of some or all stored thresholds; asking for one not stored is an error."""
    entries = manifest(spark, lake)
    stored = {e.th for e in entries}
    wanted = stored if thresholds is None else set(thresholds)
    if not entries or not wanted <= stored:
        missing = f"thresholds {sorted(wanted - stored)}" if entries else "targets"
        raise ValueError(f"no {missing} stored in {lake.path(GOLD_TARGETS)}")
    chosen = [e for e in entries if e.th in wanted]
    schema = shapes(spark)[GOLD_TARGETS].schema
    places: dict[str, dict[int, list[Part]]] = {}
    for e in chosen:
        places.setdefault(e.targets, {}).setdefault(e.th, []).append(e.part)
    frames = []
    for version, by_threshold in places.items():
        alike: dict[tuple[Part, ...], list[int]] = {}
        for th, parts in by_threshold.items():
            alike.setdefault(tuple(sorted(parts)), []).append(th)
        tests = [F.col("th").isin(ths) & _in_parts(parts) for parts, ths in alike.items()]
        table = files.read_table(spark, f"{lake.path(GOLD_TARGETS)}/{version}", schema)
        frames.append(table.filter(reduce(lambda a, b: a | b, tests)))
    rows = targets.drawn_rows(
        reduce(DataFrame.unionByName, frames), _total_shares(chosen), targets.GOLD_SEED
    )
    builds = {(e.part.year, e.part.month, e.th): e.joined for e in chosen}
    placed = _with_weather(spark, lake, rows, builds, [*MONTHS, "th"])
    return placed.select(*targets.TARGET_COLUMNS)


def run_gold(
    spark: SparkSession,
    raw: RawInputs,
    lake: Lake,
    thresholds: Sequence[int] = targets.THRESHOLDS,
    store: bool = True,
    refresh: Sequence[str] = (),
) -> DataFrame:
    """Targets of the thresholds over the requested months.

    Parts whose inputs are as they were keep their joined trips, and their
    targets too unless a share has outgrown what they store. New folders are
    written first; one manifest then makes them the state of the thresholds of
    the run. Other thresholds keep theirs. A broken run leaves the former state.
    """
    trips, observations = run_silver(spark, raw, lake, store, refresh)
    if not store:
        return gold_targets_direct(trips, observations, thresholds)
    parts = gold_parts(spark, raw, lake)
    if not parts:
        raise ValueError("no trip with both times in the requested months")
    former = manifest(spark, lake)
    fresh = {(e.part, e.th): e for e in former if e.part in parts and parts[e.part].inputs == e.inputs}
    places = _joined_places(spark, lake, parts, fresh, trips, observations)
    counts = _part_counts(spark, lake, places, fresh, thresholds)
    entries = [
        Entry(p, th, _months(raw), r.inputs, places[p], "", counts[p, th], ())
        for p, r in sorted(parts.items())
        for th in thresholds
    ]
    others = [e for e in former if e.th not in thresholds]
    stored = _store_targets(spark, lake, entries, fresh)
    versions.commit(spark, lake.path(GOLD_MANIFEST), [e.row() for e in others + stored], StructType.fromDDL(MANIFEST))
    return read_targets(spark, lake, thresholds)


def _joined_places(
    spark: SparkSession,
    lake: Lake,
    parts: dict[Part, _Reach],
    fresh: dict[tuple[Part, int], Entry],
    trips: DataFrame,
    observations: DataFrame,
) -> dict[Part, str]:
    """The version that holds each part's joined trips; those of changed parts are joined and written."""
    places = {part: e.joined for (part, _), e in fresh.items()}
    changed = [p for p in parts if p not in places]
    if changed:
        months = sorted(set().union(*(parts[p].readings for p in changed)))
        near = [Part(n // 12, f"{n % 12 + 1:02d}") for n in months]
        joined, strips = gold_stored(trips.filter(_in_parts(changed)), observations.filter(_in_parts(near)))
        files.reject_duplicate_columns(joined)
        version = versions.new_version()
        files.write_table(strips, f"{lake.path(GOLD_STRIPS)}/build={version}")
        files.write_table(joined, f"{lake.path(GOLD_JOINED)}/{version}", MONTHS)
        places.update(dict.fromkeys(changed, version))
    return places


def _part_counts(
    spark: SparkSession,
    lake: Lake,
    places: dict[Part, str],
    fresh: dict[tuple[Part, int], Entry],
    thresholds: Sequence[int],
) -> dict[tuple[Part, int], tuple[int, ...]]:
    """Class counts per part and threshold: known ones, and one scan of the parts that lack some."""
    counts = {key: e.counts for key, e in fresh.items()}
    missing = {p for p in places for th in thresholds if (p, th) not in counts}
    if missing:
        joined = _read_trips(spark, lake, {p: places[p] for p in missing})
        measures = targets.delay_measures(joined, also_keep=MONTHS)
        for r in targets.class_counts(measures, thresholds, by=MONTHS).collect():
            counts[Part(r["year"], r["month"]), r["th"]] = tuple(r[c] for c in COUNT_COLUMNS)
    return counts


def _store_targets(
    spark: SparkSession, lake: Lake, entries: list[Entry], fresh: dict[tuple[Part, int], Entry]
) -> list[Entry]:
    """The entries with the place of their targets, written where none hold what the shares ask for."""
    shares = _total_shares(entries)
    version, stored, due = versions.new_version(), [], []
    for e in entries:
        old = fresh.get((e.part, e.th))
        asked = tuple(shares[ds, e.th] for ds in targets.DATASETS)
        if old and all(kept >= share for kept, share in zip(old.kept, asked)):
            stored.append(replace(e, targets=old.targets, kept=old.kept))
        else:
            kept = tuple(min(1.0, RESERVE * share) for share in asked)
            stored.append(replace(e, targets=version, kept=kept))
            due.append(stored[-1])
    by_parts: dict[tuple[Part, ...], list[int]] = {}
    for th in sorted({e.th for e in due}):
        by_parts.setdefault(tuple(sorted(e.part for e in due if e.th == th)), []).append(th)
    frames = []
    for parts, ths in by_parts.items():
        places = {e.part: e.joined for e in due if e.part in parts}
        cells = {(ds, e.th): k for e in due if e.th in ths for ds, k in zip(targets.DATASETS, e.kept)}
        joined = _read_trips(spark, lake, places)
        frames.append(targets.build_targets(joined, targets.literal_cells(cells), seed=targets.GOLD_SEED))
    if frames:
        rows = reduce(DataFrame.unionByName, frames)
        files.write_table(rows, f"{lake.path(GOLD_TARGETS)}/{version}", SLICES)
    return stored


def vacuum(spark: SparkSession, lake: Lake) -> list[str]:
    """Delete versions that the current manifest does not name, and former manifests.

    For times without readers of a former state and without a running gold job.
    """
    entries = manifest(spark, lake)
    gone = versions.remove_unused(spark, lake.path(GOLD_JOINED), {e.joined for e in entries})
    gone += versions.remove_unused(spark, lake.path(GOLD_STRIPS), {e.joined for e in entries}, "build=")
    gone += versions.remove_unused(spark, lake.path(GOLD_TARGETS), {e.targets for e in entries})
    versions.remove_former(spark, lake.path(GOLD_MANIFEST))
    return gone


def _months(raw: RawInputs) -> str:
    return ",".join(sorted(raw.months))


def targets_table(
    spark: SparkSession,
    raw: RawInputs,
    lake: Lake,
    thresholds: Sequence[int] = targets.THRESHOLDS,
    store: bool = True,
) -> DataFrame:
    """The stored targets, or a gold run unless they cover the months and thresholds."""
    covered = {e.th for e in manifest(spark, lake) if e.months == _months(raw)}
    if covered.issuperset(thresholds):
        return read_targets(spark, lake, thresholds)
    return run_gold(spark, raw, lake, thresholds, store)


def bronze_reports(trips: DataFrame, observations: DataFrame) -> dict[str, DataFrame]:
    shown = [c for c in quality.OBSERVATION_REPORT if c in observations.columns]
    readings = observations.select(*shown) if shown else observations
    return {
        "trips_nulls": quality.missing_counts(trips),
        "trips_uniques": quality.distinct_counts(trips, quality.BRONZE_TRIP_KEYS),
        "readings_nulls": quality.missing_counts(readings),
        "readings_uniques": quality.distinct_counts(readings, quality.OBSERVATION_KEYS),
    }


def silver_reports(trips: DataFrame) -> dict[str, DataFrame]:
    return {
        "nulls_report": quality.null_rates(trips),
        "uniques_report": quality.key_cardinalities(trips),
        "quantiles_report": quality.delay_quantiles(trips),
        "delay_rules": quality.delay_rules(trips),
        "delay_rules_violations_sample": quality.rule_violations(trips),
    }


def ratio_reports(joined: DataFrame) -> dict[str, DataFrame]:
    measures = ratios.ratio_measures(joined)
    return {
        "counts_by_tau": ratios.tau_counts(measures),
        "tau_one": ratios.tau_one_counts(measures),
        "hist_ratio_adj": ratios.ratio_histogram(measures),
    }


def diagnostic_reports(
    table: DataFrame,
    silver_trips: DataFrame,
    silver_obs: DataFrame,
    bronze_obs: DataFrame,
    ds: str = "D2",
    th: int = 60,
    origin_hours: int = 7,
    dest_hours: int = 7,
) -> dict[str, DataFrame]:
    """All diagnostics of one slice; an empty slice is an error."""
    rows = targets.target_slice(table, ds, th)
    if rows.isEmpty():
        raise ValueError(f"no targets for ds={ds}, th={th}")
    names = weather_feature_names(origin_hours, dest_hours)
    reports = {
        "array_population": diagnostics.array_population(rows),
        "array_sizes": diagnostics.array_size_histogram(rows),
        "struct_nulls": diagnostics.struct_null_rates(rows),
        "newest_origin_points": diagnostics.newest_points(rows, "Wo"),
        "newest_dest_points": diagnostics.newest_points(rows, "Wd"),
        "observation_check": quality.observation_check(bronze_obs),
        "observation_sample": quality.observation_sample(bronze_obs),
        "coverage": diagnostics.coverage_counts(silver_obs, silver_trips),
        "missing_airports": diagnostics.airports_without_weather(silver_obs, silver_trips),
        "temporal_coverage": diagnostics.temporal_coverage(silver_obs, silver_trips),
        "per_airport": diagnostics.observations_per_airport(silver_obs),
    }
    if names:
        features = weather_features(flat_features(rows), origin_hours, dest_hours)
        variances = diagnostics.feature_variances(features, names)
        reports["variance_extremes"] = diagnostics.variance_extremes(variances)
        reports["variance_counts"] = diagnostics.variance_counts(variances)
        reports["feature_statistics"] = diagnostics.feature_statistics(features)
        reports["feature_sample"] = diagnostics.feature_sample(features)
    return reports


def run_diagnostics(
    spark: SparkSession, raw: RawInputs, lake: Lake, **slice_of
) -> dict[str, DataFrame]:
    """Diagnostics of the stored tables, building what is missing."""
    _, bronze_obs = run_bronze(spark, raw, lake)
    trips, observations = run_silver(spark, raw, lake)
    table = targets_table(spark, raw, lake)
    reports = diagnostic_reports(table, trips, observations, bronze_obs, **slice_of)
    return {**reports, "station_join_loss": join_loss(spark, raw, bronze_obs)}


def join_loss(spark: SparkSession, raw: RawInputs, bronze_obs: DataFrame) -> DataFrame:
    return station_join_loss(bronze_obs, station_offsets(raw_mapping(spark, raw)))


def write_reports(reports: dict[str, DataFrame], folder: str) -> None:
    """One CSV per report."""
    for name, df in reports.items():
        files.write_report(df, f"{folder.rstrip('/')}/{name}")
