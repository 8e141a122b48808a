"""The end-to-end jobs, built by ``transform`` calls.

``clean_segments`` and ``enrich_segments`` run jobs while they are called: what is read
several times is written to the shared folder first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windward.functions import text, times
from windward.operators import columns, derived, filters, names, profile, upsert, weather
from windward.operators.asof import nearest_join
from windward.operators.counted import StepCounts, counted
from windward.operators.lookup import lookup_join
from windward.schemas import PROCESSED_COLUMNS, WEATHER_KEY, require_columns
from windward.session import settle, stage, stage_parts, staged_so_far
from windward.sources import race_xml
from windward.sources.tables import typed_segments

# Columns the processed layer does without.
UNUSED = ["start_position", "rank_exit_scraped", "max_speed_kn", "max_vmg", "max_vmc", "avg_vmg"]
SUPERSEDED = ["avg_speed_kn", "avg_vmc"]
WEATHER_FIELDS = ["temperature_c", "pressure_hpa", "humidity_pct", "wind_speed_kn", "wind_dir_weather", "rain_mm"]
PLACE_KEYS = ["lat_key", "lon_key", "segment_date"]
PART_ROWS = 10_000_000  # wide rows that are shuffled at a time


def collect_segments(races: DataFrame, known: DataFrame | None = None, zone: str = "UTC") -> DataFrame:
    """Landed race documents to typed segment rows, without the races already known."""
    fresh = races if known is None else upsert.not_yet_known(races, known, "race_id")
    return typed_segments(race_xml.parse_races(fresh, zone=zone))


def weather_hours(segments: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The place-hours of weather that the segments need."""
    located = segments.transform(weather.parse_coordinates).transform(derived.segment_times)
    return weather.hour_spine(weather.location_ranges(located, by=by))


def clean_segments(
    segments: DataFrame, order: Column, first_names: DataFrame | None = None,
    rules: dict[str, str] | None = None, threshold: int = names.THRESHOLD, counts: StepCounts | None = None,
) -> DataFrame:
    """Names unified, excluded runs out, profile extracted and then completed.

    The event rules look at the course as landed, before its tokens are removed. ``counts`` is told the rows after each
    filter; names are unified here and now, which runs the filters.
    """
    out = (
        counted(counts, require_columns(segments, ["athlete_name", "serial_no", "course", "event_name"]), "landed")
        .transform(columns.drop_columns, UNUSED)
        .transform(lambda df: counted(counts, filters.exclude_matching(df, "course"), "excluded runs"))
        .transform(lambda df: counted(counts, filters.exclude_by_rule(df, rules or {}), "event rules"))
        .withColumn("athlete_name", text.clean_name(F.col("athlete_name")))
        .transform(names.unify_names, "athlete_name", order, threshold)
        .transform(profile.extract_profile)
    )
    if first_names is not None:
        out = out.transform(profile.fill_sex, first_names)
    return out.transform(
        profile.fill_from_key, ["serial_no", "athlete_name"], "age_class", order, "Senior"
    )


def latest_weather(table: DataFrame, order: list[str]) -> DataFrame:
    """One reading per day, hour and city: the one written last by ``order``."""
    return upsert.keep_last(table, WEATHER_KEY, [F.col(c) for c in order])


def weather_readings(table: DataFrame) -> DataFrame:
    """Weather rows with the key and time the nearest join uses."""
    return table.select(
        text.coordinate_key(F.round("latitude", 4)).alias("lat_key"),
        text.coordinate_key(F.round("longitude", 4)).alias("lon_key"),
        times.date_from_parts(F.col("year"), F.col("month"), F.col("day")).alias("segment_date"),
        times.clock_seconds(F.col("time")).alias("time_seconds"),
        *[c for c in table.columns],
    )


def timed_segments(segments: DataFrame) -> DataFrame:
    """Times, speeds and place keys: column expressions only."""
    return (
        segments.transform(derived.segment_times)
        .transform(derived.segment_speeds)
        .transform(columns.drop_columns, SUPERSEDED)
        .transform(weather.parse_coordinates)
        .withColumn("lat_key", text.coordinate_key(F.col("lat")))
        .withColumn("lon_key", text.coordinate_key(F.col("lon")))
    )


def attach_weather(
    timed: DataFrame, weather_table: DataFrame, points: DataFrame | None = None,
    left_if_no_match: bool = False, order: list[str] | None = None,
) -> DataFrame:
    """The weather reading nearest to mid-segment, at the same place and day; of several at one
    instant the last by ``order``."""
    readings = weather_readings(weather_table)
    payload = [c for c in readings.columns if c not in [*PLACE_KEYS, *(order or [])]]
    return nearest_join(
        timed, readings, PLACE_KEYS, "mid_seconds", "time_seconds", payload, order,
        points=points, left_if_no_match=left_if_no_match, suffix="_weather",
    ).transform(columns.drop_suffixed, "_weather")


def covered_segments(
    timed: DataFrame, weather_table: DataFrame, left_if_no_match: bool = False
) -> DataFrame:
    """Segments at a place and day with weather; all of them if none is and the option says so."""
    places = weather_readings(weather_table).select(*PLACE_KEYS).na.drop().distinct()
    covered = lookup_join(timed, places, PLACE_KEYS, "left_semi")
    if not left_if_no_match:
        return covered
    met = lookup_join(timed.select(*PLACE_KEYS).distinct(), places, PLACE_KEYS, "left_semi")
    return covered.unionByName(timed.where(met.agg(F.count("*")).scalar() == 0))


def met_by_row(landed: DataFrame, found: DataFrame, since: int) -> DataFrame:
    """Staged rows with what was found for them, by ``_row``.

    Beyond ``PART_ROWS`` rows, a range of row numbers after the other is shuffled and written, and then
    the tables staged since the given moment are deleted: the shuffle files of all wide rows would take several times the room.
    """
    n = -(-landed.count() // PART_ROWS)
    if n < 2:
        return lookup_join(landed, found, ["_row"], "inner")
    cuts = sorted({int(c) for c in landed.approxQuantile("_row", [i / n for i in range(1, n)], 0.1 / n)})
    inside = [F.col("_row").between(a + 1, b) for a, b in zip([-1, *cuts], [*cuts, 2**63 - 1], strict=True)]
    return stage_parts((lookup_join(landed.where(i), found.where(i), ["_row"], "inner") for i in inside), "met", since, "zstd")


def enrich_segments(
    segments: DataFrame, weather_table: DataFrame, left_if_no_match: bool = False,
    weather_order: list[str] | None = None,
) -> DataFrame:
    """Cleaned segments and hourly weather to the processed layer.

    ``weather_order`` names the columns that say which reading was written last; then
    the last one per day, hour and city counts. Without it the table must hold one each.

    The segments are written once as they come, with a row number. Ranks and weather are
    looked up on a narrow table of what they need, so the wide rows are shuffled
    once, to meet their results, and times and measures are computed from them afterwards. Segments without weather
    drop out first, so ranks count only the others. Each step's result is written before the next begins, and
    what led to it is deleted: the segments and the results found for them are all that is left (see ``met_by_row``).
    """
    first = staged_so_far()
    landed = stage(segments.withColumn("_row", F.monotonically_increasing_id()), "segments", "zstd")
    timed = timed_segments(landed)
    narrow = timed.select("_row", *derived.SEGMENT_KEY, *PLACE_KEYS, "mid_seconds", "segment_time_s", "segment_end")
    since = staged_so_far()
    if weather_order:
        weather_table = stage(latest_weather(weather_table, weather_order), "weather", "zstd")
    before_ranks = staged_so_far()
    covered = stage(covered_segments(narrow, weather_table, left_if_no_match), "covered", "zstd")
    ranked = settle(covered.transform(derived.segment_ranks), "ranked", before_ranks, "zstd")
    met = attach_weather(ranked, weather_table, ranked, left_if_no_match, weather_order)
    new = [c for c in met.columns if c not in timed.columns]
    # Under names of their own, as the segments' may clash until their times are computed.
    own = {c: f"_found_{i}" for i, c in enumerate(new)}
    found = settle(met.select("_row", *[F.col(c).alias(own[c]) for c in new]), "found", since, "zstd")
    kept = [c for c in timed.columns if c not in ("_row", "lat", "lon", "lat_key", "lon_key")]
    return (
        met_by_row(landed, found, first)
        .transform(timed_segments)
        .select(*kept, *[F.col(own[c]).alias(c) for c in new])
        .transform(derived.course_speeds)
        .transform(derived.distance_diffs)
        .transform(derived.sailing_angle)
        .transform(derived.wind_ratio)
    )


def processed_layer(enriched: DataFrame) -> DataFrame:
    """The 57 columns of the processed layer in their fixed order; a missing one is an error."""
    return require_columns(enriched, PROCESSED_COLUMNS).select(*PROCESSED_COLUMNS)
