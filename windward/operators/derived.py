"""Measures of a segment and of a course, and the columns derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windward.functions import metrics, times
from windward.operators.ranks import Rank, with_ranks


def segment_times(
    df: DataFrame, date: str = "race_date", start_clock: str = "segment_start_clock",
    end_clock: str = "segment_end_clock",
) -> DataFrame:
    """Start, end (after the midnight fix), mid time and duration of each segment.

    Duration and mid-segment seconds come straight from the clock texts, so a
    job that needs only those never builds the timestamps.
    """
    day = F.col(date).cast("date")
    df = df.withColumns({
        "_start_us": times.clock_micros(F.col(start_clock)),
        "_end_us": times.clock_micros(F.col(end_clock)),
    })
    begin, finish = F.col("_start_us"), F.col("_end_us")
    df = df.withColumns({
        "race_year": F.year(day),
        "race_month": F.month(day),
        "race_day": F.dayofmonth(day),
        "segment_date": day,
        "segment_start": times.at_clock(day, begin),
        "segment_end": times.at_clock(day, finish + times.rollover(begin, finish)),
        "_took_us": times.duration_us(begin, finish),
    })
    took = F.col("_took_us")
    return df.withColumns({
        "segment_time_s": took / 1e6,
        "mid_seconds": times.mid_seconds(begin, took),
        "segment_mid_clock": times.mid_clock(F.col("segment_start"), took),
    }).drop("_start_us", "_end_us", "_took_us")


def segment_speeds(df: DataFrame) -> DataFrame:
    seconds = F.col("segment_time_s")
    return df.withColumns({
        "segment_speed_kn": metrics.knots(F.col("segment_dist_m"), seconds),
        "segment_vmc_kn": metrics.knots(F.col("segment_length_m"), seconds),
    })


def course_speeds(df: DataFrame) -> DataFrame:
    seconds = F.col("total_time_s")
    return df.withColumns({
        "course_vmc_kn": metrics.knots(F.col("total_length_m"), seconds),
        "course_speed_kn": metrics.knots(F.col("total_dist_m"), seconds),
    })


def distance_diffs(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "course_diff_m": metrics.distance_diff(F.col("total_dist_m"), F.col("total_length_m")),
        "segment_diff_m": metrics.distance_diff(F.col("segment_dist_m"), F.col("segment_length_m")),
    })


def efficiencies(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "segment_efficiency_pct": metrics.segment_efficiency(
            F.col("segment_length_m"), F.col("segment_dist_m")),
        "total_efficiency_pct": metrics.course_efficiency(
            F.col("total_length_m"), F.col("total_dist_m")),
    })


def sailing_angle(df: DataFrame, classes=None) -> DataFrame:
    """Point of sail from the race site's wind direction, never the weather service's."""
    return df.withColumn(
        "point_of_sail", metrics.point_of_sail(F.col("wind_dir_site"), F.col("heading_deg"), classes)
    )


def wind_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "speed_wind_ratio",
        metrics.speed_wind_ratio(F.col("segment_speed_kn"), F.col("wind_speed_kn")),
    )


SEGMENT_KEY = ["race_id", "segment_no"]


def segment_ranks(df: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Rank by time spent on the segment, and by the moment the segment is finished."""
    group = group or SEGMENT_KEY
    finished = df.withColumn("_finish_us", times.micros(F.col("segment_end")))
    return with_ranks(
        finished,
        Rank("rank_segment", group, "segment_time_s"),
        Rank("rank_segment_end", group, "_finish_us"),
    ).drop("_finish_us")


def rank_segment(df: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Only the rank by time spent on the segment."""
    return with_ranks(df, Rank("rank_segment", group or SEGMENT_KEY, "segment_time_s"))
