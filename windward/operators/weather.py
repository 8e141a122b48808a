"""Which hours of weather each place needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windward.functions import text

FIRST_HOUR, LAST_HOUR = 8, 20


def parse_coordinates(df: DataFrame, column: str = "event_location") -> DataFrame:
    c = F.col(column)
    return df.withColumns({"lat": text.coordinate(c, 0), "lon": text.coordinate(c, 1)})


def location_ranges(
    df: DataFrame, start: str = "segment_start", end: str = "segment_end", by: list[str] | None = None
) -> DataFrame:
    """First and last day per place; ``by`` keeps, say, events at one place apart."""
    by = by or []
    return (
        df.na.drop(subset=["lat", "lon", start, end])
        .groupBy(*by, "lat", "lon")
        .agg(F.min(start).cast("date").alias("first_day"), F.max(end).cast("date").alias("last_day"))
        .withColumn("city", text.location_label(F.col("lat"), F.col("lon")))
    )


def hour_spine(ranges: DataFrame, first_hour: int = FIRST_HOUR, last_hour: int = LAST_HOUR) -> DataFrame:
    """One row per place, day and hour to be fetched."""
    return (
        ranges.withColumn("day", F.explode(F.sequence("first_day", "last_day")))
        .withColumn("hour", F.explode(F.sequence(F.lit(first_hour), F.lit(last_hour))))
    )


def occupied_intervals(
    df: DataFrame, start: str = "segment_start", end: str = "segment_end", by: list[str] | None = None
) -> DataFrame:
    """(lat, lon, first_time, last_time): the times at a place that segments cover, overlapping ones as one.

    Tasks cut the segments of a place to one interval per hour of start before the shuffle, so a window
    holds a place's hours, not its segments. An interval ends where the greatest end so far lies before the
    next start's hour; a segment that ends before it starts covers its start.
    """
    by = by or []
    place = [*by, "lat", "lon"]
    hourly = (
        df.na.drop(subset=["lat", "lon", start, end])
        .groupBy(*place, F.date_trunc("hour", start).alias("_hour"))
        .agg(F.min(start).alias("_from"), F.max(F.greatest(start, end)).alias("_to"))
    )
    earlier = Window.partitionBy(*place).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*place).orderBy("_hour")
    new = F.col("_reached").isNull() | (F.col("_reached") < F.col("_hour"))
    return (
        hourly.withColumn("_reached", F.max("_to").over(earlier))
        .withColumn("_island", F.sum(new.cast("int")).over(upto))
        .groupBy(*place, "_island").agg(F.min("_from").alias("first_time"), F.max("_to").alias("last_time"))
        .drop("_island").withColumn("city", text.location_label(F.col("lat"), F.col("lon")))
    )


def hour_islands(intervals: DataFrame, first_hour: int = FIRST_HOUR, last_hour: int = LAST_HOUR) -> DataFrame:
    """One row per place, day and hour to be fetched, only for hours inside ``occupied_intervals``."""
    first, last = F.date_trunc("hour", "first_time"), F.date_trunc("hour", "last_time")
    hours = intervals.withColumn("_hour", F.explode(F.sequence(first, last, F.expr("interval 1 hour"))))
    asked = hours.where(F.hour("_hour").between(first_hour, last_hour))
    kept = [c for c in intervals.columns if c not in ("first_time", "last_time")]
    return asked.select(*kept, F.col("_hour").cast("date").alias("day"), F.hour("_hour").alias("hour")).distinct()
