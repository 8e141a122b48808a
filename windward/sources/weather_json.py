"""Hourly weather payloads: JSON text to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windward.functions.metrics import ms_to_knots
from windward.schemas import WEATHER_HOURLY

PAYLOAD = (
    "data array<struct<temp:double, wind_speed:double, pressure:int, humidity:int, "
    "wind_deg:double, rain:struct<`1h`:double>>>"
)


def parse_payload(df: DataFrame, payload: str = "payload", absent_is_zero: bool = True) -> DataFrame:
    """One weather row per payload with data: its first entry.

    Temperature, wind speed and rain that are absent or null count as 0; with
    ``absent_is_zero`` off they stay null, since 0 degrees and 0 knots are real
    readings. Pressure, humidity and wind direction stay null either way.
    """
    zero = (lambda c: F.coalesce(c, F.lit(0.0))) if absent_is_zero else (lambda c: c)
    # Exploding the first entry drops payloads without one; a filter after the parse would parse twice.
    first = F.slice(F.from_json(F.col(payload), PAYLOAD)["data"], 1, 1)
    parsed = df.withColumn("_h", F.explode(F.filter(first, lambda h: h.isNotNull())))
    return parsed.withColumns({
        "temperature_c": F.round(zero(F.col("_h.temp")), 2),
        "wind_speed_kn": ms_to_knots(zero(F.col("_h.wind_speed"))),
        "pressure_hpa": F.col("_h.pressure"),
        "humidity_pct": F.col("_h.humidity"),
        "wind_dir_weather": F.col("_h.wind_deg"),
        "rain_mm": zero(F.col("_h.rain.1h")),
    }).drop("_h", payload)


def weather_rows(parsed: DataFrame, at: str = "ts") -> DataFrame:
    """Parsed payloads with city, latitude, longitude and hour as weather table rows."""
    t: Column = F.col(at)
    rows = parsed.withColumns({
        "day": F.dayofmonth(t), "month": F.month(t), "year": F.year(t),
        "time": F.date_format(t, "HH:mm:ss"),
    })
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in WEATHER_HOURLY])
