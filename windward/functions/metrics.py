"""Speed, course and wind measures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KNOTS_PER_MS = 1.94384

# Upper angle between wind and course (degrees, exclusive; the last inclusive) -> point of sail.
# The class names are fixed values; the angles are this project's choice.
POINTS_OF_SAIL = [
    (45.0, "Vent debout"),
    (80.0, "Allures remontantes"),
    (100.0, "Reaching"),
    (160.0, "Allures portantes"),
    (180.0, "Vent arrière"),
]


def safe_divide(num: Column, den: Column) -> Column:
    """Null, not an error, when the divisor is zero."""
    return num / F.nullif(den.cast("double"), F.lit(0.0))


def knots(distance_m: Column, seconds: Column) -> Column:
    return safe_divide(distance_m, seconds) * F.lit(KNOTS_PER_MS)


def ms_to_knots(c: Column) -> Column:
    return F.round(c * F.lit(KNOTS_PER_MS), 2)


def wind_angle(wind_deg: Column, heading_deg: Column) -> Column:
    """Angle between wind and course, 0 (head wind) to 180 (dead downwind)."""
    return F.abs(F.pmod(wind_deg - heading_deg + 540, F.lit(360)) - 180)


def point_of_sail(wind_deg: Column, heading_deg: Column, classes=None) -> Column:
    classes = classes or POINTS_OF_SAIL
    angle = wind_angle(wind_deg, heading_deg)
    out = F.when(angle < classes[0][0], classes[0][1])
    for hi, label in classes[1:-1]:
        out = out.when(angle < hi, label)
    return out.when(angle <= classes[-1][0], classes[-1][1])


def distance_diff(real_m: Column, planned_m: Column) -> Column:
    return real_m - planned_m


def speed_wind_ratio(speed_kn: Column, wind_kn: Column) -> Column:
    return safe_divide(speed_kn, wind_kn)


def segment_efficiency(planned_m: Column, real_m: Column) -> Column:
    """Planned over sailed distance, in percent."""
    return safe_divide(planned_m, real_m) * 100


def course_efficiency(planned_m: Column, real_m: Column) -> Column:
    """Sailed over planned distance, in percent: the inverse direction of the segment's."""
    return safe_divide(real_m, planned_m) * 100


def left_edge(c: Column, width: int) -> Column:
    """Left edge of the left-closed bin a value falls in."""
    return (F.floor(c / width) * width).cast("int")
