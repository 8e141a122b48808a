"""Athlete profile: sex and age class, extracted first and completed after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windward.functions import text
from windward.operators.lookup import lookup_join


def extract_profile(df: DataFrame, course: str = "course", whole_words: bool = False) -> DataFrame:
    """Sex and age class from the course text, then the course without them."""
    c = F.col(course)
    return df.withColumns({
        "sex": text.extract_sex(c, whole_words),
        "age_class": text.age_class(c),
        course: text.clean_course(c),
    })


def fill_from_key(
    df: DataFrame, keys: list[str], value: str, order: Column, default: str | None = None
) -> DataFrame:
    """Fill a missing value from the last row (by ``order``) of the same key that has one.

    The last value per key is an aggregate that tasks combine before the
    shuffle; the rows then look it up. ``df`` is read twice: pass a table or a
    plan that is cheap to run again.
    """
    known = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys).agg(F.max_by(value, order).alias("_known"))
    )
    filled = F.coalesce(F.col(value), F.col("_known"), *([F.lit(default)] if default else []))
    return (
        lookup_join(df, known, keys, "left")
        .withColumn(value, filled)
        .select(*df.columns)
    )


def fill_sex(
    df: DataFrame, first_names: DataFrame, name: str = "athlete_name", sex: str = "sex"
) -> DataFrame:
    """Fill a missing sex from a (first_name, p_male, p_female) table.

    The larger probability wins; a tie or an unknown name stays null. Of several
    rows of one name the most certain one is taken, whole.
    """
    male, female = F.coalesce("p_male", F.lit(0.0)), F.coalesce("p_female", F.lit(0.0))
    likely = (
        first_names.groupBy(F.lower("first_name").alias("_first"))
        .agg(F.max(F.struct(F.greatest(male, female).alias("p"), F.abs(male - female).alias("by"), male.alias("m"), female.alias("f"))).alias("b"))
        .select("_first", F.when(F.col("b.m") > F.col("b.f"), "Men").when(F.col("b.f") > F.col("b.m"), "Women").alias("_likely"))
    )
    rows = df.withColumn("_first", F.lower(text.first_token(F.col(name))))
    return (
        lookup_join(rows, likely, ["_first"], "left")
        .withColumn(sex, F.coalesce(sex, "_likely"))
        .select(*df.columns)
    )


def attach_location(df: DataFrame, places: DataFrame, key: str = "event_name", order: Column | None = None) -> DataFrame:
    """Coordinates of each event from a (key, lat, lon) table; unknown events get nulls.

    Of several places of an event the last by ``order`` counts, at equal order or
    without one the largest (lat, lon): never the one that happens to be read first.
    """
    at = F.struct("lat", "lon")
    by = at if order is None else F.struct(order.alias("_order"), "lat", "lon")
    place = places.groupBy(key).agg(F.max_by(at, by).alias("_at")).select(key, "_at.lat", "_at.lon")
    return lookup_join(df, place, [key], "left").select(*df.columns, "lat", "lon")
