"""Nearest-in-time join inside a partition key such as (location, date)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windward.operators.lookup import lookup_join

# With clocks to the microsecond a minute holds at most 6e7 distinct times, with
# clocks to the half second 120: the most a window can be given.
BUCKET_S = 60.0


def nearest_table(
    left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
    payload: list[str], order: list[str] | None = None, bucket: float = BUCKET_S,
) -> DataFrame:
    """One row per distinct (key, left time): the nearest right reading as ``_hit``.

    Windows never see raw rows. Both sides are first reduced to distinct
    (key, time) points, and a key's time line is cut into buckets; each bucket
    also gets the last reading before it and the first after it. A window
    therefore holds one bucket of distinct times, however hot the key is.
    """
    points = (
        left.select(*keys, F.col(left_time).cast("double").alias("_t"))
        .distinct()
        .withColumn("_b", F.floor(F.col("_t") / bucket))
    )
    # Readings at the same instant: the last one by ``order`` counts.
    readings = (
        right.select(
            *keys,
            F.col(right_time).cast("double").alias("_t"),
            F.struct(*payload).alias("_p"),
            F.struct(*(order or payload)).alias("_o"),
        )
        .where(F.col("_t").isNotNull())
        .groupBy(*keys, "_t")
        .agg(F.max_by("_p", "_o").alias("_p"))
        .select(
            *keys, F.floor(F.col("_t") / bucket).alias("_b"), "_t",
            F.struct("_t", "_p").alias("_r"),
        )
    )
    no_reading = F.lit(None).cast(readings.schema["_r"].dataType).alias("_r")

    # One row per key and bucket in use, small enough to scan along each key's time line.
    edges = (
        points.select(*keys, "_b", no_reading)
        .unionByName(readings.select(*keys, "_b", "_r"))
        .groupBy(*keys, "_b")
        .agg(
            F.min_by("_r", F.col("_r._t")).alias("_first"),
            F.max_by("_r", F.col("_r._t")).alias("_last"),
            F.bool_or(F.col("_r").isNull()).alias("_asked"),
        )
    )
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        edges.withColumn("_before", F.last("_last", ignorenulls=True).over(earlier))
        .withColumn("_after", F.last("_first", ignorenulls=True).over(later))
        .where("_asked")
        .select(*keys, "_b", F.explode(F.array("_before", "_after")).alias("_r"))
        .where(F.col("_r").isNotNull())
        .select(*keys, "_b", F.col("_r._t").alias("_t"), "_r")
    )

    line = (
        readings.unionByName(carried).withColumn("_left", F.lit(0))
        .unionByName(points.select(*keys, "_b", "_t", no_reading, F.lit(1).alias("_left")))
    )
    up = Window.partitionBy(*keys, "_b").orderBy("_t", "_left")
    down = Window.partitionBy(*keys, "_b").orderBy(F.desc("_t"), "_left")
    back, ahead = F.col("_back"), F.col("_ahead")
    nearer_back = ahead.isNull() | (F.col("_t") - back["_t"] <= ahead["_t"] - F.col("_t"))
    return (
        line.withColumn("_back", F.last("_r", ignorenulls=True).over(up))
        .withColumn("_ahead", F.last("_r", ignorenulls=True).over(down))
        .where("_left = 1")
        .select(*keys, "_t", F.when(back.isNotNull() & nearer_back, back).otherwise(ahead).alias("_hit"))
        .where(F.col("_hit").isNotNull())
    )


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_time: str,
    right_time: str,
    payload: list[str],
    order: list[str] | None = None,
    bucket: float = BUCKET_S,
    suffix: str = "_right",
    points: DataFrame | None = None,
    left_if_no_match: bool = False,
) -> DataFrame:
    """Give each left row the right row nearest in time with the same keys.

    Equal distances take the earlier reading, readings at the same instant the
    last by ``order`` (by default the payload itself); there is no tolerance. Left rows
    whose key has no reading, or with a null key or time, are dropped (see
    ``unmatched_groups``); with ``left_if_no_match`` all rows stay when no row
    at all found a reading. Times are numbers in one unit; ``bucket`` is in it too.

    ``points`` is a cheaper table with the same keys and times, for a left side
    that is itself the result of joins.
    """
    payload = [c for c in payload if c not in keys]
    hits = nearest_table(
        left if points is None else points, right, keys, left_time, right_time, payload, order, bucket
    )
    fields = [
        F.col(f"_hit._p.`{c}`").alias(c + suffix if c in left.columns else c) for c in payload
    ]
    rows = left.withColumn("_t", F.col(left_time).cast("double"))
    joined = lookup_join(rows, hits, [*keys, "_t"])
    found = F.col("_hit").isNotNull()
    if left_if_no_match:
        found = found | (hits.agg(F.count("*")).scalar() == 0)
    return joined.where(found).select(*left.columns, *fields)


def unmatched_groups(
    left: DataFrame, right: DataFrame, keys: list[str], left_time: str
) -> DataFrame:
    """Rows the nearest join drops, counted by key and reason."""
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    counted = left.groupBy(*keys).agg(
        F.count("*").alias("_rows"), F.count_if(F.col(left_time).isNull()).alias("_no_time")
    )
    known = right.select(*keys).na.drop().distinct().withColumn("_known", F.lit(True))
    no_reading = F.col("_known").isNull()
    return (
        counted.join(known, keys, "left")
        .select(
            *keys,
            F.when(no_key, "no key").when(no_reading, "no reading").otherwise("no time").alias("reason"),
            F.when(no_key | no_reading, F.col("_rows")).otherwise(F.col("_no_time")).alias("rows_dropped"),
        )
        .where("rows_dropped > 0")
    )
