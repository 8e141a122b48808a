"""Binned speed and VMC distributions by wind bin and point of sail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windward.functions.metrics import left_edge

WIND_BIN_KN = 2
MIN_WIND_KN = 6.0
GROUP = ["wind_bin", "point_of_sail"]


def with_wind_bin(
    df: DataFrame, wind: str = "wind_speed_kn", width: int = WIND_BIN_KN, strict_edges: bool = False
) -> DataFrame:
    """Left edge of the wind bin.

    Edges run from 0 in steps of ``width`` up to the first one at or above the
    maximum. With ``strict_edges`` a maximum that lies on the last edge falls
    in no bin, as in left-closed bins that end there; by default it is kept.
    """
    bin_ = F.when(F.col(wind) >= 0, left_edge(F.col(wind), width))
    if strict_edges:
        top = df.agg(F.max(wind)).scalar()
        bin_ = F.when(F.col(wind) < F.ceil(top / width) * width, bin_)
    return df.withColumn("wind_bin", bin_)


def sailing_rows(df: DataFrame, min_wind: float = MIN_WIND_KN, strict_edges: bool = False) -> DataFrame:
    """Complete rows with enough wind, with their wind bin."""
    need = ["segment_vmc_kn", "wind_speed_kn", "segment_speed_kn", "point_of_sail"]
    windy = df.na.drop(subset=need).where(F.col("wind_speed_kn") >= min_wind)
    return with_wind_bin(windy, strict_edges=strict_edges).where(F.col("wind_bin").isNotNull())


def _binned(df: DataFrame, bin_: Column, name: str) -> DataFrame:
    """Count and maximum speed per group and bin, in one pass, and with them the group's maximum speed.

    Groups without a positive speed are not drawn. The second step works on bins only.
    """
    bins = df.groupBy(*GROUP, bin_.alias(name)).agg(F.count("*").alias("n"), F.max("segment_speed_kn").alias("_max"))
    return bins.withColumn("_vmax", F.max("_max").over(Window.partitionBy(*GROUP))).where("_vmax > 0")


def speed_histogram(df: DataFrame, width: int = 1) -> DataFrame:
    """Segments per group and speed bin, for the groups that are drawn."""
    return _binned(df, left_edge(F.col("segment_speed_kn"), width), "speed_lo").drop("_max", "_vmax")


def spread_bins(spans: DataFrame, first: str, last: str, name: str, keep: list[str]) -> DataFrame:
    """One row per whole number ``first`` .. ``last`` - 1 of each span, as ``name``, with the columns ``keep``.

    In two levels: a span is cut into about as many blocks as a block has bins, the blocks are dealt to all
    tasks, and each then gives its bins. No row ever holds more than the root of a span's length.
    """
    tasks = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.col(last) - F.col(first)))).cast("bigint")
    blocks = spans.where(F.col(last) > F.col(first)).withColumn("_size", size)
    blocks = blocks.select(*keep, last, "_size", F.explode(F.sequence(F.col(first), F.col(last) - 1, F.col("_size"))).alias("_block"))
    end = F.least(F.col("_block") + F.col("_size"), F.col(last)) - 1
    dealt = blocks.repartition(tasks, "_block", *keep)
    return dealt.select(*keep, F.explode(F.sequence("_block", end)).alias(name))


def vmc_curve(df: DataFrame) -> DataFrame:
    """Segments per group and 1-knot VMC bin, empty bins included.

    Bins run from 0 to the group's maximum *speed*; VMC outside is left out. Each
    bin in use also fills the gap up to the next one; long gaps are spread over all tasks.
    """
    used = _binned(df, F.floor("segment_vmc_kn").cast("bigint"), "vmc_lo")
    top = F.ceil("_vmax").cast("bigint")
    edge = used.groupBy(*GROUP).agg(F.max(top).alias("top")).select(*GROUP, F.lit(0).cast("bigint").alias("vmc_lo"), F.lit(0).alias("n"), "top")
    inside = used.select(*GROUP, "vmc_lo", "n", top.alias("top")).where("vmc_lo >= 0 and vmc_lo < top").unionByName(edge)
    starts = inside.groupBy(*GROUP, "vmc_lo", "top").agg(F.sum("n").alias("n"))
    after = F.lead("vmc_lo").over(Window.partitionBy(*GROUP).orderBy("vmc_lo"))
    spans = starts.withColumn("_to", F.coalesce(after, F.col("top"))).withColumnRenamed("vmc_lo", "_lo")
    return spread_bins(spans, "_lo", "_to", "vmc_lo", [*GROUP, "n", "_lo"]).select(
        *GROUP, F.col("vmc_lo").cast("int").alias("vmc_lo"), (F.col("vmc_lo") + 0.5).alias("vmc_mid"),
        F.when(F.col("vmc_lo") == F.col("_lo"), F.col("n")).otherwise(0).cast("bigint").alias("n"),
    )
