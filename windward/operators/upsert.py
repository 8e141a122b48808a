"""Appending and updating tables: column-aligned append, last write wins, new rows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windward.operators.lookup import lookup_join


def append_aligned(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Both tables one below the other, matched by column name; gaps are null."""
    return existing.unionByName(new, allowMissingColumns=True)


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row per key. Tasks cut to one row per key before the shuffle."""
    latest = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(latest)).where("_rn = 1").drop("_rn")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Existing and new rows with one row per key; a new row replaces an old one."""
    both = append_aligned(
        existing.withColumn("_batch", F.lit(0)), new.withColumn("_batch", F.lit(1))
    )
    return keep_last(both, keys, [F.col("_batch"), *order]).drop("_batch")


def not_yet_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key the output does not hold yet."""
    ids = known.select(key).where(F.col(key).isNotNull()).distinct()
    return lookup_join(df, ids, [key], "left_anti")
