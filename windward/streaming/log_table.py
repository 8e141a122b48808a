"""A table that grows by batches, one folder per batch.

A batch that is written again replaces its own folder, so a retried batch
changes nothing, and no batch ever rewrites what earlier ones wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windward.operators.upsert import keep_last
from windward.sources.tables import read_table

BATCH = "batch_id"


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """All batches, or those before a batch; an absent table reads as empty."""
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    try:
        df = read_table(spark, path, full, basePath=path)
    except FileNotFoundError:
        return spark.createDataFrame([], full)
    return df if before is None else df.where(F.col(BATCH) < before)


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: list[str]
) -> DataFrame:
    """The current state: per key the row of the last batch, and in it the last by ``order``."""
    rows = read_batches(spark, path, schema)
    return keep_last(rows, keys, [F.col(BATCH), *[F.col(c) for c in order]]).drop(BATCH)


def compact(
    spark: SparkSession, path: str, target: str, schema: T.StructType, keys: list[str], order: list[str]
) -> None:
    """The current state as the first batch of a new table at ``target``."""
    write_batch(read_latest(spark, path, schema, keys, order), target, 0)
