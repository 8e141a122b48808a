"""Reading and writing typed tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windward.functions import text, times
from windward.operators.columns import rename_columns
from windward.operators.upsert import keep_last, upsert
from windward.schemas import DOUBLE_COLUMNS, INT_COLUMNS, SHEET_HEADERS
from windward.session import stage


WIND_HEADER = "Orientation vent site"
# Whole texts that are a day, alone or with a clock time.
_CLOCK = r"(?:[ T][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:[.][0-9]+)?)?Z?)?$"
DAY_FORMS = [(r"^([0-9]{4}-[0-9]{2}-[0-9]{2})" + _CLOCK, "yyyy-MM-dd"), (r"^([0-9]{2}/[0-9]{2}/[0-9]{4})" + _CLOCK, "dd/MM/yyyy")]


class EmptyResult(ValueError):
    """A step refused to write a table without rows."""


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """A table with a fixed schema. A missing path is a FileNotFoundError, raised before any job."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no table at {path}") from e
        raise


def read_sheet_export(spark: SparkSession, path: str, wind_header: str = WIND_HEADER) -> DataFrame:
    """A spreadsheet saved as CSV: its headers become our column names, all text.

    The header of the wind direction varies between sheets, so it is an argument.
    """
    df = read_table(spark, path, fmt="csv", header="true", multiLine="true", escape='"')
    return rename_columns(df, SHEET_HEADERS | {wind_header: "wind_dir_site"})


def typed_segments(bronze: DataFrame, zone: str | None = None) -> DataFrame:
    """Cast the landed texts; text that is no number, or not wholly a day, becomes null.
    ``unreadable_days`` counts the latter.

    With ``zone`` the segment clocks are epoch seconds still to be turned into
    clock times of that zone.
    """
    casts = {c: text.decimal_comma(F.col(c), strict=False) for c in DOUBLE_COLUMNS if c in bronze.columns}
    casts |= {
        c: text.decimal_comma(F.col(c), strict=False).cast("int") for c in INT_COLUMNS if c in bronze.columns
    }
    if "race_date" in bronze.columns:
        day = F.col("race_date").cast("string")
        casts["race_date"] = F.coalesce(
            *[F.when(day.rlike(shape), F.try_to_date(F.regexp_extract(day, shape, 1), form)) for shape, form in DAY_FORMS],
        )
    if zone:
        for c in ("segment_start_clock", "segment_end_clock"):
            casts[c] = times.epoch_clock(F.col(c), zone)
    return bronze.withColumns(casts)


def unreadable_days(bronze: DataFrame, column: str = "race_date") -> DataFrame:
    """One row (value, n) per landed text that is no day."""
    day = F.col(column).cast("string")
    read = typed_segments(bronze.select(F.col(column).alias("race_date"), day.alias("value")))
    return read.where("race_date is null and value is not null").groupBy("value").agg(F.count("*").alias("n"))


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> int:
    """Write Parquet and return the number of rows, or raise EmptyResult and leave the target alone when there is none.

    The plan runs once: into the shared folder, where its rows are counted on the way, and from there to the target.
    """
    seen = Observation("write")
    staged = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), "table")
    rows = int(seen.get["rows"])
    if not rows:
        raise EmptyResult(f"nothing to write to {path}")
    writer = staged.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return rows


def upsert_partitions(new: DataFrame, path: str, keys: list[str], order: list[Column], partition_by: list[str]) -> None:
    """Bring rows into a partitioned Parquet table; the last row per key stays, a new one replaces an old one.

    Only the partitions that ``new`` touches are read and replaced: their merged rows are written to the
    shared folder, then beside the table, and change places with the old ones when all are written. A repeated
    call changes nothing. ``partition_by`` is part of ``keys``, so no key changes its partition; their
    values may be null. An absent table is created; without new rows nothing happens.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError(f"{partition_by} must be among the keys {keys}")
    spark = new.sparkSession
    fresh = stage(keep_last(new, keys, order), "upsert-new")
    if fresh.isEmpty():
        return
    try:
        old = read_table(spark, path, fresh.schema)
    except FileNotFoundError:
        merged = fresh
    else:
        # A written table's size is known: Spark broadcasts the few partition values and prunes the scan by them.
        touched = stage(fresh.select(*partition_by).distinct(), "upsert-partitions")
        none = " or ".join(f"`{c}` is null" for c in partition_by)
        whole = old.join(touched, partition_by, "left_semi")
        null_safe = [old[c].eqNullSafe(touched[c]) for c in partition_by]
        nameless = old.where(none).join(touched.where(none), null_safe, "left_semi")
        merged = stage(upsert(whole.unionByName(nameless), fresh, keys, order), "upsert-merged")
    spread = merged.hint("rebalance", *partition_by)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def write_run(tables: dict[str, DataFrame], root: str, run_ts: str) -> None:
    """The tables of one run, each under its own name and a ``run_ts`` partition.

    The partition folder is replaced, so a repeated write of a run changes nothing.
    """
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}/run_ts={run_ts}")
