"""Row filters and their counts. Every filter is a plain predicate Catalyst can push down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windward.functions.text import EXCLUDED_RUN_PATTERN


def keeps_course(course: Column, pattern: str = EXCLUDED_RUN_PATTERN) -> Column:
    """True unless the text matches; a missing text is kept."""
    return ~F.coalesce(course.rlike(f"(?i){pattern}"), F.lit(False))


def exclude_matching(df: DataFrame, column: str, pattern: str = EXCLUDED_RUN_PATTERN) -> DataFrame:
    return df.where(keeps_course(F.col(column), pattern))


def exclude_by_rule(
    df: DataFrame, rules: dict[str, str], event: str = "event_name", course: str = "course"
) -> DataFrame:
    """For each named event keep only the rows whose course matches its pattern.

    The rules are code, so they become one predicate: no join, no shuffle.
    A missing course of a named event does not match and goes.
    """
    keep = F.lit(True)
    for name, pattern in rules.items():
        matches = F.coalesce(F.col(course).rlike(f"(?i){pattern}"), F.lit(False))
        keep = keep & (~F.col(event).eqNullSafe(F.lit(name)) | matches)
    return df.where(keep)


def drop_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in the given columns, or in any column."""
    return df.na.drop(subset=columns)


def keep_members(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(values))


def keep_at_least(df: DataFrame, column: str, floor: float) -> DataFrame:
    return df.where(F.col(column) >= floor)


def filter_report(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before, kept and removed by a filter, in one pass."""
    kept = F.coalesce(keep, F.lit(False))
    return df.agg(
        F.count("*").alias("rows_before"),
        F.count_if(kept).alias("rows_kept"),
        F.count_if(~kept).alias("rows_removed"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values. Tasks dedupe before the shuffle."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def run_report(log: DataFrame, ok: Column) -> DataFrame:
    """Total, succeeded and failed races of an ingest log."""
    good = F.coalesce(ok, F.lit(False))
    return log.agg(
        F.count("*").alias("total"),
        F.count_if(good).alias("succeeded"),
        F.count_if(~good).alias("failed"),
    )
