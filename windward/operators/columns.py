"""Column selection, order and names. Only the plan changes; no data moves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop what is there of the listed columns."""
    return df.drop(*columns)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def rename_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    """Name all columns in order; a different count is an error."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def columns_first(df: DataFrame, first: list[str]) -> DataFrame:
    """The listed columns lead, created as null text where absent; the rest follow."""
    lead = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in first]
    return df.select(*lead, *[c for c in df.columns if c not in first])


def drop_suffixed(df: DataFrame, suffix: str) -> DataFrame:
    """Drop 'x<suffix>' wherever a column 'x' exists."""
    clash = [c for c in df.columns if c.endswith(suffix) and c[: -len(suffix)] in df.columns]
    return df.drop(*clash)
