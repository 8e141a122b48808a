"""Ranks inside a group, by one window where groups are small, counted by balanced ranges where one is hot."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windward.operators.lookup import lookup_join

MOST = 100_000  # rows of a group that a window may hold
MOST_CUTS = 4_096


@dataclass(frozen=True)
class Rank:
    """Rank ``name``: 1, 2, 2, 4 ... by a numeric column inside a group, smallest first."""

    name: str
    group: list[str]
    by: str
    most: float = MOST


def _named(group: list[str]) -> Column:
    """Whether no column of the group is null."""
    out = F.lit(True)
    for c in group:
        out = out & F.col(c).isNotNull()
    return out


def hot_groups(df: DataFrame, group: list[str], most: float) -> DataFrame:
    """(group, _rows) of the groups with more rows than a window may hold. Counted map-side."""
    return df.where(_named(group)).groupBy(*group).agg(F.count("*").alias("_rows")).where(F.col("_rows") > most)


def balanced_counts(df: DataFrame, r: Rank, rows: int) -> DataFrame:
    """(group, value, _n, _b): how often each value occurs in its group, and the range of the group it lies in.

    Ranges are cut at quantiles of each group (a sketch that tasks build and merge), so that each
    holds about half of ``r.most`` rows of the largest group, ``rows``, however its values are spread.
    A single value is never cut: it is one row here, however often it occurs.
    """
    k = min(MOST_CUTS, max(2, math.ceil(2 * rows / r.most)))
    shares = F.array(*[F.lit(i / k) for i in range(1, k)])
    valued = df.where(F.col(r.by).isNotNull() & _named(r.group))
    cuts = valued.groupBy(*r.group).agg(F.array_distinct(F.percentile_approx(r.by, shares, 20 * k)).alias("_cuts"))
    counts = lookup_join(valued.groupBy(*r.group, r.by).agg(F.count("*").alias("_n")), cuts, r.group)
    # Two steps of about the root of their number each: first which run of cuts, then which of the run.
    step = max(1, math.isqrt(k))
    every = F.transform(F.sequence(F.lit(1), F.size("_cuts"), F.lit(step)), lambda i: F.element_at("_cuts", i))
    below = lambda cuts: F.size(F.filter(cuts, lambda c: c < F.col(r.by)))
    counts = counts.withColumn("_runs", below(every))
    inside = below(F.slice("_cuts", (F.col("_runs") - 1) * step + 1, F.lit(step)))
    return counts.withColumn("_b", F.when(F.col("_runs") == 0, 0).otherwise((F.col("_runs") - 1) * step + inside)).drop("_cuts", "_runs")


def rank_table(df: DataFrame, r: Rank, rows: int) -> DataFrame:
    """The rank of each distinct (group, value), for groups of up to ``rows`` rows.

    A rank is one plus the rows with a smaller value. Only the counts of distinct values
    are ordered, range by range; a range starts from the sum of those before it.
    """
    counts = balanced_counts(df, r, rows)
    before = Window.partitionBy(*r.group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.groupBy(*r.group, "_b").agg(F.sum("_n").alias("_n"))
        .withColumn("_n", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn(r.by, F.lit(None).cast(df.schema[r.by].dataType))
    )
    # The range's offset sorts first (null), then its values.
    smaller = (
        Window.partitionBy(*r.group, "_b").orderBy(F.asc_nulls_first(r.by))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        counts.unionByName(offsets)
        .withColumn(r.name, (F.sum("_n").over(smaller) + 1).cast("int"))
        .where(F.col(r.by).isNotNull())
        .select(*r.group, r.by, r.name)
    )


def _small_ranks(df: DataFrame, ranks: list[Rank]) -> DataFrame:
    """Ranks by a window over each group. Rows without a whole group get none and are dealt apart, as they may be many."""
    for r in ranks:
        apart = F.when(~_named(r.group), F.pmod(F.monotonically_increasing_id(), F.lit(4096)))
        order = Window.partitionBy(*r.group, "_apart").orderBy(F.asc_nulls_last(r.by))
        df = df.withColumn("_apart", apart) if "_apart" not in df.columns else df
        df = df.withColumn(r.name, F.when(_named(r.group) & F.col(r.by).isNotNull(), F.rank().over(order)))
    return df.drop("_apart")


def with_ranks(df: DataFrame, *ranks: Rank) -> DataFrame:
    """All ranks, each computed from ``df`` itself.

    Rows with a null group or value get no rank. The groups' sizes are counted first. Where none is hot, ranks of one
    group share one shuffle and no window holds more than ``most`` rows; the rows of hot groups look
    their ranks up in a table of counted values instead. ``df`` is read for both, so it is best a written table.
    """
    out = df
    for group in dict.fromkeys(tuple(r.group) for r in ranks):
        ours = [r for r in ranks if tuple(r.group) == group]
        hot = hot_groups(df, list(group), min(r.most for r in ours))
        rows = hot.agg(F.max("_rows")).first()[0]
        if rows is None:
            out = _small_ranks(out, ours)
            continue
        names = hot.select(*group)
        crowded = lookup_join(out, names, list(group), "left_semi")
        for r in ours:
            table = rank_table(lookup_join(df, names, list(group), "left_semi"), r, rows)
            crowded = lookup_join(crowded, table, [*group, r.by])
        rest = _small_ranks(lookup_join(out, names, list(group), "left_anti"), ours)
        out = rest.unionByName(crowded.select(*rest.columns))
    return out.select(*df.columns, *[r.name for r in ranks])
