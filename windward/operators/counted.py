"""Row counts of the steps of a job, taken while the job runs and not by a run of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class StepCounts:
    """Counts rows after each step of a plan. The counts are there once an action has run the plan; of several, the first counts.

    A step that a later filter is pushed below would count too few, so Spark keeps filters above a counted step.
    """

    def __init__(self) -> None:
        self._steps: list[tuple[str, Observation]] = []

    def after(self, df: DataFrame, step: str) -> DataFrame:
        """The same rows, counted as those left after ``step``."""
        seen = Observation(step)
        self._steps.append((step, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def table(self, spark: SparkSession) -> DataFrame:
        """(no, step, rows, removed): one row per step; ``removed`` compares with the step before."""
        out, before = [], None
        for no, (step, seen) in enumerate(self._steps):
            rows = int(seen.get["rows"])
            out.append((no, step, rows, 0 if before is None else before - rows))
            before = rows
        return spark.createDataFrame(out, "no int, step string, rows long, removed long")


def counted(counts: StepCounts | None, df: DataFrame, step: str) -> DataFrame:
    """``df``, counted if anyone wants to know."""
    return df if counts is None else counts.after(df, step)
