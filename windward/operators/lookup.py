"""Joining rows to a table with one row per key, also when one key holds most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``rows`` to ``lookup``, which holds at most one row per key.

    A lookup that proves small enough is broadcast by Spark, judged by its
    size. Otherwise both sides are shuffled, and a key with very many rows makes
    one oversized partition of ``rows``; adaptive execution splits it over as
    many tasks as its measured size asks for, each with that key's one lookup row.

    Splitting needs a shuffle of its own directly below each side of the join. A
    lookup aggregated by the same keys would bring its partitioning along instead,
    so the join also compares a hash of the keys. That costs one more shuffle of
    the lookup, which is already reduced to one row per key.
    """
    types = dict(rows.dtypes)
    lookup = lookup.withColumns({k: F.col(k).cast(types[k]) for k in keys})
    hashed = F.hash(*keys)
    joined = rows.withColumn("_key_hash", hashed).join(
        lookup.withColumn("_key_hash", hashed), [*keys, "_key_hash"], how
    )
    return joined.drop("_key_hash")
