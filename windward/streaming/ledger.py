"""The keys an incremental table has taken, one folder per batch, with a Bloom filter for each batch.

A filter is a table too: its rows are bitmaps of ``BITS`` bits, and a key's bits all lie in one of
them, its bucket. A lookup joins the keys asked for with the bitmaps of their buckets, and reads the
keys of only those batches that may hold one. What passes a filter is compared exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windward.operators.lookup import lookup_join
from windward.session import stage
from windward.streaming.log_table import BATCH, read_batches, write_batch

BITS = 32768  # of one bitmap of Spark's bitmap functions
PROBES = 4
BUCKETS = 1024  # up to some 3 million keys a batch are told apart well; more only pass the filter more often

_FILTER = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("bits", T.BinaryType())])


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(buckets)).cast("int")


def _places(key: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BITS)) for i in range(1, PROBES + 1)])


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1


def write_keys(keys: DataFrame, path: str, batch_id: int, key: str, buckets: int = BUCKETS) -> None:
    """Add the keys of a batch, and its filter. A batch that is written again replaces itself."""
    taken = stage(keys.select(key).where(F.col(key).isNotNull()).distinct(), "ledger-keys")
    write_batch(taken, path, batch_id)
    bits = taken.select(_bucket(F.col(key), buckets).alias("bucket"), F.explode(_places(F.col(key))).alias("place"))
    write_batch(bits.groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits")), f"{path}_filter", batch_id)


def _batches(df: DataFrame) -> set[int]:
    """The batch numbers of a table; there are as many as runs, not as keys."""
    return {r[0] for r in df.select(BATCH).distinct().collect()}


def not_taken(batch: DataFrame, path: str, key: str, batch_id: int, buckets: int = BUCKETS) -> tuple[DataFrame, Observation | None]:
    """The rows whose key no earlier batch has taken (rows without a key all stay), and an observation ``read`` of how
    many ledger rows were compared, or None if no filter let a key pass. A batch without a filter is always compared."""
    spark = batch.sparkSession
    ledger = read_batches(spark, path, T.StructType([batch.schema[key]]), before=batch_id)
    filters = read_batches(spark, f"{path}_filter", _FILTER, before=batch_id)
    asked = batch.select(key).where(F.col(key).isNotNull()).distinct().withColumns({"bucket": _bucket(F.col(key), buckets), "_places": _places(F.col(key))})
    passed = asked.join(filters, "bucket").where(F.forall("_places", lambda p: _is_set(F.col("bits"), p))).select(BATCH, key)
    passed = stage(passed, "ledger-passed")
    held = _batches(passed) | (_batches(ledger) - _batches(filters))
    if not held:
        return batch, None
    seen = Observation("ledger")
    read = ledger.where(F.col(BATCH).isin(*sorted(held))).observe(seen, F.count(F.lit(1)).alias("read"))
    known = lookup_join(read.select(key), batch.select(key).where(F.col(key).isNotNull()).distinct(), [key], "left_semi").distinct()
    return lookup_join(batch, known, [key], "left_anti"), seen
