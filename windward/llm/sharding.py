"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windward.operators.lookup import lookup_join
from windward.session import stage

ROWS_PER_BUCKET = 2_000
STRETCH = 4096


def before_each(counts: DataFrame, by: list[str], order: str, n: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``n`` over smaller ``order`` (whole numbers), within ``by``.

    Two levels: windows over stretches of ``STRETCH`` values, and over the
    stretches' sums, so no window holds all values of a long series.
    """
    cut = counts.withColumn("_k", F.expr(f"{order} div {STRETCH}"))
    inner = Window.partitionBy(*by, "_k").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*by).orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(*by, "_k").agg(F.sum(n).alias("_sum")).withColumn("_base", F.coalesce(F.sum("_sum").over(outer), F.lit(0)))
    inside = cut.withColumn("_in", F.coalesce(F.sum(n).over(inner), F.lit(0)))
    return lookup_join(inside, sums.drop("_sum"), [*by, "_k"]).withColumn(out, F.col("_base") + F.col("_in")).drop("_k", "_base", "_in")


def interleaved_position(rows: DataFrame, stratum: str, order: list[Column], seed: int = 42) -> DataFrame:
    """Adds ``position`` (0 ...) and ``total``: rows of every stratum spread evenly over one sequence.

    Within a stratum rows are shuffled by a seeded hash and ranked; row r of n
    stands at (r - 1 + phase) / n, and all rows are sorted by that fraction. Neither sort
    sees a whole stratum: the shuffle key is cut into buckets of some
    ``ROWS_PER_BUCKET`` rows, bucket counts give what lies before, and the window
    ranks inside a bucket only. The fractions are even by construction and are
    cut the same way. ``order`` must tell rows apart; rows equal in it are
    interchangeable. A null stratum is a stratum of its own.
    """
    rows = rows.withColumn("_u", F.xxhash64(F.lit(seed), *order))
    total = rows.count()
    buckets = max(1, total // ROWS_PER_BUCKET)
    keyed = rows.withColumns({"_s": F.coalesce(F.concat(F.lit("s"), F.col(stratum).cast("string")), F.lit("null")),
                              "_b": F.pmod(F.shiftrightunsigned("_u", 3), F.lit(buckets))})
    counts = keyed.groupBy("_s", "_b").agg(F.count("*").alias("_n"))
    sizes = counts.groupBy("_s").agg(F.sum("_n").alias("_size"))
    offsets = lookup_join(before_each(counts, ["_s"], "_b", "_n", "_before"), sizes, ["_s"]).drop("_n")
    inside = Window.partitionBy("_s", "_b").orderBy("_u", *order)
    ranked = lookup_join(keyed.withColumn("_r", F.row_number().over(inside)), offsets, ["_s", "_b"])
    # A phase of its own keeps strata of equal size from stepping together, and spreads strata of one row.
    phase = F.pmod(F.xxhash64(F.lit(seed), F.col("_s")), F.lit(1 << 20)) / (1 << 20)
    ranked = ranked.withColumn("_f", (F.col("_before") + F.col("_r") - 1 + phase) / F.col("_size")).drop("_b", "_r", "_before", "_size")
    placed = stage(ranked.withColumn("_fb", F.least(F.floor(F.col("_f") * buckets), F.lit(buckets - 1))), "interleave")
    before = before_each(placed.groupBy("_fb").agg(F.count("*").alias("_n")), [], "_fb", "_n", "_before")
    at = Window.partitionBy("_fb").orderBy("_f", "_s", "_u", *order)
    out = lookup_join(placed.withColumn("_r", F.row_number().over(at)), before.drop("_n"), ["_fb"])
    return out.withColumns({"position": F.col("_before") + F.col("_r") - 1, "total": F.lit(total).cast("long")}).drop(
        "_u", "_s", "_f", "_fb", "_before", "_r")


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text", stratum: str = "source") -> DataFrame:
    """Deal documents into ``shards`` shards, each with the mixture of sources of the whole.

    Law ``rows``: shard sizes differ by at most one row. In any shard the rows of a
    source differ from its share by one, plus its share of what the other sources
    round by (less than one row each). Only id, source, size and
    checksum are shuffled, never texts. Null text: size 1, checksum 0. Null ids and
    sources are values like others; repeated rows are dealt as rows of their own.
    An empty table gives an empty result. Columns other than the three are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(stratum).cast("string").alias("source"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    rows = stage(rows, "shard-rows")
    order = [F.col(c) for c in ("doc_id", "text_crc32", "size")]
    placed = interleaved_position(rows, "source", order, seed)
    shard = F.expr(f"position * {shards} div total")
    first = F.expr(f"((position * {shards} div total) * total + {shards - 1}) div {shards}")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
        (F.col("position") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source")
