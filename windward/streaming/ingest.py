"""Incremental jobs: new races only, and weather where the last write wins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windward.operators.lookup import lookup_join
from windward.operators.upsert import keep_last
from windward.schemas import RACE_COLUMNS
from windward.session import stage
from windward.sources import race_xml
from windward.sources.tables import typed_segments, upsert_partitions
from windward.streaming.ledger import not_taken, write_keys
from windward.streaming.log_table import read_batches, write_batch


def _run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str, fmt: str = "parquet",
    max_files: int | None = None, **options: str,
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).options(**options).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def document_stream(spark: SparkSession, folder: str, pattern: str = "*.xml", max_files: int | None = None) -> DataFrame:
    """Landed files as a stream of whole documents: (path, landed, xml)."""
    schema = T.StructType([T.StructField("value", T.StringType())])
    files = file_stream(spark, folder, schema, pattern, "text", max_files, wholetext="true")
    return files.select(F.col("_metadata.file_path").alias("path"),
                        F.col("_metadata.file_modification_time").alias("landed"), F.col("value").alias("xml"))


def ingest_new(
    stream: DataFrame, table: str, checkpoint: str, key: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    order: list[Column] | None = None,
) -> None:
    """Process what has landed since the last run, skipping races the table already holds.

    Of a race that landed several times since then the last document by ``order``
    counts (by default by all its columns); rows without a key all stay. A ledger beside the table,
    one folder per batch, holds the keys taken; a batch is compared with earlier
    ones only, so a retried batch does not skip its own rows. Known races
    are removed before ``transform`` does its work.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        kept = _fresh(batch, table, key, batch_id, order)
        write_batch(transform(kept), table, batch_id)
        write_keys(kept, f"{table}_keys", batch_id, key)

    _run(stream, checkpoint, each)


def _fresh(batch: DataFrame, table: str, key: str, batch_id: int, order: list[Column] | None) -> DataFrame:
    """Of each key the ledger does not hold yet the last row, and all rows without a key; written, as several steps read it."""
    fresh, _ = not_taken(batch, f"{table}_keys", key, batch_id)
    last = order or [F.struct(*[c for c in batch.columns if c != key])] if len(batch.columns) > 1 else [F.lit(0)]
    return stage(keep_last(fresh.where(F.col(key).isNotNull()), [key], last).unionByName(fresh.where(F.col(key).isNull())), "fresh")


def race_id_of(path: Column) -> Column:
    """A race's id from the name of its file: the name without folder and ending."""
    return F.try_url_decode(F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1))


def one_landing(documents: DataFrame, delay: str) -> DataFrame:
    """Of the landings of a race within ``delay`` of event time one. The state forgets older ones, and drops landings behind the watermark."""
    return documents.withWatermark("landed", delay).dropDuplicatesWithinWatermark(["race_id"])


def ingest_races(
    documents: DataFrame, table: str, checkpoint: str, about: DataFrame | None = None, zone: str = "UTC",
    delay: str | None = None,
) -> None:
    """The job from landed race documents (path, landed, xml) to typed segments, each race once.

    Of a race the document that landed last since the last run counts. ``about`` has race columns by race_id; a race it
    does not list is rejected as 'no page'. What gives no rows goes to ``{table}_rejects`` (race_id, path, landed,
    reason) and may land again. ``{table}_runs`` has the run report of each batch, counted while its documents are read. With ``delay``, repeated landings within it are dropped by streaming state, and
    ``late_landings`` lists what came later than that.
    """
    races = documents.select(race_id_of(F.col("path")).alias("race_id"), "path", "landed", "xml")
    if delay:
        noted = races.select("race_id", "path", "landed")
        _run(noted, f"{checkpoint}_landings", lambda batch, batch_id: write_batch(batch, f"{table}_landings", batch_id))
        races = one_landing(races, delay)

    def each(batch: DataFrame, batch_id: int) -> None:
        kept = _fresh(batch, table, "race_id", batch_id, [F.col("landed"), F.col("path")])
        listed = "_listed"
        if about is not None:
            facts = about.select("race_id", *[c for c in RACE_COLUMNS if c in about.columns and c != "race_id"], F.lit(True).alias(listed))
            kept = lookup_join(kept, facts, ["race_id"])
        keep = [c for c in kept.columns if c != "xml"]
        scanned = race_xml.scan_documents(kept, keep=keep)
        if about is not None:
            scanned = scanned.withColumn("reason", F.when(F.col(listed).isNull(), "no page").otherwise(F.col("reason")))
        seen = Observation("ingest")
        good, total = F.count_if(F.col("reason").isNull()), F.count(F.lit(1))
        scanned = stage(scanned.observe(seen, total.alias("total"), good.alias("succeeded"), (total - good).alias("failed")), "scanned")
        write_batch(typed_segments(race_xml.segment_rows(scanned, zone)), table, batch_id)
        write_batch(scanned.where("reason is not null").select("race_id", "path", "landed", "reason"), f"{table}_rejects", batch_id)
        write_keys(scanned.where("reason is null"), f"{table}_keys", batch_id, "race_id")
        report = [(int(seen.get["total"]), int(seen.get["succeeded"]), int(seen.get["failed"]))]
        write_batch(batch.sparkSession.createDataFrame(report, "total long, succeeded long, failed long"), f"{table}_runs", batch_id)

    _run(races, checkpoint, each)


def late_landings(spark: SparkSession, table: str) -> DataFrame:
    """(race_id, path, landed) of landings no run has looked at: they came behind the watermark."""
    text, moment = T.StringType(), T.TimestampType()
    noted = read_batches(spark, f"{table}_landings", T.StructType([T.StructField("race_id", text), T.StructField("path", text), T.StructField("landed", moment)]))
    seen = [read_batches(spark, f"{table}_{name}", T.StructType([T.StructField("race_id", text)])).select("race_id") for name in ("keys", "rejects")]
    return lookup_join(noted.drop("batch_id"), seen[0].union(seen[1]).distinct(), ["race_id"], "left_anti")


def upsert_stream(stream: DataFrame, table: str, checkpoint: str) -> None:
    """Land each batch beside the earlier ones; ``read_latest`` gives the current rows."""
    _run(stream, checkpoint, lambda batch, batch_id: write_batch(batch, table, batch_id))


def upsert_in_place(stream: DataFrame, table: str, checkpoint: str, keys: list[str], order: list[str], partition_by: list[str]) -> None:
    """Bring each batch into a partitioned table at once: its partitions are rewritten, all others stay as they are."""
    _run(stream, checkpoint, lambda batch, _: upsert_partitions(batch, table, keys, [F.col(c) for c in order], partition_by))
