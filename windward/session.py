"""Session settings and the shared folder for state that must outlive an executor."""

from __future__ import annotations

import atexit
import functools
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


# Settings a running session can still take.
SQL_SETTINGS = {
    # Zone-less columns become instants in places; all answers are meant in UTC.
    "spark.sql.session.timeZone": "UTC",
    # HotSpot does not compile a method beyond 8,000 bytes of byte code. Wide projections
    # exceed that as one generated method and then run many times slower than operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # What a Python worker is handed at a time; texts are long, so rows are no measure.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # Splitting a skewed join partition is worth a shuffle that follows from it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


_OWN: list[str] = []  # the folder of local sessions without the setting
_FAULTS: dict[tuple[str, str], str] = {}  # by application and folder; none if it serves
_STAGED: list[tuple[str, str | None]] = []  # path, and the catalog's name if it has one


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set ``SQL_SETTINGS`` on the given session; they stay for its later queries."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "windward",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the operators count on.

    Adaptive execution coalesces small shuffle partitions and splits skewed join
    partitions at run time, so ``shuffle_partitions`` may be set generously
    (two to four times the cluster's cores).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return apply_settings(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` or that of ``setCheckpointDir``, else one in
    the warehouse, which the executors write tables to anyway.

    Only a session in one process without the setting gets a folder of its own, which goes with the process. On
    executors of their own a folder of a machine's file system is tried out, for it may be one that they cannot write
    or do not share.
    """
    one_process = spark.sparkContext.master.split("[")[0] == "local"
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path and one_process:
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="windward-"))
            atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
        return _OWN[0]
    at_hand = [p for p in (path, os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "windward-staged")) if p]
    for folder in at_hand:
        if one_process or not _fault(spark, folder):
            return folder
    told = "; ".join(f"{folder}: {_fault(spark, folder)}" for folder in at_hand)
    raise ValueError(f"set spark.checkpoint.dir to a folder all executors share ({told})")


def _fault(spark: SparkSession, path: str) -> str:
    """What keeps a folder from being the shared one, or ''; each application tries a machine's folder once."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _FAULTS:
        _FAULTS[key] = _tried(spark, path) if _on_machine(spark, path) else ""
    return _FAULTS[key]


def _tried(spark: SparkSession, path: str) -> str:
    """What went wrong when the executors wrote to a folder and the rows were read again."""
    try:
        lost = _lost_rows(spark, path)
    except (PySparkException, Py4JJavaError) as e:
        return f"the executors cannot write there, {str(e).strip().splitlines()[0]}"
    return f"{lost} of the rows they wrote were not found again" if lost else ""


def _on_machine(spark: SparkSession, path: str) -> bool:
    """Whether a path is on the file system of a machine, as mounted shares are too."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


def _lost_rows(spark: SparkSession, path: str) -> int:
    """How many of some rows written by tasks on all cores cannot be read again."""
    n, probe = 4 * spark.sparkContext.defaultParallelism, os.path.join(path, f"probe-{uuid.uuid4().hex}")
    try:
        spark.range(0, n, 1, n).write.parquet(probe)
        return n - spark.read.schema("id long").parquet(probe).count()
    finally:
        delete_staged(spark, [(probe, None)])


def run_dir(spark: SparkSession, label: str) -> str:
    """A new sub-folder name of the shared folder, never used before."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write an intermediate table to the shared folder now and go on from there.

    Unlike a cache it survives the loss of an executor. ``compression``: the codec, else the session's.
    """
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.parquet(path, compression=compression)
    note_staged(path)
    return spark.read.schema(df.schema).parquet(path)


def note_staged(path: str, table: str | None = None) -> None:
    """Count a path of the shared folder, and a table of the catalog on it, among the intermediate ones."""
    _STAGED.append((path, table))


def staged_so_far() -> int:
    """How much is staged now; what comes later is what ``settle`` and ``drop_staged`` delete ``since`` then."""
    return len(_STAGED)


def settle(df: DataFrame, label: str, since: int, compression: str | None = None) -> DataFrame:
    """``stage``, and delete the intermediate tables that led to it: those staged since the given moment."""
    out = stage(df, label, compression)
    last = _STAGED.pop()
    drop_staged(df.sparkSession, since)
    _STAGED.append(last)
    return out


def stage_parts(parts: Iterable[DataFrame], label: str, since: int, compression: str | None = None) -> DataFrame:
    """``settle`` for a table that comes in parts: one after the other, so that only one part's shuffle files are needed at a time."""
    before, tables = staged_so_far(), []
    for part in parts:
        tables.append(stage(part, label, compression))
        release_shuffles(part.sparkSession)
    out = functools.reduce(DataFrame.unionByName, tables)
    last = take_staged(before)
    drop_staged(out.sparkSession, since)
    _STAGED.extend(last)
    return out


def drop_staged(spark: SparkSession, since: int = 0) -> int:
    """Delete the intermediate tables this process has staged (since the given moment), when nothing reads them any more."""
    gone = _STAGED[since:]
    del _STAGED[since:]
    delete_staged(spark, gone)
    return len(gone)


def take_staged(since: int) -> list[tuple[str, str | None]]:
    """Hand over what was staged since the given moment; ``delete_staged`` is then the taker's to call."""
    taken = _STAGED[since:]
    del _STAGED[since:]
    return taken


def delete_staged(spark: SparkSession, gone: list[tuple[str, str | None]]) -> None:
    for path, table in gone:
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    if gone:
        release_shuffles(spark)


def release_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of plans that the driver no longer holds, once it has collected its garbage."""
    gc.collect()
    spark._jvm.System.gc()
