"""From raw documents to encoded training text, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs. All but the last return the columns
of documents.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windward.llm import bpe, decontaminate, jaccard, linededup, quality
from windward.llm.common import documents, table
from windward.session import delete_staged, note_staged, stage, staged_so_far, take_staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_LEFT: list[tuple[str, str | None]] = []  # intermediate tables of the stage called last; its result reads them until it is written


def _delete_left(spark: SparkSession) -> None:
    delete_staged(spark, _LEFT)
    _LEFT.clear()


def tidy(step: Stage) -> Stage:
    """The stage, beginning with the deletion of what the one before has left in the shared folder.

    By then that one's result is written, unless ``docs`` is that result itself, not yet written; then all stays.
    """
    @functools.wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _LEFT and not any(path.split("://")[-1] in file for file in docs.inputFiles() for path, _ in _LEFT):
            _delete_left(spark)
        since = staged_so_far()
        out = step(spark, docs, sf_dir)
        _LEFT.extend(take_staged(since))
        return out

    return run



@tidy
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the language model of trusted text rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


@tidy
def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has go from the later one; n_chars follows the text."""
    out = linededup.dedup_lines(docs)
    changed = out.withColumn("n_chars", F.when(F.col("_removed").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast("long")) \
        if "n_chars" in docs.columns else out
    return changed.select(*docs.columns)


@tidy
def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with shingle similarity 0.8 or more, and what these connect, the first stays."""
    return jaccard.keep_one(docs)


@tidy
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


@tidy
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    return bpe.round_trip(docs, keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("lines", without_shared_lines),
    ("near_duplicates", one_of_each_class),
    ("benchmark", without_benchmark),
    ("encode", encoded),
]

#: The language model, the aligner and the tokenizer's merges have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. Of the tables written on the way only the last one's is left."""
    docs, before = documents(spark, sf_dir), []
    for name, step in STAGES:
        since = staged_so_far()
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        delete_staged(spark, before)
        before = take_staged(since)
    _delete_left(spark)
    note_staged(*before[0])
    return docs
