"""The registered queries of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windward.llm import alignment, bpe, decontaminate, jaccard, linededup, pii, quality, search, sharding, substrings, tokencounts, vectors, wordwindows
from windward.llm.common import documents, table
from windward.plans.registry import query


@query()
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of eight shards that all match the mixture of sources."""
    return sharding.shard_documents(documents(spark, sf_dir))


@query()
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words inside benchmark passages."""
    return decontaminate.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query()
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its spans of personal data."""
    return pii.personal_data(documents(spark, sf_dir))


@query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by language and encoded length, with the sums that answer every context limit."""
    return tokencounts.length_histogram(documents(spark, sf_dir))


@query()
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded again."""
    return bpe.round_trip(documents(spark, sf_dir))


@query()
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the blocks of lines that an earlier one has."""
    rows = linededup.dedup_lines(documents(spark, sf_dir))
    zero = F.lit(0).cast("long")
    return rows.select("doc_id", F.coalesce("_removed.lines", zero).alias("n_lines_removed"), F.coalesce("_removed.words", zero).alias("n_words_removed"),
                       "_removed.earlier", "text")


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its perplexity under the model of trusted text, and whether it is rejected."""
    return quality.judge(documents(spark, sf_dir), table(spark, sf_dir, "labels")).drop("text_key")


@query()
def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding with its links, its component and whether it is kept."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query()
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near duplicates and its number of links."""
    return jaccard.near_duplicates(documents(spark, sf_dir)).drop("text_key")


@query()
def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings of 200 bytes that occur more than once."""
    return substrings.remove_repeats(documents(spark, sf_dir))


@query()
def op13_word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows of 35 words that occur more than once."""
    return wordwindows.remove_windows(documents(spark, sf_dir))


@query()
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents of every benchmark item."""
    return search.ranked_search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query()
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the groups and links between its tokens of two kinds."""
    return alignment.align(documents(spark, sf_dir))
