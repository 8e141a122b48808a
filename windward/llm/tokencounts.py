"""Exact histograms of encoded lengths, and the answers their suffix sums give."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windward.llm.bpe import PIECE_BYTES, default_tokenizer, encoder
from windward.llm.common import pieces, text_of
from windward.llm.sharding import before_each
from windward.operators.lookup import lookup_join


def encoded_lengths(docs: DataFrame, tokenizer: str, text_col: str = "text", by: str = "lang") -> DataFrame:
    """(part, n_tokens, n_docs): documents by exact encoded length, counted in the task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, None)
        for batch in pieces(batches, "text", PIECE_BYTES):
            _, n = coder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(n, pa.int64())], ["part", "n_tokens"])

    rows = docs.select(F.col(by).cast("string").alias("part"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "part string, n_tokens long").groupBy("part", "n_tokens").agg(F.count("*").alias("n_docs"))


def length_histogram(docs: DataFrame, tokenizer: str | None = None, text_col: str = "text", by: str = "lang") -> DataFrame:
    """One row per group and encoded length, with sums over the lengths below and from there on.

    For a context limit of n_tokens: ``docs_from`` and ``tokens_from`` count documents at
    least that long, ``tokens_truncated`` is what is left when every document is cut
    at the limit, ``share`` the part of documents that are not longer. Null and empty
    texts have length 0, a null group is a group, repeated rows count each time, and
    an empty table gives no rows. Only histogram rows are shuffled.
    """
    hist = encoded_lengths(docs, tokenizer or default_tokenizer(), text_col, by)
    hist = hist.withColumns({"part": F.coalesce(F.concat(F.lit("="), "part"), F.lit("")), "tokens": F.col("n_tokens") * F.col("n_docs")})
    totals = hist.groupBy("part").agg(F.sum("n_docs").alias("all_docs"), F.sum("tokens").alias("all_tokens"))
    sums = before_each(before_each(hist, ["part"], "n_tokens", "n_docs", "docs_below"), ["part"], "n_tokens", "tokens", "tokens_below")
    out = lookup_join(sums, totals, ["part"])
    docs_from = F.col("all_docs") - F.col("docs_below")
    return out.select(
        F.when(F.col("part") != "", F.expr("substring(part, 2)")).alias(by), "n_tokens", "n_docs",
        docs_from.alias("docs_from"), (F.col("all_tokens") - F.col("tokens_below")).alias("tokens_from"),
        (F.col("tokens_below") + docs_from * F.col("n_tokens")).alias("tokens_truncated"),
        ((F.col("docs_below") + F.col("n_docs")) / F.col("all_docs")).alias("share"), "all_docs", "all_tokens")


def limit_report(histogram: DataFrame, limits: list[int], by: str = "lang") -> DataFrame:
    """Documents and tokens for any context limits: the next length at or above a limit answers it."""
    each = histogram.select(by, "n_tokens", "docs_from", "tokens_from", "all_docs", "all_tokens",
                            F.explode(F.array(*[F.lit(x).cast("long") for x in limits])).alias("limit"))
    key = [by, "limit", "all_docs", "all_tokens"]
    at = each.groupBy(*key).agg(F.min_by(F.struct("docs_from", "tokens_from"), F.when(F.col("n_tokens") >= F.col("limit"), F.col("n_tokens"))).alias("s"))
    longer, cut = F.coalesce("s.docs_from", F.lit(0)), F.coalesce("s.tokens_from", F.lit(0))
    return at.select(by, "limit", longer.cast("long").alias("docs_from"),
                     (F.col("all_tokens") - cut + longer * F.col("limit")).cast("long").alias("tokens_truncated"))


def quantiles(histogram: DataFrame, shares: list[float], by: str = "lang") -> DataFrame:
    """The least length that at least the given share of documents does not exceed."""
    each = histogram.select(by, "n_tokens", "share", F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("q"))
    return each.filter(F.col("share") >= F.col("q")).groupBy(by, "q").agg(F.min("n_tokens").alias("n_tokens"))
