"""Helpers the operators of this package share."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windward.operators.lookup import lookup_join
from windward.session import note_staged, run_dir, settle, stage, staged_so_far

MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def text_of(column: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(column: str) -> Column:
    """A 64-bit key of the text. With the id it names a document, so rows that repeat both are one document."""
    return F.xxhash64(text_of(column))


def narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and text under names of our own, so that further columns cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))


def match_documents(docs: DataFrame, facts: DataFrame, how: str, id_col: str, text_col: str) -> DataFrame:
    """Join documents with facts (id, tk, ...) about them. A document's columns travel as one
    struct ``row``, so that no name can clash; select "row.*" to have them back. The facts grow
    with the documents, so the join is by sort and merge at every size."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(id_col).cast("long").alias("row_id"), text_key(text_col).alias("row_tk"))
    return rows.join(facts.hint("merge"), F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_tk") == F.col("tk")), how)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a finalizer of xor-shifts and odd factors)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(31)
    x *= MIX
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Where each of a series of runs begins."""
    return np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else np.zeros(0, np.int64)


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the given runs, one run after the other."""
    total = int(lengths.sum())
    return np.arange(total, dtype=np.int64) - np.repeat(starts_of(lengths) - starts, lengths)


def factor(words: list[str]) -> tuple[np.ndarray, list[str]]:
    """Numbers for words by first occurrence, and the distinct words."""
    coded = pa.array(words, pa.large_string()).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def factor_bytes(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Numbers for byte strings by first occurrence, and the distinct ones."""
    coded = pa.array(words, pa.large_binary()).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def pieces(batches: Iterable[pa.RecordBatch], text_col: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of text; a longer text stands alone."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text_col)), 0))
        part = np.cumsum(sizes) // most
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def block_ids(n: int) -> np.ndarray:
    """Numbers for new blocks. They are written to a table before anything refers to them."""
    return np.random.default_rng().integers(0, 2**63 - 1, n)


def bucketed(rows: DataFrame, buckets: int, label: str) -> DataFrame:
    """Write rows bucketed by ``block`` to the shared folder; joins by block then leave them where they are.

    Spark moves the side with fewer partitions, so there are at least as many buckets as shuffle partitions.
    """
    conf = rows.sparkSession.conf
    buckets = min(max(buckets, int(conf.get("spark.sql.shuffle.partitions"))), int(conf.get("spark.sql.sources.bucketing.maxBuckets")))
    path = run_dir(rows.sparkSession, label)
    name = os.path.basename(path).replace("-", "_")
    rows.write.bucketBy(buckets, "block").option("path", path).option("compression", "zstd").saveAsTable(name)
    note_staged(path, name)
    return rows.sparkSession.table(name)


class LocalComponents:
    """Connected components of what one task sees, of nodes numbered by place."""

    def __init__(self, names: np.ndarray) -> None:
        self.names, at = np.unique(names, return_inverse=True)
        self.at, self.root = at.ravel(), np.arange(len(self.names))

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Connect places a[i] and b[i]; roots are the smallest names."""
        a, b = self.at[a], self.at[b]
        while True:
            u, v = self.root[a], self.root[b]
            apart = u != v
            if not apart.any():
                return
            a, b, u, v = a[apart], b[apart], u[apart], v[apart]
            np.minimum.at(self.root, np.maximum(u, v), np.minimum(u, v))
            while (up := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(node, root) of the nodes that are connected with a smaller one."""
        moved = np.flatnonzero(self.root != np.arange(len(self.root)))
        return self.names[moved], self.names[self.root[moved]]


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of ``edges`` (u, v: long): rows (node, component), the smallest node of each.

    Large and small star steps in turn: every node hands its smallest neighbour
    on to the others, until nothing changes. Each step is two aggregations and
    two joins over the edges; a node with very many edges is combined map-side and
    its join partition can be split. Each round is written to the shared folder.
    """
    since = staged_so_far()
    now = stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    seen = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = lookup_join(both.filter("v > u"), least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        mins = large.groupBy("u").agg(F.min("v").alias("m"))
        small = lookup_join(large, mins, ["u"])
        now = settle(
            small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .union(mins.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), label, since)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
