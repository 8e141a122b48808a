"""Ranked lexical search: best-first document intervals, bounded by range maxima of posting lists."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windward.llm.blockkeys import pressed, restored
from windward.llm.common import block_ids, expand, factor_bytes, narrow, pieces, starts_of, text_of
from windward.operators.lookup import lookup_join
from windward.session import stage

BLOCK_BYTES = 8_000_000
ITEMS_PER_CHUNK = 500
AT_ONCE = 48  # intervals split in one step
NO_ID = 2**63 - 1  # stands for a null id: last among equal scores

#: Bytes of terms: digits, lower-case letters and everything beyond ASCII; upper case is lowered, the rest are blanks.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_TERM_BYTES).split()


def index_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of whole documents as posting lists: block, ids and n (by rising n), words, df, docs, tf.

    Documents without terms are in no block.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BLOCK_BYTES):
            terms = [terms_of(t) for t in batch.column("text").to_pylist()]
            ids = np.array([NO_ID if i is None else i for i in batch.column("id").to_pylist()], np.int64)
            n = np.fromiter(map(len, terms), np.int64, len(terms))
            order = np.lexsort((ids, n))
            order = order[n[order] > 0]  # documents of like length stand together, so that their impacts are alike
            if not len(order):
                continue
            codes, words = factor_bytes([t for i in order for t in terms[i]])
            keys, tf = np.unique(codes * len(order) + np.repeat(np.arange(len(order)), n[order]), return_counts=True)
            df = np.bincount(keys // len(order), minlength=len(words))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block_ids(1)), pa.array([len(order)], pa.int64()), pa.array([int(n.sum())], pa.int64()), pa.array([pressed(ids[order])], pa.binary()),
                 pa.array([pressed(n[order])], pa.binary()), pa.array([zstandard.compress(b" ".join(words), 1)], pa.binary()),
                 pa.array([pressed(df.astype(np.int32))], pa.binary()), pa.array([pressed((keys % len(order)).astype(np.int32))], pa.binary()),
                 pa.array([pressed(tf.astype(np.int32))], pa.binary())],
                ["block", "n_docs", "n_terms", "ids", "n", "words", "df", "docs", "tf"])

    return stage(docs.mapInArrow(run, "block long, n_docs long, n_terms long, ids binary, n binary, words binary, df binary, docs binary, tf binary"), "search-index")


def _document_counts(index: DataFrame) -> DataFrame:
    """(term, df) of every block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = zstandard.decompress(batch.column("words")[i].as_py()).split()
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(restored(batch.column("df")[i].as_py(), np.int32).astype(np.int64))], ["term", "df"])

    return index.select("words", "df").mapInArrow(run, "term binary, df long")


def _item_terms(items: DataFrame, id_type: str) -> DataFrame:
    """(item_id, term), once each; rows of one id are one item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(t))) for t in batch.column("text").to_pylist()]
            which = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(which)), pa.array([t for ts in terms for t in ts], pa.binary())], ["item_id", "term"])

    return items.mapInArrow(run, f"item_id {id_type}, term binary").distinct()


class Shard:
    """Posting lists of the asked terms of one block, with one sparse table of range maxima over all of them."""

    def __init__(self, n: np.ndarray, ids: np.ndarray, length: np.ndarray, docs: np.ndarray, tf: np.ndarray, total_docs: int, total_terms: int) -> None:
        """``length``: postings of each term in turn; ``n``: terms of each document."""
        self.size, self.ids, self.docs = len(n), ids, docs.astype(np.int64)
        m = 50 + (50 * n * total_docs) // total_terms
        tf = tf.astype(np.int64)
        self.impact = np.append((1_000_000_000 * tf) // (1000 * tf + 20 * m[self.docs]), 0)  # the last stands for no posting
        self.edge = np.append(starts_of(length), len(docs)).astype(np.int64)
        self.keys = np.append(np.repeat(np.arange(len(length)), length) * self.size + self.docs, np.iinfo(np.int64).max)
        self.best = self._table(len(docs), int(length.max(initial=1)), lambda a, b: np.where(self.impact[a] >= self.impact[b], a, b))
        self.first = self._table(len(n), len(n), lambda a, b: np.where(ids[a] <= ids[b], a, b))

    @staticmethod
    def _table(n: int, longest: int, better) -> np.ndarray:
        """Row k: the best place among the 2**k from each place on."""
        rows = max(1, longest.bit_length())
        table = np.zeros((rows, max(n, 1)), np.int32)
        table[0] = np.arange(max(n, 1))
        for k in range(1, rows):
            half, many = 1 << (k - 1), n - (1 << k) + 1
            if many > 0:
                table[k, :many] = better(table[k - 1, :many], table[k - 1, half:half + many])
        return table

    def greatest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The posting of the greatest impact in each range a .. b - 1; of an empty one the last, which has none."""
        some = b > a
        k = np.frexp(np.maximum(b - a, 1))[1] - 1
        left, right = self.best[k, np.where(some, a, 0)], self.best[k, np.where(some, b - (1 << k), 0)]
        return np.where(some, np.where(self.impact[left] >= self.impact[right], left, right), len(self.docs))

    def least_id(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The least id among the documents lo .. hi - 1 (not empty)."""
        k = np.frexp(hi - lo)[1] - 1
        return np.minimum(self.ids[self.first[k, lo]], self.ids[self.first[k, hi - (1 << k)]])

    def search(self, terms: np.ndarray, weights: np.ndarray, kept: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The best k of ``kept`` (scores, ids) and of this shard's documents, best first.

        An interval of documents is bounded by the sum of its terms' greatest impacts. The
        intervals of the greatest bounds are split at the document of their greatest impact, which
        is scored, until no interval can beat the k-th best.
        """
        weights, base = weights[:, None], (terms * self.size)[:, None]
        lo, hi = np.zeros(1, np.int64), np.full(1, self.size)
        a, b = self.edge[terms][:, None], self.edge[terms + 1][:, None]
        bound, at = self._bounds(a, b, weights)
        while True:
            live = self._can_win(bound, lo, hi, kept, k)
            if not live.all():
                lo, hi, a, b, bound, at = lo[live], hi[live], a[:, live], b[:, live], bound[live], at[live]
            if not len(lo):
                return kept
            pick = np.argpartition(-bound, AT_ONCE)[:AT_ONCE] if len(bound) > AT_ONCE else np.arange(len(bound))
            doc = at[pick]
            place = np.searchsorted(self.keys, base + doc)
            hit = self.keys[place] == base + doc
            score = (weights * np.where(hit, self.impact[place], 0)).sum(0)
            kept = best_of(np.concatenate([kept[0], score]), np.concatenate([kept[1], self.ids[doc]]), k)
            rest = np.ones(len(bound), bool)
            rest[pick] = False
            new_lo, new_hi = np.concatenate([lo[pick], doc + 1]), np.concatenate([doc, hi[pick]])
            new_a, new_b = np.concatenate([a[:, pick], place + hit], axis=1), np.concatenate([place, b[:, pick]], axis=1)
            new_bound, new_at = self._bounds(new_a, new_b, weights)
            some = new_hi > new_lo
            lo, hi = np.concatenate([lo[rest], new_lo[some]]), np.concatenate([hi[rest], new_hi[some]])
            a, b = np.concatenate([a[:, rest], new_a[:, some]], axis=1), np.concatenate([b[:, rest], new_b[:, some]], axis=1)
            bound, at = np.concatenate([bound[rest], new_bound[some]]), np.concatenate([at[rest], new_at[some]])

    def _bounds(self, a: np.ndarray, b: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bound of each interval, and the document of its greatest impact."""
        top = self.greatest(a, b)
        value = weights * self.impact[top]
        posting = np.take_along_axis(top, value.argmax(0)[None, :], 0)[0]
        return value.sum(0), np.append(self.docs, 0)[posting]

    def _can_win(self, bound: np.ndarray, lo: np.ndarray, hi: np.ndarray, kept: tuple[np.ndarray, np.ndarray], k: int) -> np.ndarray:
        """Whether an interval may hold a document above the k-th best: a greater score, or the same and a lesser id."""
        if len(kept[0]) < k:
            return bound > 0
        live = bound > kept[0][-1]
        tie = np.flatnonzero(bound == kept[0][-1])
        live[tie] = self.least_id(lo[tie], hi[tie]) < kept[1][-1]
        return live


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest scores above 0, the lesser id first among equals."""
    order = np.lexsort((ids, -scores))[:k]
    order = order[scores[order] > 0]
    return scores[order], ids[order]


def _shard(batch: pa.RecordBatch, i: int, asked: dict[bytes, int], total_docs: int, total_terms: int) -> Shard:
    """The shard of one block for the asked terms (term -> number)."""
    cell = {c: batch.column(c)[i].as_py() for c in ("ids", "n", "words", "df", "docs", "tf")}
    df = restored(cell["df"], np.int32).astype(np.int64)
    number = np.array([asked.get(w, -1) for w in zstandard.decompress(cell["words"]).split()], np.int64)
    have = np.flatnonzero(number >= 0)
    have = have[np.argsort(number[have])]
    length = np.zeros(len(asked), np.int64)
    length[number[have]] = df[have]
    at = expand(starts_of(df)[have], df[have])
    return Shard(restored(cell["n"], np.int64), restored(cell["ids"], np.int64), length, restored(cell["docs"], np.int32)[at], restored(cell["tf"], np.int32)[at],
                 total_docs, total_terms)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item, among all whole documents.

    Terms are runs of digits, ASCII letters (lowered) and characters beyond ASCII. A term's weight falls
    with the number of documents that hold it, its impact grows with its occurrences in a document and falls with the
    document's length; a score sums both over the item's terms, once each. Only scores above 0 count;
    of equal scores the lesser doc_id is first, a null one last (as are ids of 2**63 - 1, which come out as null). Null texts
    have no terms. Rows of one item_id, null included, are one item with all their terms; every document row is a
    document, so repeated rows may rank one after the other. No documents, no items or no common term: no rows.

    Posting lists stand in blocks of documents. Items go to the blocks in chunks of ``ITEMS_PER_CHUNK``; a task takes
    what it has found so far to its next block, and hands on k documents per item.
    """
    id_type = items.schema[item_col].dataType.simpleString()
    index = index_blocks(narrow(docs, id_col, text_col))
    total_docs, total_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    total_docs, total_terms = total_docs or 0, total_terms or 1
    terms = stage(_item_terms(items.select(F.col(item_col).alias("item_id"), text_of(item_text_col).alias("text")), id_type), "search-terms")
    asked = stage(terms.select("term").distinct(), "search-asked")  # a written table's size is known: Spark broadcasts it only if small
    counts = _document_counts(index).join(asked, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    chunks = max(1, -(-terms.select("item_id").distinct().count() // ITEMS_PER_CHUNK))
    weighted = lookup_join(terms, counts, ["term"], "inner")
    packed = weighted.groupBy("item_id").agg(F.collect_list(F.struct("term", "df")).alias("terms")).groupBy(
        F.pmod(F.xxhash64("item_id"), F.lit(chunks)).cast("int").alias("chunk")).agg(F.collect_list(F.struct("item_id", "terms")).alias("items"))
    packed = stage(packed, "search-items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, tuple[dict[bytes, int], list]] = {}
        kept: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = batch.column("chunk")[i].as_py()
                if chunk not in asked:
                    number: dict[bytes, int] = {}
                    wanted = []
                    for item in batch.column("items")[i].as_py():
                        slots = np.array([number.setdefault(t["term"], len(number)) for t in item["terms"]], np.int64)
                        weights = np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * t["df"] + 1))) for t in item["terms"]], np.int64)
                        wanted.append((item["item_id"], slots, weights))
                    asked[chunk], kept[chunk] = (number, wanted), [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(wanted)
                number, wanted = asked[chunk]
                shard = _shard(batch, i, number, total_docs, total_terms)
                for j, (_, slots, weights) in enumerate(wanted):
                    here = shard.edge[slots + 1] > shard.edge[slots]
                    if here.any():
                        kept[chunk][j] = shard.search(slots[here], weights[here], kept[chunk][j], k)
        for chunk, (_, wanted) in asked.items():
            for (item, _, _), (scores, ids) in zip(wanted, kept[chunk], strict=True):
                if len(ids):
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(ids), id_arrow), pa.array(ids, mask=ids == NO_ID), pa.array(scores)], ["item_id", "doc_id", "score"])

    id_arrow = _arrow_type(items, item_col)
    tasks = lookup_join(index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))), packed, ["chunk"], "inner")
    found = tasks.mapInArrow(run, f"item_id {id_type}, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)
