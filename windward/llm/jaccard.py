"""Near-duplicate texts: a chosen-path join on shingle sets, with exact Jaccard similarities."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windward.llm.common import LocalComponents, components, expand, factor, match_documents, mix, pieces, starts_of, text_key, text_of
from windward.operators.lookup import lookup_join
from windward.session import stage

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9999
DEPTH = 3
LEAF = 500
CHUNK = 1_500
PIECE_BYTES = 2_500_000
WORD = re.compile(r"\w+")


def runs_for(recall: float, similarity: float = SIMILARITY, depth: int = DEPTH) -> int:
    """Runs after which a pair at the limit has met in a bucket, even if all runs split to full depth."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**depth))


def shingles(texts: list[str], n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the runs of ``n_words`` lower-case words, text after text, and how many each text has.

    A shorter text with words is one shingle; a text without words has none.
    """
    words: list[str] = []
    n = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        found = WORD.findall(t.lower())
        words += found
        n[i] = len(found)
    codes, distinct = factor(words)
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64, len(distinct))[codes]
    size = np.minimum(n, n_words)
    counts = np.where(n > 0, n - size + 1, 0)
    at = expand(starts_of(n), counts)
    length = np.repeat(size, counts)
    out = length.astype(np.uint64)
    for k in range(n_words):
        inside = k < length
        out = np.where(inside, mix(out + hashed[np.where(inside, at + k, 0)]) if len(at) else out, out)
    return out, counts


def signatures(docs: DataFrame, n_words: int, size: int) -> DataFrame:
    """(tk, sig): for each text with words the minima of its shingles under ``size`` orders.

    Each order multiplies the hash by an odd number, so a minimum stands for one
    shingle: the token the text picks in that order.
    """
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE_BYTES):
            hashed, counts = shingles(batch.column("text").to_pylist(), n_words)
            some = np.flatnonzero(counts)
            if not len(some):
                continue
            at = starts_of(counts)[some]
            sig = np.stack([np.minimum.reduceat(hashed * f, at) for f in factors], axis=1).view(np.int64)
            offsets = np.arange(len(some) + 1, dtype=np.int32) * size
            yield pa.RecordBatch.from_arrays([batch.column("tk").take(pa.array(some)), pa.ListArray.from_arrays(offsets, sig.ravel())], ["tk", "sig"])

    return docs.select("tk", "text").mapInArrow(run, "tk long, sig array<long>")


def buckets(sigs: DataFrame, runs: int, depth: int, leaf: int) -> DataFrame:
    """(bucket, tk, size): the leaves of the chosen-path trees with more than one text.

    In each run a text follows the token it picks at the root; only buckets of more
    than ``leaf`` texts are split again by the token picked one level below, down to
    ``depth``. Buckets are counted before anything is joined.
    """
    paths = sigs.select("tk", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.slice("sig", r * depth + 1, depth))).alias("r", "picks"))
    now = paths.select("tk", "picks", F.xxhash64("r", F.get("picks", F.lit(0))).alias("bucket"))
    out = None
    for level in range(1, depth + 1):
        now = stage(now, "paths")
        sized = lookup_join(now, now.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"), ["bucket"], "inner")
        small = sized if level == depth else sized.filter(F.col("size") <= leaf)
        out = small.select("bucket", "tk", "size") if out is None else out.union(small.select("bucket", "tk", "size"))
        if level < depth:
            now = sized.filter(F.col("size") > leaf).select("tk", "picks", F.xxhash64("bucket", F.get("picks", F.lit(level))).alias("bucket"))
    return out


def dealt(rows: DataFrame, size: Column, chunk: int) -> DataFrame:
    """Rows of each group as bases and as queries, for every pair of chunks of the group: adds role, bc, qc.

    A group of many rows is spread over tasks that hold two chunks at a time.
    """
    n = F.ceil(size / chunk)
    both = rows.withColumns({"role": F.explode(F.array(F.lit(0), F.lit(1))), "mine": F.pmod(F.xxhash64("tk", F.lit(5)), n)})
    both = both.withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    base = F.col("role") == 0
    return both.withColumns({"bc": F.when(base, F.col("mine")).otherwise(F.col("other")),
                             "qc": F.when(base, F.col("other")).otherwise(F.col("mine"))}).filter("bc <= qc").drop("mine", "other")


def candidates(sigs: DataFrame, similarity: float, runs: int, depth: int, leaf: int) -> DataFrame:
    """(u, v): texts that a bucket shows to be similar by their signatures, each tied to the smallest it is connected with.

    A pair at the limit agrees on a share ``similarity`` of the orders; pairs four
    standard deviations below are let through to the exact check.
    """
    leaves = buckets(sigs, runs, depth, leaf)
    full = lookup_join(dealt(leaves, F.col("size"), CHUNK), sigs, ["tk"], "inner")
    n = runs * depth
    least = math.floor(n * (similarity - 4 * math.sqrt(similarity * (1 - similarity) / n)))

    def run(group: pa.Table) -> pa.Table:
        tk, role = group.column("tk").to_numpy(), group.column("role").to_numpy()
        sig = np.asarray(pa.concat_arrays([c.flatten() for c in group.column("sig").chunks])).reshape(len(tk), -1).astype(np.uint32)
        b, q = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        found = LocalComponents(tk)
        columns = np.ascontiguousarray(sig[q].T)
        for s in range(0, len(b), 256):
            part = b[s:s + 256]
            hits = np.zeros((len(part), len(q)), np.uint8 if n < 256 else np.uint16)
            for j in range(n):
                hits += sig[part, j][:, None] == columns[j][None, :]
            i, k = np.nonzero(hits >= least)
            found.join(part[i], q[k])
        u, v = found.edges()
        return pa.table({"u": u, "v": v}, schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))

    return full.groupBy("bucket", "bc", "qc").applyInArrow(run, "u long, v long")


def verified(members: DataFrame, docs: DataFrame, similarity: float, n_words: int) -> DataFrame:
    """(node, root, n): exact links among the candidates; per text how many documents with other texts it
    is linked with, and the smallest text it is connected with in the task.

    ``members``: tk, id (the document whose text is read), n (documents with that text),
    component, size. The sets of a component meet in tasks of two chunks. Shared
    shingles are counted through an inverted list of the queries, exactly.
    """
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE_BYTES):
            hashed, counts = shingles(batch.column("text").to_pylist(), n_words)
            parts = np.split(hashed, np.cumsum(counts)[:-1])
            blobs = [np.unique(p).tobytes() for p in parts]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("tk", "component", "size", "n")], pa.array(blobs, pa.binary())],
                                             ["tk", "component", "size", "n", "set"])

    texts = docs.join(members.withColumnRenamed("id", "_i").withColumnRenamed("tk", "_t"),
                      F.col("id").eqNullSafe(F.col("_i")) & (F.col("tk") == F.col("_t"))).select("tk", "component", "size", "n", "text")
    rows = texts.mapInArrow(sets, "tk long, component long, size long, n long, set binary").dropDuplicates(["tk"])
    full = dealt(stage(rows, "shingle-sets"), F.col("size"), CHUNK)
    schema = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("n", pa.int64())])

    def run(key: tuple, group: pa.Table) -> pa.Table:
        tk, role, n = (group.column(c).to_numpy() for c in ("tk", "role", "n"))
        arrays = [np.frombuffer(x, np.uint64) for x in group.column("set").to_pylist()]
        size = np.fromiter(map(len, arrays), np.int64, len(arrays))
        b, q = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        if not len(b) or not len(q):
            return schema.empty_table()
        _, token = np.unique(np.concatenate(arrays), return_inverse=True)
        first = starts_of(size)
        # The queries that hold each token.
        q_token = token[expand(first[q], size[q])]
        order = np.argsort(q_token, kind="stable")
        holder = np.repeat(np.arange(len(q)), size[q])[order]
        held = np.bincount(q_token, minlength=int(token.max()) + 1)
        list_at = starts_of(held)
        twice = key[1].as_py() != key[2].as_py()  # two chunks meet here only: count for both sides
        counts, found = np.zeros(len(tk), np.int64), LocalComponents(tk)
        for i in b:
            mine = token[first[i]:first[i] + size[i]]
            shared = np.bincount(holder[expand(list_at[mine], held[mine])], minlength=len(q))
            similar = np.flatnonzero(shared >= similarity * (size[q] + size[i] - shared) - 1e-9)
            k = q[similar[tk[q[similar]] != tk[i]]]
            counts[i] += n[k].sum()
            if twice:
                counts[k] += n[i]
            found.join(np.full(len(k), i), k)
        node, root = found.edges()
        own = np.flatnonzero(counts)
        return pa.Table.from_arrays([pa.array(np.concatenate([node, tk[own]])), pa.array(np.concatenate([root, tk[own]])),
                                     pa.array(np.concatenate([np.zeros(len(node), np.int64), counts[own]]))], schema=schema)

    return full.groupBy("component", "bc", "qc").applyInArrow(run, "node long, root long, n long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, n_words: int = WORDS, recall: float = RECALL, depth: int = DEPTH,
                    leaf: int = LEAF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its class, its number of links, and whether it is the one of its class that stays.

    Documents link if the Jaccard similarity of their sets of ``n_words``-word shingles is
    ``similarity`` or more, or if their texts are equal; a class is what links connect,
    named by its smallest doc_id, whose document stays (null ids are smallest, then the
    smaller text key). ``n_links`` counts other documents. Equal texts are compared once.
    Texts of fewer words are one shingle; null, empty and wordless texts link with
    equal texts only (null counts as empty). Rows that repeat id and text are one
    document with one row each. An empty table gives an empty result.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("tk"), text_of(text_col).alias("text"))
    runs = runs_for(recall, similarity, depth)
    ids = stage(keyed.select("id", "tk"), "text-ids")
    texts = ids.distinct().groupBy("tk").agg(F.min(F.struct("id")).alias("s"), F.count("*").alias("n")).select("tk", "s.id", "n")
    sigs = stage(signatures(keyed, n_words, runs * depth).dropDuplicates(["tk"]), "signatures")
    near = components(candidates(sigs, similarity, runs, depth, leaf), "candidate-groups")
    sizes = near.groupBy("component").agg(F.count("*").alias("size"))
    members = lookup_join(lookup_join(near, sizes, ["component"], "inner").withColumnRenamed("node", "tk"), texts, ["tk"], "inner")
    found = stage(verified(members, keyed, similarity, n_words), "text-links")
    groups = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), "text-classes").withColumnRenamed("node", "tk")
    links = found.groupBy(F.col("node").alias("tk")).agg(F.sum("n").alias("links"))
    facts = lookup_join(lookup_join(texts, links, ["tk"]), groups, ["tk"]).withColumn("component", F.coalesce("component", "tk"))
    stays = facts.groupBy("component").agg(F.min(F.struct("id", "tk")).alias("first"))
    facts = lookup_join(facts, stays, ["component"]).select(
        "tk", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "first", F.col("id").alias("copy_of"))
    out = lookup_join(ids, facts, ["tk"])
    return out.select(F.col("id").alias("doc_id"), F.col("first.id").alias("class_id"), F.col("n_links").cast("long"),
                      (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("tk") == F.col("first.tk"))).alias("kept"), "copy_of",
                      F.col("tk").alias("text_key"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """One document of each class, with all its columns."""
    stays = near_duplicates(docs, id_col=id_col, text_col=text_col, **options).filter("kept").select(
        F.col("doc_id").alias("id"), F.col("text_key").alias("tk")).distinct()
    return match_documents(docs, stays, "left_semi", id_col, text_col).dropDuplicates(["row_id", "row_tk"]).select("row.*")
