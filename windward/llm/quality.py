"""Quality by the perplexity of an interpolated modified Kneser-Ney model of trusted text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windward.llm.common import block_ids, bucketed, expand, match_documents, mix, pieces, starts_of, text_key, text_of
from windward.operators.lookup import lookup_join
from windward.session import settle, stage, staged_so_far

ORDER = 4
BLOCK_BYTES = 8_000_000
CHUNK_SYMBOLS = 500_000
GRAMS_PER_SHARD = 1_000_000  # asked for by all blocks
START, END, AGAIN = "\x02", "\x03", "\ue000"
FOLDS = 5
FENCE = 6.0
SHORT = 500
LEAST_RANGE = 0.02  # of mean log perplexity; a class of like texts has hardly any scatter of its own


def symbols(text: str) -> str:
    """The text as the model reads it: words with single spaces. A word said again at once is
    a sign and its last two characters, so that every repetition is as unlikely as the first."""
    words = text.split()
    return " ".join([AGAIN + a[-2:] if a == b else a for a, b in zip(words, [None, *words], strict=False)]).replace(f" {AGAIN}", AGAIN)


class Grams:
    """n-grams of the symbols of texts, as numbers that are exact within a block."""

    def __init__(self, texts: list[str], order: int) -> None:
        pad = START * (order - 1)
        self.order, self.texts = order, [pad + t + END for t in texts]
        seen = np.zeros(0x110000, bool)
        for flat, _ in self._flat():
            seen[flat] = True
        self.alphabet = np.flatnonzero(seen)
        self.dense = np.zeros(0x110000, np.uint64)
        self.dense[self.alphabet] = np.arange(len(self.alphabet), dtype=np.uint64)

    def _flat(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        part: list[str] = []
        size = 0
        for i, t in enumerate(self.texts):
            part.append(t)
            size += len(t)
            if size >= CHUNK_SYMBOLS or i == len(self.texts) - 1:
                yield np.frombuffer("".join(part).encode("utf-32-le"), "<u4"), np.fromiter(map(len, part), np.int64, len(part))
                part, size = [], 0

    def chunks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Keys of the n-grams of some texts, how many each text has, where each begins, and the symbols."""
        exact = len(self.alphabet) ** self.order < 2**63
        for flat, n in self._flat():
            code = self.dense[flat]
            counts = n - (self.order - 1)
            at = expand(starts_of(n), counts)
            key = np.zeros(len(at), np.uint64)
            for i in range(self.order):
                key = key * np.uint64(len(self.alphabet)) + code[at + i] if exact else mix(key + code[at + i] + np.uint64(1))
            yield key.view(np.int64), counts, at, flat

    def strings(self, places: np.ndarray, flat: np.ndarray) -> list[str]:
        rows = flat[places[:, None] + np.arange(self.order)]
        text = np.ascontiguousarray(rows).tobytes().decode("utf-32-le")
        return [text[i:i + self.order] for i in range(0, len(text), self.order)]


def pack(texts: list[str]) -> bytes:
    return zstandard.compress("\0".join(t.replace("\0", " ") for t in texts).encode(), 6)


def unpack(blob: bytes) -> list[str]:
    return zstandard.decompress(blob).decode().split("\0")


def text_blocks(docs: DataFrame, order: int) -> DataFrame:
    """Blocks of documents as a bucketed table: (block, blob, ids, tks, grams).

    A block holds the symbols of up to ``BLOCK_BYTES`` of text, compressed, and its
    distinct n-grams by first occurrence. What later joins bring to a block is
    shuffled to the block's bucket; the texts stay where they are.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BLOCK_BYTES):
            texts = [symbols(t) for t in batch.column("text").to_pylist()]
            grams = Grams(texts, order)
            found: list[str] = []
            known = pd.Index([], dtype="int64")
            for key, _, at, flat in grams.chunks():
                codes, fresh = pd.factorize(key)
                first = np.empty(len(fresh), np.int64)
                first[codes[::-1]] = at[::-1]
                new = known.get_indexer(fresh) < 0
                found += grams.strings(first[new], flat)
                known = known.append(pd.Index(fresh[new]))
            ids, tks = batch.column("id").to_pylist(), batch.column("tk").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(block_ids(1)), pa.array([pack(texts)], pa.binary()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([tks], pa.list_(pa.int64())), pa.array([found], pa.list_(pa.string()))], ["block", "blob", "ids", "tks", "grams"])

    rows = docs.mapInArrow(run, "block long, blob binary, ids array<long>, tks array<long>, grams array<string>")
    return bucketed(rows, max(1, docs.rdd.getNumPartitions()), "lm-blocks")


def trusted_counts(blocks: DataFrame, trusted: DataFrame, order: int) -> DataFrame:
    """(gram, n): n-gram counts of the trusted documents (id, or id and tk: each of these once), summed per block before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                texts = unpack(batch.column("blob")[i].as_py())
                grams = Grams([texts[r] for r in sorted(set(batch.column("rows")[i].as_py()))], order)
                for key, _, at, flat in grams.chunks():
                    codes, _ = pd.factorize(key)
                    n = np.bincount(codes)
                    first = np.empty(len(n), np.int64)
                    first[codes[::-1]] = at[::-1]
                    yield pa.RecordBatch.from_arrays([pa.array(grams.strings(first, flat), pa.string()), pa.array(n)], ["gram", "n"])

    # Places in the blocks of the trusted documents; the join brings them to the blocks' buckets.
    where = blocks.select("block", F.posexplode(F.arrays_zip("ids", "tks")).alias("row", "d")).select(
        "block", "row", F.col("d.ids").alias("id"), F.col("d.tks").alias("tk"))
    found = where.join(trusted, [c for c in ("id", "tk") if c in trusted.columns])
    if "tk" in trusted.columns:
        found = found.groupBy("id", "tk").agg(F.min(F.struct("block", "row")).alias("d")).select("d.*")
    rows = found.groupBy("block").agg(F.collect_list("row").alias("rows"))
    picked = blocks.select("block", "blob").join(rows, "block").select("blob", "rows")
    return picked.mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _suffix(column: str, n: int) -> Column:
    return F.substring(F.col(column), -n, n)


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney from how many n-grams occur once, twice, three and four times."""
    n = {r.n: r.k for r in counts.filter("n <= 4").groupBy("n").agg(F.count("*").alias("k")).collect()}  # at most four rows
    n1, n2, n3, n4 = (n.get(i, 0) for i in range(1, 5))
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(i - (i + 1) * y * b / a, 0.05), i - 0.05) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


def kneser_ney(counts: DataFrame, order: int) -> tuple[list[DataFrame], list[DataFrame], float]:
    """Per order 1 .. n: (gram, a) the discounted share of a gram, (context, gamma) the weight of the
    next lower order; and the probability of an unknown symbol at the bottom.

    Counts below the highest order are numbers of distinct left neighbours.
    """
    tables, weights = [], []
    levels = [counts]
    for k in range(order - 1, 0, -1):
        levels.append(stage(levels[-1].groupBy(_suffix("gram", k).alias("gram")).agg(F.count("*").alias("n")), "lm-counts"))
    for k, level in enumerate(reversed(levels), 1):
        d1, d2, d3 = discounts(level)
        cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        context = F.substring("gram", 1, k - 1) if k > 1 else F.lit("")
        rows = level.withColumns({"context": context, "cut": cut})
        sums = stage(rows.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("gamma")), "lm-contexts")
        tables.append(lookup_join(rows, sums, ["context"]).select("gram", ((F.col("n") - F.col("cut")) / F.col("total")).alias("a")))
        weights.append(sums.select("context", "gamma"))
    bottom = levels[-1].count() + 1
    gamma = weights[0].first()
    return tables, weights, (gamma.gamma if gamma else 1.0) / bottom


def log_probabilities(wanted: DataFrame, tables: list[DataFrame], weights: list[DataFrame], unknown: float, order: int, since: int) -> DataFrame:
    """(gram, lp) for distinct n-grams: from the last symbol up, each order joined with its own counts.

    Only the last order's table stays of what was staged since the given moment.
    """
    now = None
    for k in range(1, order + 1):
        grams = wanted.select(_suffix("gram", k).alias("gram")).distinct() if k < order else wanted
        rows = lookup_join(grams, tables[k - 1], ["gram"]).fillna(0.0, ["a"])
        if k == 1:
            now = rows.select("gram", (F.col("a") + unknown).alias("p"))
            continue
        rows = rows.withColumns({"context": F.substring("gram", 1, k - 1), "low": _suffix("gram", k - 1)})
        rows = lookup_join(rows, weights[k - 1], ["context"]).fillna(1.0, ["gamma"])
        rows = lookup_join(rows, now.withColumnsRenamed({"gram": "low", "p": "q"}), ["low"])
        found = rows.select("gram", (F.col("a") + F.col("gamma") * F.col("q")).alias("p"))
        now = settle(found, "lm-probabilities", since) if k == order else stage(found, "lm-probabilities")
    return now.select("gram", F.log("p").cast("float").alias("lp"))


def _codes(grams: list[str], order: int) -> np.ndarray:
    """The characters of n-grams as numbers, one row each."""
    return np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(-1, order)


def _shard(codes: np.ndarray, shards: int) -> np.ndarray:
    key = np.zeros(len(codes), np.uint64)
    for column in codes.T:
        key = mix(key + column.astype(np.uint64) + np.uint64(1))
    return (key % np.uint64(shards)).astype(np.int64)


def _by_shard(codes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of n-grams by shard, and in it by their characters; the shards there are, and the number of n-grams in each."""
    shard = _shard(codes, shards)
    order = np.lexsort((*codes.T[::-1], shard))
    some, n = np.unique(shard, return_counts=True)
    return order, some, n


def _answers(blocks: DataFrame, lp: DataFrame, order: int, shards: int) -> DataFrame:
    """(block, lp): for each block the log probabilities of its n-grams, in the order of ``_by_shard``, in pieces.

    Blocks ask each shard for its n-grams in one packed row, and get one back.
    """
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes = _codes(batch.column("grams")[i].as_py(), order)
                at, some, n = _by_shard(codes, shards)
                codes, ends = codes[at], np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), batch.column("block")[i].as_py(), np.int64)),
                     pa.array([zstandard.compress(np.ascontiguousarray(codes[e - k:e].T).tobytes(), 3) for e, k in zip(ends, n, strict=True)], pa.binary())],
                    ["shard", "block", "grams"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = _shard(_codes(batch.column("gram").to_pylist(), order), shards) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), batch.column("gram"), batch.column("lp")], ["shard", "gram", "lp"])

    def tell(asked: pa.Table, known: pa.Table) -> pa.Table:
        values = known.column("lp").to_numpy()
        index = pd.Index(known.column("gram").to_pylist(), dtype=object)
        out = []
        for packed in asked.column("grams").to_pylist():
            codes = np.ascontiguousarray(np.frombuffer(zstandard.decompress(packed), np.uint32).reshape(order, -1).T)
            text = codes.tobytes().decode("utf-32-le")
            out.append(values[index.get_indexer([text[i:i + order] for i in range(0, len(text), order)])].astype(np.float32).tobytes())
        return pa.table({"block": asked.column("block"), "shard": asked.column("shard"), "lp": pa.array(out, pa.binary())})

    asked = blocks.select("block", "grams").mapInArrow(ask, "shard int, block long, grams binary").repartition(2 * shards, "shard")
    known = lp.mapInArrow(place, "shard int, gram string, lp float").repartition(2 * shards, "shard")
    told = asked.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(tell, "block long, shard int, lp binary")
    return told.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("shard", "lp"))).alias("lp"))


def document_scores(docs: DataFrame, trusted: DataFrame, order: int = ORDER) -> DataFrame:
    """(id, tk, n_symbols, nll): the mean negative log probability of each document's symbols.

    ``docs``: id, tk, text; ``trusted``: ids, or ids and tks, of the documents to learn from. Counts and
    probabilities are sharded by n-gram. A block asks for each of its distinct
    n-grams once, which is what is shuffled, not the n-grams of every document.
    """
    blocks = text_blocks(docs, order)
    since = staged_so_far()
    counts = stage(trusted_counts(blocks, trusted, order), "lm-counts")
    tables, weights, unknown = kneser_ney(counts, order)
    asked = stage(blocks.select(F.explode("grams").alias("gram")).distinct(), "lm-grams")
    lp = log_probabilities(asked, tables, weights, unknown, order, since)
    shards = max(1, -(-(blocks.agg(F.sum(F.size("grams"))).first()[0] or 0) // GRAMS_PER_SHARD))
    answers = _answers(blocks, lp, order, shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                grams = Grams(unpack(batch.column("blob")[i].as_py()), order)
                at, _, _ = _by_shard(_codes(batch.column("grams")[i].as_py(), order), shards)
                lp = np.empty(len(at))
                lp[at] = np.frombuffer(b"".join(p["lp"] for p in batch.column("lp")[i].as_py()), np.float32)
                known, sums, sizes = pd.Index([], dtype="int64"), [], []
                for key, n, _, _ in grams.chunks():
                    codes, fresh = pd.factorize(key)
                    at = known.get_indexer(fresh)
                    new = at < 0
                    at[new] = len(known) + np.arange(new.sum())
                    known = known.append(pd.Index(fresh[new]))
                    sums.append(np.add.reduceat(lp[at][codes], starts_of(n)))
                    sizes.append(n)
                size = np.concatenate(sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, batch.column("tks")[i].values, pa.array(size - 1), pa.array(-np.concatenate(sums) / size)],
                    ["id", "tk", "n_symbols", "nll"])

    joined = blocks.select("block", "blob", "grams", "ids", "tks").join(answers, "block").select("blob", "grams", "ids", "tks", "lp")
    return joined.mapInArrow(run, "id long, tk long, n_symbols long, nll double")


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Ids that only have labels of good quality and none of toxicity."""
    good = labels.groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    return good.filter("id is not null and q = 1 and t = 0").select("id")


def distinct_trusted(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(id, tk): of each distinct text of trusted documents the one with the smallest id."""
    return docs.select("id", "tk").join(trusted, "id", "left_semi").groupBy("tk").agg(F.min("id").alias("id")).select("id", "tk")


def judge(docs: DataFrame, labels: DataFrame, order: int = ORDER, fence: float = FENCE,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, text_key, lang, n_symbols, perplexity, threshold, rejected), one row per document.

    The model learns from four fifths of the trusted texts; the last fifth, by a
    hash of the text, sets the thresholds. Each distinct text counts once in both, and
    its copies are never in the other part. In each language and length class (powers
    of two) a document is rejected if its mean log perplexity lies more than ``fence``
    quartile ranges (``LEAST_RANGE`` at least) above the upper quartile of that fifth. Classes of fewer than 20
    held-out texts take the quartiles of their language, then those of all, however few. Without
    trusted documents nothing is rejected. Null and empty texts have no perplexity and stay.
    Rows that repeat id and text get one row each; a null language is a language of its own.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("tk"), text_of(text_col).alias("text"))
    trusted = stage(trusted_ids(labels, id_col), "trusted")
    held = F.pmod(F.xxhash64("tk", F.lit(7)), F.lit(FOLDS)) == 0
    sources = stage(distinct_trusted(keyed, trusted), "trusted-texts")
    since = staged_so_far()
    scores = settle(document_scores(keyed, sources.filter(~held), order), "lm-scores", since).dropDuplicates(["id", "tk"])
    facts = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("tk"), F.col(lang_col).cast("string").alias("lang"))
    rows = facts.alias("f").join(scores.alias("s"), F.col("f.id").eqNullSafe(F.col("s.id")) & (F.col("f.tk") == F.col("s.tk"))).select(
        "f.id", "f.tk", "f.lang", "s.n_symbols", "s.nll")
    rows = stage(rows.withColumns({"l": F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")),
                                   "size": F.floor(F.log2(F.col("n_symbols") + 1)).cast("int")}), "lm-rows")
    sample = rows.join(sources.filter(held), ["id", "tk"], "left_semi").filter("n_symbols > 0").dropDuplicates(["id", "tk"])

    def quartiles(by: list[str], name: str, least: int = 20) -> DataFrame:
        q = sample.groupBy(*by).agg(F.percentile_approx("nll", [0.25, 0.75], 10000).alias("q"), F.count("*").alias("n")).filter(F.col("n") >= least)
        return q.select(*by, F.get("q", F.lit(1)).alias(f"{name}_top"), F.greatest(F.get("q", F.lit(1)) - F.get("q", F.lit(0)), F.lit(LEAST_RANGE)).alias(f"{name}_range"))

    overall = quartiles([], "all", 1).first() or [None, None]  # one row
    out = lookup_join(lookup_join(rows, quartiles(["l", "size"], "size"), ["l", "size"]), quartiles(["l"], "lang"), ["l"])
    # Beside a class of its own length, a short text is allowed the wider scatter of few symbols.
    wide = fence * F.sqrt(F.greatest(F.lit(1.0), F.try_divide(F.lit(SHORT), F.col("n_symbols"))))
    limit = F.coalesce(F.col("size_top") + fence * F.col("size_range"), F.col("lang_top") + wide * F.col("lang_range"),
                       F.lit(overall[0]).cast("double") + wide * F.lit(overall[1]).cast("double"))
    return out.select(F.col("id").alias("doc_id"), F.col("tk").alias("text_key"), "lang", "n_symbols",
                      F.when(F.col("n_symbols") > 0, F.exp("nll")).alias("perplexity"), F.exp(limit).alias("threshold"),
                      F.coalesce((F.col("n_symbols") > 0) & (F.col("nll") > limit), F.lit(False)).alias("rejected"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    bad = judge(docs, labels, id_col=id_col, text_col=text_col, **options).filter("rejected").select(
        F.col("doc_id").alias("id"), F.col("text_key").alias("tk")).distinct()
    return match_documents(docs, bad, "left_anti", id_col, text_col).select("row.*")
