"""Alignment of two tokenizers over the same text: token groups by pointer jumping, links counted over the corpus."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windward.llm.blockkeys import pressed, restored
from windward.llm.bpe import SPACE, Merges, default_tokenizer
from windward.llm.common import block_ids, bucketed, expand, factor, narrow, pieces, starts_of
from windward.operators.lookup import lookup_join
from windward.session import stage

BLOCK_BYTES = 2_000_000
UNITS_AT_ONCE = 25_000
META = "▁"  # stands for a space in pieces

#: A single space between two other characters. No token of either kind reaches over it, so the text
#: falls into units there, and equal units are encoded and aligned alike.
BORDER = re.compile(rf"(?<=[^{SPACE}]) (?=[^{SPACE}])")
#: White space beside a space, or a space at an end: only here a space may be no border.
_WHITE = "[\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
UNEVEN = f"(^|{_WHITE}) | ({_WHITE}|$)"


class Pieces:
    """A sentencepiece model and the bytes of its pieces."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(META, " ").encode() for i, p in enumerate(names)]
        self.sizes = np.fromiter(map(len, self.bytes_of), np.int64, len(self.bytes_of))
        #: A piece with a space after another character would reach over a unit's border.
        self.splits = not any(re.search(f"[^{META}]{META}", p) for p in names)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the space the model adds, and how many each has."""
        found = self.model.encode(texts, num_threads=1) if texts else []
        n = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for x in found for i in x), np.int64, int(n.sum())), n


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terminal token of each token's component, by the byte offsets where the tokens of two cuts of one text end.

    Every token points to the token that reaches farthest to the right among those that overlap it: the
    other cut's token over its last byte, or, where both end together, the first cut's, which
    points to itself. Successors are doubled until none changes. Tokens of the first cut are
    numbered first; all terminals are among them.
    """
    n = len(a_end)
    over = np.searchsorted(b_end, a_end)
    successor = np.concatenate([np.where(b_end[over] > a_end, n + over, np.arange(n)), np.searchsorted(a_end, b_end)]) if n else np.zeros(0, np.int64)
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            return successor[:n], successor[n:]
        successor = doubled


class Units:
    """Distinct units of a block, encoded by both tokenizers and aligned."""

    def __init__(self, texts: list[str], merges: Merges, other: Pieces) -> None:
        """``texts``: units without the space before them. A part of them at a time is encoded, which bounds memory."""
        parts = [_Part(texts[i:i + UNITS_AT_ONCE], merges, other) for i in range(0, max(len(texts), 1), UNITS_AT_ONCE)]
        joined = lambda name: np.concatenate([getattr(p, name) for p in parts])
        self.good, self.n_a, self.n_b, self.n_groups, self.n_pairs, self.times = map(joined, ("good", "n_a", "n_b", "n_groups", "n_pairs", "times"))
        self.named = [x for p in parts for x in p.named]
        self.pairs, self.pair_of = np.unique(joined("pair"), return_inverse=True)
        self.n_links = sums(self.times, self.n_pairs)


class _Part:
    """Figures of some units; ``pair`` and ``times`` list each unit's distinct linked pairs and how often it has each."""

    def __init__(self, texts: list[str], merges: Merges, other: Pieces) -> None:
        spaced = [" " + t for t in texts]
        a, n_a = _byte_level(spaced, merges)
        b, n_b = other.encode(texts)
        a_size, b_size = merges.sizes[a], other.sizes[b]
        self.good = self._whole(spaced, b, sums(a_size, n_a), sums(b_size, n_b), other)
        keep_a, keep_b = np.repeat(self.good, n_a), np.repeat(self.good, n_b)
        a, b, a_end, b_end = a[keep_a], b[keep_b], np.cumsum(a_size[keep_a]), np.cumsum(b_size[keep_b])
        self.n_a, self.n_b = np.where(self.good, n_a, 0), np.where(self.good, n_b, 0)
        a_last, b_last = terminals(a_end, b_end)
        ends, group_a = np.unique(a_last, return_inverse=True)  # terminals in the order of the text
        group_b = np.searchsorted(ends, b_last)
        group_unit = np.repeat(np.arange(len(texts)), self.n_a)[ends]
        self.n_groups = np.bincount(group_unit, minlength=len(texts))
        named = _group_names(merges, a, b, np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends)))
        cut = np.append(0, np.cumsum(self.n_groups)).tolist()
        self.named = [";".join(named[x:y]) for x, y in zip(cut, cut[1:], strict=False)]
        self._pair(a, b, group_a, group_b, group_unit)

    @staticmethod
    def _whole(spaced: list[str], b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray, other: Pieces) -> np.ndarray:
        """Whether both tokenizers give a unit back byte by byte. Byte-level tokens of the right length always do."""
        want = [t.encode() for t in spaced]
        size = np.fromiter(map(len, want), np.int64, len(want))
        like = (size == b_size) & (size == a_size)
        table = other.bytes_of
        text = np.frombuffer(b"".join(want), np.uint8)[np.repeat(like, size)]
        back = np.frombuffer(b"".join([table[i] for i in b.tolist()]), np.uint8)[np.repeat(like, b_size)]
        return like & (sums(text != back, np.where(like, size, 0)) == 0)

    def _pair(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, group_unit: np.ndarray) -> None:
        """Within a group ids are counted before they are paired."""
        a_key, a_n = np.unique(group_a << 32 | a, return_counts=True)
        b_key, b_n = np.unique(group_b << 32 | b, return_counts=True)
        a_of, b_many = a_key >> 32, np.bincount(b_key >> 32, minlength=len(group_unit))
        left = np.repeat(np.arange(len(a_key)), b_many[a_of])
        right = expand(starts_of(b_many)[a_of], b_many[a_of])
        pairs, code = np.unique((a_key[left] & 0xFFFFFFFF) << 20 | (b_key[right] & 0xFFFFFFFF), return_inverse=True)
        key, at = np.unique(group_unit[a_of[left]] * max(len(pairs), 1) + code, return_inverse=True)
        self.times = np.bincount(at, weights=a_n[left] * b_n[right], minlength=len(key)).astype(np.int64)
        self.pair = pairs[key % max(len(pairs), 1)]
        self.n_pairs = np.bincount(key // max(len(pairs), 1), minlength=len(self.n_a))


def _byte_level(spaced: list[str], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of units and how many each has. A unit of letters is one part for the pre-tokenizer."""
    parts, n = [], np.ones(len(spaced), np.int64)
    for i, t in enumerate(spaced):
        if t[1:].isalpha():
            parts.append(t)
        else:
            found = merges.split.findall(t)
            parts += found
            n[i] = len(found)
    codes, distinct = factor(parts)
    flat, counts = merges.merge([w.encode() for w in distinct])
    size = counts[codes]
    return flat[expand(starts_of(counts)[codes], size)], sums(size, n)


def _group_names(merges: Merges, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> list[str]:
    """Each group as text; groups of one token of either kind, most of them, share one string for each pair."""
    a_at, b_at = starts_of(in_a), starts_of(in_b)
    names = np.empty(len(in_a), object)
    single = (in_a == 1) & (in_b == 1)
    codes, which = np.unique(a[a_at[single]] << 20 | b[b_at[single]], return_inverse=True)
    shared = np.empty(len(codes), object)
    shared[:] = [f"{c >> 20}|{c & 0xFFFFF}" for c in codes.tolist()]
    names[single] = shared[which]
    rest = np.flatnonzero(~single)
    texts = merges.texts
    names[rest] = [",".join([texts[x] for x in a[i:i + p].tolist()]) + "|" + ",".join(map(str, b[j:j + q].tolist()))
                   for i, p, j, q in zip(a_at[rest].tolist(), in_a[rest].tolist(), b_at[rest].tolist(), in_b[rest].tolist(), strict=True)]
    return names.tolist()


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums over runs of the given lengths."""
    total = np.append(0, np.cumsum(values))
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


_LOADED: dict[tuple[str, str], tuple[Merges, Pieces]] = {}


def coders(first: str, second: str) -> tuple[Merges, Pieces]:
    """This worker's tokenizers."""
    if (first, second) not in _LOADED:
        _LOADED.clear()
        _LOADED[first, second] = Merges(first), Pieces(second)
    return _LOADED[first, second]


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def distinct_sorted(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return x[new]


def split_units(texts: pa.Array, splits: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """The order in which texts are taken, the number of units of each, all units as numbers, and the distinct units.

    Where every space is a border, texts are split as they are; the others one by one. Empty texts have no unit.
    """
    even = np.asarray(pc.and_(pc.greater(pc.binary_length(texts), 0), pc.invert(pc.match_substring_regex(texts, UNEVEN)))) & splits
    plain, rest = np.flatnonzero(even), np.flatnonzero(~even)
    lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
    parts = [(BORDER.split(t) if splits else [t]) if t else [] for t in texts.take(pa.array(rest)).to_pylist()]
    n = np.concatenate([np.asarray(pc.list_value_length(lists)), np.fromiter(map(len, parts), np.int64, len(parts))]).astype(np.int64)
    flat = pa.concat_arrays([pc.list_flatten(lists).cast(pa.large_string()), pa.array([u for p in parts for u in p], pa.large_string())])
    coded = flat.dictionary_encode()
    return np.concatenate([plain, rest]), n, coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def aligned_blocks(docs: DataFrame, first: str, second: str, keep_groups: bool) -> DataFrame:
    """Blocks of whole documents as a bucketed table: figures and groups per document, its units as numbers,
    each unit's pairs, and the block's distinct pairs with the number of its documents that hold each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, other = coders(first, second)
        for batch in pieces(batches, "text", BLOCK_BYTES):
            taken, n, codes, distinct = split_units(batch.column("text"), other.splits)
            units = Units(distinct, merges, other)
            good = sums(~units.good[codes], n) == 0
            codes, n = codes[np.repeat(good, n)], np.where(good, n, 0)
            cut = np.append(0, np.cumsum(n)).tolist()
            named = (";".join([units.named[c] for c in codes[x:y].tolist()]) for x, y in zip(cut, cut[1:], strict=False))
            if keep_groups:
                named = list(named)
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in named]
            used = distinct_sorted(np.repeat(np.arange(len(n)), n) * max(len(distinct), 1) + codes)
            doc, unit = used // max(len(distinct), 1), used % max(len(distinct), 1)
            held = units.pair_of[expand(starts_of(units.n_pairs)[unit], units.n_pairs[unit])]
            held = distinct_sorted(held * max(len(n), 1) + np.repeat(doc, units.n_pairs[unit])) // max(len(n), 1)
            in_docs = np.bincount(held, minlength=len(units.pairs))
            lists = [batch.column("id").take(pa.array(taken)).to_pylist(), *[sums(x[codes], n) for x in (units.n_a, units.n_b, units.n_groups, units.n_links)]]
            cells = [n.astype(np.int32), codes.astype(np.int32), units.n_pairs.astype(np.int32), units.pair_of.astype(np.int32), units.times, units.pairs, in_docs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block_ids(1)), *[pa.array([x], pa.list_(pa.int64())) for x in lists],
                 pa.array([digests], pa.list_(pa.string())),
                 pa.array([named if keep_groups else None], pa.list_(pa.string())), *[pa.array([pressed(x)], pa.binary()) for x in cells]],
                names=[f.split()[0] for f in schema.split(", ")])

    schema = ("block long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, sha array<string>, groups array<string>, "
              "n binary, codes binary, n_pairs binary, pair_of binary, times binary, pairs binary, in_docs binary")
    return bucketed(docs.mapInArrow(run, schema), max(1, docs.rdd.getNumPartitions()), "alignment-blocks")


def block_pairs(blocks: DataFrame) -> DataFrame:
    """(block, pos, a, b, n): each block's distinct pairs and the number of its documents that hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pairs, n = (restored(batch.column(c)[i].as_py(), np.int64) for c in ("pairs", "in_docs"))
                held = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(held), batch.column("block")[i].as_py(), np.int64)), pa.array(held.astype(np.int32)),
                     pa.array((pairs[held] >> 20).astype(np.int32)), pa.array((pairs[held] & 0xFFFFF).astype(np.int32)), pa.array(n[held])], ["block", "pos", "a", "b", "n"])

    return blocks.select("block", "pairs", "in_docs").mapInArrow(run, "block long, pos int, a int, b int, n long")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, n_docs, best): how many documents hold each linked pair, and whether no other pair of that a is held by more."""
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("n_docs"))
    highest = counts.groupBy("a").agg(F.max("n_docs").alias("highest"))
    return lookup_join(counts, highest, ["a"], "inner").select("a", "b", "n_docs", (F.col("n_docs") == F.col("highest")).alias("best"))


def align(docs: DataFrame, first: str | None = None, second: str | None = None, id_col: str = "doc_id", text_col: str = "text",
          keep_groups: bool = False) -> DataFrame:
    """Per row: tokens of both kinds, groups, links, links of the highest count, sum of counts, digest of the groups.

    A is a byte-level BPE file of space + text, B a sentencepiece model of the text, which adds the space;
    special tokens' strings are plain text. Groups are cut where tokens of both kinds end. All pairs of an A and a B
    token of one group are links; a pair of ids counts the documents that hold it linked. Null and empty
    texts, and texts that either tokenizer does not give back byte by byte, have no tokens: zeros and
    an empty digest. Repeated rows are documents of their own, ids may be null; an empty table gives an empty
    result. With ``keep_groups``, ``groups`` has the groups as text (``a1,a2|b1;a3|b2,b3``).

    Equal units of a block are encoded and aligned once (``Units``). Pair counts go back to the
    blocks by a join, once per block and pair.
    """
    blocks = aligned_blocks(narrow(docs, id_col, text_col), first or default_tokenizer(), second or default_pieces(), keep_groups)
    pairs = stage(block_pairs(blocks), "alignment-pairs")
    counts = stage(pair_counts(pairs), "alignment-counts")
    facts = lookup_join(pairs.select("block", "pos", "a", "b"), counts, ["a", "b"], "inner")
    facts = facts.groupBy("block").agg(F.collect_list("pos").alias("pos"), F.collect_list("n_docs").alias("count"), F.collect_list("best").alias("best"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cell = {c: batch.column(c)[i].as_py() for c in ("n", "codes", "n_pairs", "pair_of", "times", "pairs")}
                n, codes, n_pairs, pair_of = (restored(cell[c], np.int32) for c in ("n", "codes", "n_pairs", "pair_of"))
                times, size = restored(cell["times"], np.int64), len(restored(cell["pairs"], np.int64))
                pos = np.asarray(batch.column("pos")[i].values if batch.column("pos")[i].is_valid else [], np.int64)
                count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
                if len(pos):
                    count[pos] = np.asarray(batch.column("count")[i].values)
                    best[pos] = np.asarray(batch.column("best")[i].values.cast(pa.int64()))
                figures = [sums(sums(times * x[pair_of], n_pairs)[codes], n) for x in (best, count)]
                lists = [batch.column(c)[i].values for c in ("ids", "n_a", "n_b", "n_groups", "n_links")]
                cols = [*lists, *[pa.array(x) for x in figures], batch.column("sha")[i].values]
                names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
                if keep_groups:
                    cols.append(batch.column("groups")[i].values)
                    names.append("groups")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string" + (", groups string" if keep_groups else "")
    return blocks.drop("in_docs").join(facts, "block", "left").mapInArrow(run, schema)
