"""Removal of long repeated word sequences, level by level over windows of doubling length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windward.llm.blockkeys import KEY_FIELDS, answer, bits, distinct_keys, pressed, restored, shared_keys
from windward.llm.common import block_ids, bucketed, expand, factor_bytes, mix, narrow, pieces, starts_of
from windward.session import stage

WINDOW = 35
SHORTEST = 9
BLOCK_BYTES = 6_000_000
ROWS_AT_ONCE = 1 << 16
_ODD = np.uint64(0xD6E8FEB86659FD93)


def level_lengths(window: int, shortest: int) -> list[int]:
    """Window lengths of the levels: halves (rounded up) of ``window`` down to ``shortest``, in rising order."""
    out = [window]
    while out[0] > 1 and -(-out[0] // 2) >= shortest:
        out.insert(0, -(-out[0] // 2))
    return out


def grow(hashes: np.ndarray, size: int, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` from those of ``size``: two windows make one of up to twice the length."""
    while size < length:
        step = min(size, length - size)
        hashes = mix(hashes[:-step] * _ODD + hashes[step:]) if len(hashes) > step else hashes[:0]
        size += step
    return hashes


def least_inside(hashes: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """For each place, the leftmost of the smallest hashes among the ``width`` that start there."""
    if width == 1 or not len(at):
        return at
    view, out = sliding_window_view(hashes, width), np.empty(len(at), np.int64)
    for i in range(0, len(at), ROWS_AT_ONCE):
        part = at[i:i + ROWS_AT_ONCE]
        out[i:i + ROWS_AT_ONCE] = part + view[part].argmin(axis=1)
    return out


class Words:
    """The words of a block of documents as numbers, with the distinct words' bytes."""

    def __init__(self, codes: np.ndarray, distinct: list[bytes], n: np.ndarray) -> None:
        self.codes, self.distinct, self.n, self.first = codes, distinct, n, starts_of(n)
        halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, distinct)), np.uint64).reshape(-1, 2)
        self.lanes = (halves[:, 0].copy(), halves[:, 1].copy())

    @staticmethod
    def split(texts: list[bytes]) -> Words:
        parts = [t.split() for t in texts]  # on bytes these are exactly the blanks \x20 and \x09 to \x0D
        n = np.fromiter(map(len, parts), np.int64, len(parts))
        codes, distinct = factor_bytes([w for p in parts for w in p])
        return Words(codes, distinct, n)

    def packed(self) -> tuple[bytes, bytes]:
        return pressed(self.codes.astype(np.int32)), zstandard.compress(b" ".join(self.distinct), 1)

    @staticmethod
    def restore(codes: bytes, distinct: bytes, n: np.ndarray) -> Words:
        return Words(restored(codes, np.int32), zstandard.decompress(distinct).split(), n)

    def hashes(self, lane: int, lengths: list[int]) -> np.ndarray:
        """Hashes of all windows of the last length, grown through the lengths before."""
        h, size = self.lanes[lane][self.codes], 1
        for length in lengths:
            h, size = grow(h, size, length), length
        return h

    def starts(self, window: int) -> np.ndarray:
        """Places where a window inside one document starts."""
        fit = np.maximum(self.n - window + 1, 0)
        return expand(self.first, fit)

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """128-bit digests of the documents' word sequences."""
        out = []
        for lane in self.lanes:
            h = np.ascontiguousarray(lane[self.codes])
            ends = self.first + self.n
            out.append(np.array([xxhash.xxh3_64_intdigest(h[a:e].data) for a, e in zip(self.first, ends, strict=True)], np.uint64))
        return mix(out[0]), out[1]


def level_keys(words: Words, at: np.ndarray, lengths: list[int], window: int) -> dict[str, bytes]:
    """Keys of the next level for the windows that start at ``at``.

    Below the last level a window is stood for by its part of the level's length with the
    smallest hash, which depends on its words only, so equal windows have equal keys, and
    neighbouring windows mostly share theirs. At the last level the key is the window's own, of 128 bits.
    """
    h = words.hashes(0, lengths)
    place = least_inside(h, at, window - lengths[-1] + 1)
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    own = place[new]
    last = lengths[-1] == window
    lo = words.hashes(1, lengths)[own] if last else np.zeros(len(own), np.uint64)
    hi, lo, _, count, which = distinct_keys(h[own] if last else mix(h[own]), lo)  # minima are small numbers; spread them again
    return {"at": pressed(np.diff(at, prepend=0).astype(np.int32)), "which": pressed(which[np.cumsum(new) - 1].astype(np.int32)),
            "hi": hi.tobytes(), "lo": lo.tobytes(), "twice": bits(count > 1)}


_LEVEL = "at binary, which binary, " + KEY_FIELDS
_BLOCK = "block long, ids array<long>, n array<long>, codes binary, words binary"


def _cells(fields: dict[str, bytes]) -> list[pa.Array]:
    return [pa.array([x], pa.binary()) for x in fields.values()]


def word_blocks(docs: DataFrame, window: int, lengths: list[int]) -> DataFrame:
    """Blocks of whole documents as a bucketed table: their words, the digests of whole documents, and the first level's keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BLOCK_BYTES):
            words = Words.split([t.encode() for t in batch.column("text").to_pylist()])
            hi, lo = words.whole()
            long = np.flatnonzero(words.n >= window)
            hi, lo, _, count, which = distinct_keys(hi[long], lo[long])
            copies = {"doc_which": pressed(which.astype(np.int32)), "doc_hi": hi.tobytes(), "doc_lo": lo.tobytes(), "doc_twice": bits(count > 1)}
            codes, distinct = words.packed()
            yield pa.RecordBatch.from_arrays(
                [pa.array(block_ids(1)), pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())), pa.array([words.n], pa.list_(pa.int64())),
                 pa.array([codes], pa.binary()), pa.array([distinct], pa.binary()), *_cells(copies),
                 *_cells(level_keys(words, words.starts(window), lengths[:1], window))],
                names=[f.split()[0] for f in schema.split(", ")])

    schema = f"{_BLOCK}, doc_which binary, doc_hi binary, doc_lo binary, doc_twice binary, {_LEVEL}"
    return bucketed(docs.mapInArrow(run, schema), max(1, docs.rdd.getNumPartitions()), "word-blocks")


def _words(batch: pa.RecordBatch, i: int) -> Words:
    return Words.restore(batch.column("codes")[i].as_py(), batch.column("words")[i].as_py(), np.array(batch.column("n")[i].as_py(), np.int64))


def _survivors(batch: pa.RecordBatch, i: int) -> np.ndarray:
    """Starts of the windows whose key of the level before occurs elsewhere."""
    at = np.cumsum(restored(batch.column("at")[i].as_py(), np.int32), dtype=np.int64)
    which = restored(batch.column("which")[i].as_py(), np.int32)
    return at[answer(batch.column("found")[i].as_py(), "again")[which]] if len(at) else at


def _copies(batch: pa.RecordBatch, i: int, n: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that another one equals word by word, and those of them that are not the first."""
    long = np.flatnonzero(n >= window)
    which = restored(batch.column("doc_which")[i].as_py(), np.int32)
    copied, later = np.zeros(len(n), bool), np.zeros(len(n), bool)
    if len(long):
        copied[long] = answer(batch.column("copies")[i].as_py(), "again")[which]
        lead = np.zeros(len(which), bool)
        lead[np.unique(which, return_index=True)[1]] = True
        later[long] = ~(lead & answer(batch.column("copies")[i].as_py(), "first")[which])
    return copied, later


def _next_level(rows: DataFrame, lengths: list[int], window: int) -> DataFrame:
    """(block, keys) of the next level, for the windows that survive; a later copy of a document has none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, at = _words(batch, i), _survivors(batch, i)
                _, later = _copies(batch, i, words.n, window)
                at = at[~later[np.searchsorted(words.first, at, "right") - 1]]
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), *_cells(level_keys(words, at, lengths, window))],
                                                 ["block", "at", "which", "hi", "lo", "twice"])

    return rows.mapInArrow(run, f"block long, {_LEVEL}")


def remove_windows(docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST, id_col: str = "doc_id", text_col: str = "text",
                   keep_text: bool = False) -> DataFrame:
    """Per row: words, words removed, and a digest of the words that are left, joined by one space.

    Words are what stands between blanks (\\x20 and \\x09 to \\x0D), unchanged. A word is removed if a
    window of ``window`` words over it also starts at another place of any row, the same
    row included, whatever is removed elsewhere. Null and shorter texts lose nothing; no
    window spans two rows. Rows that repeat id and text are rows of their own and so remove
    each other. An empty table gives an empty result. With ``keep_text``, ``text`` has the words left.

    Windows grow level by level to twice their length (9, 18, 35 words): what occurs once at
    one length is not extended to the next, and the levels end when none is left. Below
    the last level a window is asked for by its smallest-hashed part of that length, so few
    parts are compared. Documents with equal words are compared as one.
    """
    lengths = level_lengths(window, shortest)
    blocks = word_blocks(narrow(docs, id_col, text_col), window, lengths)
    copies = shared_keys(blocks.select("block", F.col("doc_hi").alias("hi"), F.col("doc_lo").alias("lo"), F.col("doc_twice").alias("twice")))
    texts = blocks.select("block", "ids", "n", "codes", "words", "doc_which")
    copies = stage(copies.withColumnRenamed("answer", "copies"), "window-copies")
    level = blocks.select("block", "at", "which", "hi", "lo", "twice")
    for k in range(1, len(lengths) + 1):
        found = level.select("block", "at", "which").join(shared_keys(level).withColumnRenamed("answer", "found"), "block", "left")
        rows = texts.join(copies, "block", "left").join(found, "block")
        if k == len(lengths):
            break
        level = stage(_next_level(rows, lengths[:k + 1], window), f"window-level{k}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, at = _words(batch, i), _survivors(batch, i)
                change = np.zeros(len(words.codes) + 1, np.int64)
                change[at] += 1
                change[at + window] -= 1
                copied, _ = _copies(batch, i, words.n, window)
                gone = (np.cumsum(change[:-1]) > 0) | np.repeat(copied, words.n)
                n_removed, kept = [], []
                for a, n in zip(words.first.tolist(), words.n.tolist(), strict=True):
                    left = words.codes[a:a + n][~gone[a:a + n]]
                    n_removed.append(n - len(left))
                    kept.append(b" ".join([words.distinct[c] for c in left.tolist()]))
                cols = [batch.column("ids")[i].values, pa.array(words.n), pa.array(n_removed, pa.int64()),
                        pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if keep_text:
                    cols.append(pa.array([k.decode() for k in kept], pa.string()))
                    names.append("text")
                yield pa.RecordBatch.from_arrays(cols, names)

    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", text string" if keep_text else ""))
