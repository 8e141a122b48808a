"""Exact removal of long repeated byte strings, by merging the suffix classes of text blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windward.llm.common import block_ids, bucketed, expand, mix, narrow, pieces, starts_of
from windward.session import stage

LENGTH = 200
GRAM = 100
BLOCK_BYTES = 4_000_000
STRETCH = 1_000_000  # bytes whose hashes are held at once
KEYS_PER_SHARD = 1_000_000
_PLACE = 23  # low bits of a ranked gram that hold its place in a stretch
_FACTOR = 0xD6E8FEB86659FD93
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))  # a random number for each byte


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse modulo 2**64."""
    out = []
    for f in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
        p = np.full(n, f, np.uint64)
        p[:1] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Text:
    """The bytes of a block, with hashes of any of their stretches."""

    def __init__(self, data: bytes, lengths: np.ndarray) -> None:
        self.data, self.lengths, self.first = np.frombuffer(data, np.uint8), lengths, starts_of(lengths)

    def prefixes(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums over the bytes from start to stop; what turns a difference of two into a hash."""
        power, inverse = _powers(stop - start + 1)
        sums = np.zeros(stop - start + 1, np.uint64)
        np.cumsum(_BYTE[self.data[start:stop]] * power[:-1], out=sums[1:])
        return sums, inverse

    def hashes(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Hashes of the byte strings that start at sorted places ``at``."""
        out = np.zeros(len(at), np.uint64)
        i = 0
        while i < len(at):
            j = int(np.searchsorted(at, at[i] + STRETCH))
            base, end = int(at[i]), int((at[i:j] + length[i:j]).max())
            sums, inverse = self.prefixes(base, end)
            a = at[i:j] - base
            out[i:j] = mix((sums[a + length[i:j]] - sums[a]) * inverse[a] + length[i:j].astype(np.uint64))
            i = j
        return out

    def classes(self, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of suffixes with one minimal gram: first place, number, hash of the gram.

        Every string of ``length`` bytes belongs to the smallest-hashed gram inside it,
        which depends on its bytes only; neighbouring strings mostly share it.
        """
        window = length - gram + 1
        starts, counts, grams = [], [], []
        for first, n in zip(self.first.tolist(), self.lengths.tolist(), strict=True):
            # Long documents in stretches; short ones are done together below.
            if n >= STRETCH:
                for s in range(first, first + n - length + 1, STRETCH):
                    self._runs(s, min(s + STRETCH, first + n - length + 1), None, length, gram, window, starts, counts, grams)
        small = np.flatnonzero((self.lengths >= length) & (self.lengths < STRETCH))
        i = 0
        while i < len(small):
            j = i + 1
            while j < len(small) and self.first[small[j]] + self.lengths[small[j]] - self.first[small[i]] <= STRETCH:
                j += 1
            docs = small[i:j]
            last = int(self.first[docs[-1]] + self.lengths[docs[-1]])
            self._runs(int(self.first[docs[0]]), last - length + 1, docs, length, gram, window, starts, counts, grams)
            i = j
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        start, count, key = np.concatenate(starts), np.concatenate(counts), np.concatenate(grams)
        order = np.argsort(start, kind="stable")
        return start[order], count[order], key[order]

    def _runs(self, start: int, stop: int, docs: np.ndarray | None, length: int, gram: int, window: int,
              starts: list, counts: list, grams: list) -> None:
        """Runs among the strings that start at start .. stop - 1; with ``docs``, only those inside one of them."""
        sums, inverse = self.prefixes(start, stop + length - 1)
        n = stop - start + window - 1
        hashed = mix((sums[gram:gram + n] - sums[:n]) * inverse[:n])
        # Of grams alike in the high bits the leftmost is smaller, wherever the string stands.
        ranked = hashed >> np.uint64(_PLACE) << np.uint64(_PLACE) | np.arange(n, dtype=np.uint64)
        # Sliding minimum: running minima from both ends of stretches as long as the window.
        padded = np.full(-(-n // window) * window, 2**64 - 1, np.uint64)
        padded[:n] = ranked
        rows = padded.reshape(-1, window)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(back[:stop - start], ahead[window - 1:window - 1 + stop - start])
        cut = np.ones(len(least) + 1, bool)
        cut[1:-1] = least[1:] != least[:-1]
        if docs is not None:
            inside = np.zeros(len(least) + 1, np.int8)
            np.add.at(inside, self.first[docs] - start, 1)
            np.add.at(inside, self.first[docs] + self.lengths[docs] - length + 1 - start, -1)
            inside = np.cumsum(inside[:-1]) > 0
            cut[self.first[docs] - start] = True
            cut[self.first[docs] + self.lengths[docs] - length + 1 - start] = True
        at = np.flatnonzero(cut)
        first, count = at[:-1], np.diff(at)
        if docs is not None:
            first, count = first[inside[first]], count[inside[first]]
        starts.append(first + start)
        counts.append(count)
        grams.append(mix(hashed[least[first] & np.uint64(2**_PLACE - 1)]))  # minima are small numbers; spread them again


def _bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def _flags(x: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool)


def _pressed(x: np.ndarray) -> bytes:
    return zstandard.compress(x.tobytes(), 3)


def _restored(x: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), dtype)


def text_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of whole documents as a bucketed table: their bytes, suffix classes and distinct grams.

    Everything later is brought to a block's bucket; the texts never move again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BLOCK_BYTES):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            data = b"".join(texts)
            start, count, gram = Text(data, lengths).classes(LENGTH, GRAM)
            keys, which, n = np.unique(gram, return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block_ids(1)), pa.array([zstandard.compress(data, 3)], pa.binary()), pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([lengths], pa.list_(pa.int64())), pa.array([_pressed(np.diff(start, prepend=0).astype(np.int64))], pa.binary()),
                 pa.array([_pressed(count.astype(np.int64))], pa.binary()), pa.array([_pressed(which.astype(np.int32))], pa.binary()),
                 pa.array([keys.tobytes()], pa.binary()), pa.array([_bits(n > 1)], pa.binary())],
                ["block", "blob", "ids", "lengths", "start", "count", "which", "keys", "flags"])

    schema = "block long, blob binary, ids array<long>, lengths array<long>, start binary, count binary, which binary, keys binary, flags binary"
    return bucketed(docs.mapInArrow(run, schema), max(1, docs.rdd.getNumPartitions()), "substring-blocks")


def merge_classes(blocks: DataFrame) -> DataFrame:
    """(block, n, twice, flagged, first) as bits: one round of refinement of the blocks' interleave.

    ``blocks``: block, keys (sorted distinct 64-bit classes of its suffixes), flags. The
    classes are cut by their value into shards; a shard sees each block's sorted piece of
    the series and merges the pieces. For each class of a block it answers whether
    another block has it, whether any block flagged it, and whether this block is the first that has it.
    A class is there once per block, however frequent it is, and classes are even
    by their hash, so no shard holds more than its share.
    """
    total = blocks.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    shards = max(1, -(-total // (8 * KEYS_PER_SHARD)))
    edges = (np.arange(1, shards, dtype=np.float64) * (2.0**64 / shards)).astype(np.uint64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys = np.frombuffer(batch.column("keys")[i].as_py(), np.uint64)
                flags = _flags(batch.column("flags")[i].as_py(), len(keys))
                ends = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
                some = np.flatnonzero(np.diff(ends))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), batch.column("block")[i].as_py(), np.int64)),
                     pa.array([keys[ends[s]:ends[s + 1]].tobytes() for s in some], pa.binary()),
                     pa.array([_bits(flags[ends[s]:ends[s + 1]]) for s in some], pa.binary())], ["shard", "block", "keys", "flags"])

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        parts = [np.frombuffer(x, np.uint64) for x in group.column("keys").to_pylist()]
        flags = [_flags(x, len(p)) for x, p in zip(group.column("flags").to_pylist(), parts, strict=True)]
        n = np.fromiter(map(len, parts), np.int64, len(parts))
        distinct, first, which, count = np.unique(np.concatenate(parts), return_index=True, return_inverse=True, return_counts=True)
        flagged = np.zeros(len(distinct), bool)
        flagged[which[np.concatenate(flags)]] = True
        leads = np.zeros(len(which), bool)
        leads[first] = True  # blocks are in order, so the first holder is the smallest
        answers = {"twice": count[which] > 1, "flagged": flagged[which], "first": leads}
        ends = np.cumsum(n)
        cols = {k: [_bits(v[e - m:e]) for e, m in zip(ends, n, strict=True)] for k, v in answers.items()}
        return pa.table({"shard": group.column("shard"), "block": group.column("block"), "n": n} | {k: pa.array(v, pa.binary()) for k, v in cols.items()})

    sent = blocks.select("block", "keys", "flags").mapInArrow(cut, "shard int, block long, keys binary, flags binary")
    # As many tasks as shards: adaptive execution would put shards together, and they are large already.
    found = sent.repartition(2 * shards, "shard").groupBy("shard").applyInArrow(merge, "shard int, block long, n long, twice binary, flagged binary, first binary")
    return found.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("shard", "n", "twice", "flagged", "first"))).alias("answer"))


def _answer(batch: pa.RecordBatch, column: str, i: int, what: str) -> np.ndarray:
    parts = batch.column(column)[i].as_py() or []
    return np.concatenate([np.zeros(0, bool), *[_flags(p[what], p["n"]) for p in parts]])


def _with(blocks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    return blocks.join(answers.withColumnRenamed("answer", name), "block", "left")


def _repeated_classes(blocks: DataFrame) -> DataFrame:
    """Second table per block: the runs of suffixes whose gram occurs elsewhere, and the hashes of their bytes.

    A run of m suffixes covers ``LENGTH`` + m - 1 bytes; if these occur elsewhere, so do all its strings.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys = np.frombuffer(batch.column("keys")[i].as_py(), np.uint64)
                again = _answer(batch, "grams", i, "twice") | _answer(batch, "grams", i, "flagged")
                which = _restored(batch.column("which")[i].as_py(), np.int32)
                pick = np.flatnonzero(again[which]) if len(which) else np.zeros(0, np.int64)
                start = np.cumsum(_restored(batch.column("start")[i].as_py(), np.int64))[pick]
                count = _restored(batch.column("count")[i].as_py(), np.int64)[pick]
                text = Text(zstandard.decompress(batch.column("blob")[i].as_py()), np.array(batch.column("lengths")[i].as_py(), np.int64))
                hashed = text.hashes(start, count + LENGTH - 1)
                segs, seg, n = np.unique(hashed, return_inverse=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("block").slice(i, 1), pa.array([_pressed(start)], pa.binary()), pa.array([_pressed(count)], pa.binary()),
                     pa.array([keys[which[pick]].tobytes()], pa.binary()), pa.array([_pressed(seg.astype(np.int32))], pa.binary()),
                     pa.array([segs.tobytes()], pa.binary()), pa.array([_bits(n > 1)], pa.binary())],
                    ["block", "start", "count", "gram", "seg", "keys", "flags"])

    grams = _with(blocks, merge_classes(blocks), "grams")
    found = grams.select("block", "blob", "lengths", "start", "count", "which", "keys", "grams").mapInArrow(
        run, "block long, start binary, count binary, gram binary, seg binary, keys binary, flags binary")
    return stage(found, "substring-runs")


def _open_grams(runs: DataFrame) -> DataFrame:
    """Per block the distinct grams of its runs, flagged if one of the runs occurs nowhere else."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                gram = np.frombuffer(batch.column("gram")[i].as_py(), np.uint64)
                seg = _restored(batch.column("seg")[i].as_py(), np.int32)
                done = _answer(batch, "segs", i, "twice") | _answer(batch, "segs", i, "flagged")
                keys, which = np.unique(gram, return_inverse=True)
                flags = np.zeros(len(keys), bool)
                flags[which[~done[seg]] if len(seg) else []] = True
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), pa.array([keys.tobytes()], pa.binary()), pa.array([_bits(flags)], pa.binary())],
                                                 ["block", "keys", "flags"])

    return stage(runs.select("block", "gram", "seg", "segs").mapInArrow(run, "block long, keys binary, flags binary"), "substring-grams")


def _state(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, ...]:
    """Runs of a block: start, count, whether they occur elsewhere as a whole, and whether their strings are compared one by one."""
    start, count = _restored(batch.column("start")[i].as_py(), np.int64), _restored(batch.column("count")[i].as_py(), np.int64)
    seg, gram = _restored(batch.column("seg")[i].as_py(), np.int32), np.frombuffer(batch.column("gram")[i].as_py(), np.uint64)
    if not len(start):
        return start, count, np.zeros(0, bool), np.zeros(0, bool)
    done = (_answer(batch, "segs", i, "twice") | _answer(batch, "segs", i, "flagged"))[seg]
    leads = _answer(batch, "segs", i, "first")[seg]
    once = np.zeros(len(seg), bool)
    once[np.unique(seg, return_index=True)[1]] = True  # one run stands for its equals in the block
    _, which = np.unique(gram, return_inverse=True)
    wanted = _answer(batch, "open", i, "flagged")[which]
    return start, count, done, wanted & (~done | (leads & once))


def _windows(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, ...]:
    start, count, done, alone = _state(batch, i)
    lengths = np.array(batch.column("lengths")[i].as_py(), np.int64)
    data = zstandard.decompress(batch.column("blob")[i].as_py())
    text = Text(data, lengths)
    at = expand(start[alone], count[alone])
    return start, count, done, alone, at, text.hashes(at, np.full(len(at), LENGTH)), text, data


def _single_strings(rows: DataFrame) -> DataFrame:
    """Per block the distinct hashes of the strings that are compared one by one, flagged if it has them twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                hashed = _windows(batch, i)[5]
                keys, n = np.unique(hashed, return_counts=True)
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), pa.array([keys.tobytes()], pa.binary()), pa.array([_bits(n > 1)], pa.binary())],
                                                 ["block", "keys", "flags"])

    return stage(rows.mapInArrow(run, "block long, keys binary, flags binary"), "substring-strings")


def covered(starts: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Bytes inside a string of ``LENGTH`` that starts in one of the runs."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + counts + LENGTH - 1, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Per row: bytes, bytes removed, maximal removed runs and a digest of what is left.

    A byte is removed if a string of ``LENGTH`` bytes over it also starts at another place
    of any row, the same row included. Texts are UTF-8; null and shorter texts lose
    nothing; no string spans two rows. Rows that repeat id and text are rows of their own
    and so remove each other. An empty table gives an empty result. With
    ``keep_text``, ``text`` has the remaining bytes as well (broken characters replaced).

    Suffix classes of all blocks are refined together: by a gram of ``GRAM`` bytes, by
    whole runs of neighbouring suffixes, and, where a run ends or an edit falls into it, by
    single strings of ``LENGTH`` bytes. Suffixes alone in their class leave after each
    round, so the last and finest round sees the edges of repeats only.
    """
    blocks = text_blocks(narrow(docs, id_col, text_col))
    runs = _repeated_classes(blocks)
    runs = stage(_with(runs, merge_classes(runs), "segs").drop("keys", "flags"), "substring-states")
    opened = merge_classes(_open_grams(runs))
    state = stage(_with(runs, opened, "open"), "substring-states")
    rows = blocks.select("block", "blob", "ids", "lengths").join(state, "block")
    strings = _single_strings(rows)
    final = _with(rows, merge_classes(strings), "strings")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, count, done, alone, at, hashed, text, data = _windows(batch, i)
                again = _answer(batch, "strings", i, "twice") | _answer(batch, "strings", i, "flagged")
                single = at[again[np.unique(hashed, return_inverse=True)[1]]] if len(at) else at
                gone = covered(np.concatenate([start[done], single]), np.concatenate([count[done], np.ones(len(single), np.int64)]), len(data))
                n_removed, n_spans, kept = [], [], []
                for a, n in zip(text.first.tolist(), text.lengths.tolist(), strict=True):
                    part = gone[a:a + n]
                    n_removed.append(int(part.sum()))
                    n_spans.append(int(part[:1].sum() + (part[1:] & ~part[:-1]).sum()))
                    kept.append(text.data[a:a + n][~part].tobytes() if n_removed[-1] else data[a:a + n])
                cols = [batch.column("ids")[i].values, pa.array(text.lengths), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                        pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if keep_text:
                    cols.append(pa.array([k.decode("utf-8", "replace") for k in kept], pa.string()))
                    names.append("text")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", text string" if keep_text else "")
    return final.mapInArrow(run, schema)
