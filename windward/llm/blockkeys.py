"""Which keys of a block of documents occur elsewhere: keys of all blocks merged by ranges of their value."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS_PER_SHARD = 500_000
KEY_FIELDS = "hi binary, lo binary, twice binary"


def bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def flags(x: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool)


def pressed(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 1)


def restored(x: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), dtype)


def distinct_keys(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct 128-bit keys as two halves, the first place and the number of each, and each place's key."""
    order = np.lexsort((lo, hi))
    a, b = hi[order], lo[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    which = np.zeros(len(a), np.int64)
    which[order] = np.cumsum(new) - 1
    first = np.minimum.reduceat(order, at) if len(at) else at
    return a[at], b[at], first, np.diff(np.append(at, len(a))), which


def shared_keys(blocks: DataFrame) -> DataFrame:
    """(block, answer): which keys of each block another place has, and whether the block is the first with them.

    ``blocks``: block, and its sorted distinct keys in two halves of 64 bits (hi, lo, both evenly
    spread), with bits for those it has more than once. A key is sent once per block,
    however frequent it is, in pieces of a range of its value; a task merges one range, which
    holds about ``KEYS_PER_SHARD`` keys. Read the answers with ``answer``.
    """
    total = blocks.agg(F.sum(F.octet_length("hi"))).first()[0] or 0
    shards = max(1, -(-total // (8 * KEYS_PER_SHARD)))
    edges = (np.arange(1, shards, dtype=np.float64) * (2.0**64 / shards)).astype(np.uint64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                hi, lo = (np.frombuffer(batch.column(c)[i].as_py(), np.uint64) for c in ("hi", "lo"))
                twice = flags(batch.column("twice")[i].as_py(), len(hi))
                ends = np.concatenate([[0], np.searchsorted(hi, edges), [len(hi)]])
                some = np.flatnonzero(np.diff(ends))
                spans = [slice(ends[s], ends[s + 1]) for s in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), batch.column("block")[i].as_py(), np.int64)),
                     pa.array([hi[s].tobytes() for s in spans], pa.binary()), pa.array([lo[s].tobytes() for s in spans], pa.binary()),
                     pa.array([bits(twice[s]) for s in spans], pa.binary())], ["shard", "block", "hi", "lo", "twice"])

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        hi, lo = (np.frombuffer(b"".join(group.column(c).to_pylist()), np.uint64) for c in ("hi", "lo"))
        n = np.fromiter((len(x) // 8 for x in group.column("hi").to_pylist()), np.int64, group.num_rows)
        twice = np.concatenate([flags(x, k) for x, k in zip(group.column("twice").to_pylist(), n, strict=True)])
        _, _, first, count, which = distinct_keys(hi, lo)
        again = count > 1
        again[which[twice]] = True
        leads = np.zeros(len(which), bool)
        leads[first] = True  # blocks are in order, so the first holder is the smallest
        ends = np.cumsum(n)
        cols = {k: pa.array([bits(v[e - m:e]) for e, m in zip(ends, n, strict=True)], pa.binary()) for k, v in (("again", again[which]), ("first", leads))}
        return pa.table({"shard": group.column("shard"), "block": group.column("block"), "n": n} | cols)

    sent = blocks.select("block", "hi", "lo", "twice").mapInArrow(cut, "shard int, block long, " + KEY_FIELDS)
    # As many tasks as shards: adaptive execution would put shards together, and they are large already.
    found = sent.repartition(2 * shards, "shard").groupBy("shard").applyInArrow(merge, "shard int, block long, n long, again binary, first binary")
    return found.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("shard", "n", "again", "first"))).alias("answer"))


def answer(row: list | None, what: str) -> np.ndarray:
    """One bit for each key of a block, in the keys' order."""
    return np.concatenate([np.zeros(0, bool), *[flags(p[what], p["n"]) for p in row or []]])
