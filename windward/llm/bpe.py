"""Byte-level BPE through a memory-mapped minimal acyclic transducer of frequent words."""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windward.llm.common import MIX, expand, factor, narrow, pieces, starts_of
from windward.llm.sharding import before_each
from windward.session import run_dir, settle, stage, staged_so_far

# The pre-tokenizer's pattern, the byte alphabet's printable ranges, Unicode's white space.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [(33, 126), (161, 172), (174, 255)]
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Words without inner white space, with one space before where there is one. The pre-tokenizer
#: never looks across such a word's ends, so each has its ids whatever stands around it.
CHUNK = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")
PIECE_BYTES = 2_500_000
LONG_WORD = 96
NO_RANK = np.int64(1 << 40)


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one from 256 on."""
    own = {b for a, z in PRINTABLE for b in range(a, z + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Slots:
    """Whole numbers >= 0 to their places 0, 1, ...: a hash table probed for many keys at once."""

    def __init__(self, keys: np.ndarray) -> None:
        self.bits = max(4, int(len(keys)).bit_length() + 2)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.places = np.full(1 << self.bits, -1, np.int64)
        left, slot = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self.keys[slot] < 0
            first = np.zeros(len(left), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.places[slot[put]] = keys[left[put]], left[put]
            left, slot = left[~put], (slot[~put] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for those not held."""
        slot = self._home(wanted)
        held = self.keys[slot]
        out = np.where(held == wanted, self.places[slot], -1)
        more = np.flatnonzero((held != wanted) & (held >= 0))
        while len(more):
            slot[more] = (slot[more] + 1) & ((1 << self.bits) - 1)
            held = self.keys[slot[more]]
            same = held == wanted[more]
            out[more[same]] = self.places[slot[more[same]]]
            more = more[~same & (held >= 0)]
        return out


class Merges:
    """Vocabulary and merges of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, chars = spec["model"]["vocab"], byte_alphabet()
        to_byte = {c: b for b, c in enumerate(chars)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(to_byte[c] for c in token)
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.texts = [str(i) for i in range(size)]
        self.sizes = np.fromiter(map(len, self.bytes_of), np.int64, size)
        self.of_byte = np.array([vocab[c] for c in chars], np.int64)
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.slots = Slots(np.array([a << 20 | b for a, b in self.pairs], np.int64))
        ranked = np.array([*self.pairs.values(), (NO_RANK, -1)], np.int64)  # place -1: no such pair
        self.ranks, self.merged = ranked[:, 0].copy(), ranked[:, 1].copy()
        self.split = regex.compile(PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def _long(self, word: bytes) -> list[int]:
        """Merge one long word with a heap of pairs; stale pairs are skipped."""
        ids = self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.pairs.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.pairs[a, b][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := self.pairs.get((ids[left], ids[right]))):
                    heapq.heappush(heap, (r[0], left, ids[left], ids[right]))
        return [i for i in ids if i >= 0]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each word: in every round each word merges its best pair."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        out: list[np.ndarray | None] = [None] * len(words)
        for i in np.flatnonzero(lengths > LONG_WORD):
            out[i] = np.array(self._long(words[i]), np.int64)
        which = np.flatnonzero((lengths <= LONG_WORD) & (lengths > 0))
        ids = self.of_byte[np.frombuffer(b"".join([words[i] for i in which]), np.uint8)]
        n = lengths[which]
        done_ids, done_n, done_which = [], [], []
        while len(which):
            starts = starts_of(n)
            pair = np.zeros(len(ids), np.int64)
            pair[:-1] = ids[:-1] << 20 | ids[1:]
            at = self.slots.find(pair)
            at[starts + n - 1] = -1
            rank = self.ranks[at]
            best = np.minimum.reduceat(rank, starts)
            over = best == NO_RANK
            if over.any():
                gone = np.repeat(over, n)
                done_ids.append(ids[gone])
                done_n.append(n[over])
                done_which.append(which[over])
                keep = ~gone
                ids, rank, at = ids[keep], rank[keep], at[keep]
                which, n, best = which[~over], n[~over], best[~over]
                starts = starts_of(n)
            if not len(which):
                break
            hit = np.flatnonzero(rank == np.repeat(best, n))
            owner = np.searchsorted(starts, hit, "right") - 1
            hit = hit[np.concatenate([[True], owner[1:] != owner[:-1]])]
            ids[hit] = self.merged[at[hit]]
            ids = np.delete(ids, hit + 1)
            n = n - 1
        # Put the finished words back into order.
        counts = np.zeros(len(words), np.int64)
        for i, x in enumerate(out):
            if x is not None:
                done_ids.append(x)
                done_n.append(np.array([len(x)]))
                done_which.append(np.array([i]))
        if not done_ids:
            return np.zeros(0, np.int64), counts
        flat, n, which = np.concatenate(done_ids), np.concatenate(done_n), np.concatenate(done_which)
        counts[which] = n
        order = np.argsort(which, kind="stable")
        return flat[expand(starts_of(n)[order], n[order])], counts

    def chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks: each is split by the pre-tokenizer, and each distinct part merged once."""
        parts, n = [], np.zeros(len(chunks), np.int64)
        for i, c in enumerate(chunks):
            found = self.split.findall(c)
            parts += found
            n[i] = len(found)
        codes, distinct = factor(parts)
        flat, counts = self.merge([w.encode() for w in distinct])
        size = counts[codes]
        whole = np.add.reduceat(np.append(size, 0), starts_of(n)) if len(n) else n
        return flat[expand(starts_of(counts)[codes], size)], np.where(n > 0, whole, 0)


def build_automaton(words: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The minimal acyclic automaton of distinct words, and the order of the words in it.

    States that accept the same endings are one. An arc carries how many words
    pass before it, so the outputs along a path add up to the word's number.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    register: dict[tuple, int] = {}
    done: list[tuple] = []  # per state: final, arcs (label, target)
    path: list[list] = [[False, []]]  # open states of the last word
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(done)
                done.append(key)
            path[-1][1].append((last[len(path) - 1], register[key]))

    for i in order:
        word = words[i]
        same = len(os.path.commonprefix([last, word]))
        close(same)
        last = word
        path += [[False, []] for _ in range(len(word) - same)]
        path[-1][0] = True
    close(0)
    root = len(done)
    done.append((path[0][0], tuple(path[0][1])))
    reach = np.zeros(len(done), np.int64)
    keys, targets, outputs = [], [], []
    for state, (final, arcs) in enumerate(done):  # targets come before their sources
        total = int(final)
        for label, target in arcs:
            keys.append(state << 8 | label)
            targets.append(target)
            outputs.append(total)
            total += reach[target]
        reach[state] = total
    slots = Slots(np.array(keys, np.int64))
    return {"slots": slots.keys, "places": slots.places, "target": np.array(targets, np.int32), "output": np.array(outputs, np.int32),
            "final": np.array([f for f, _ in done], np.uint8), "root": np.array([root], np.int32)}, np.array(order, np.int64)


class Lexicon:
    """The automaton and the ids of its words, mapped from one file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            head = f.readline()
        self.parts = {name: np.memmap(path, dtype, "r", len(head) + at, (n,)) if n else np.zeros(0, dtype)
                      for name, dtype, at, n in json.loads(head)}
        self.slots = Slots.__new__(Slots)
        self.slots.keys, self.slots.places = self.parts["slots"], self.parts["places"]
        self.slots.bits = len(self.parts["slots"]).bit_length() - 1

    @staticmethod
    def pack(parts: dict[str, np.ndarray]) -> bytes:
        head, body = [], b""
        for name, x in parts.items():
            head.append([name, x.dtype.str, len(body), len(x)])
            body += x.tobytes() + b"\0" * (-x.nbytes % 8)
        line = json.dumps(head).encode()
        return line + b" " * (-(len(line) + 1) % 8) + b"\n" + body

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 if unseen; all words walk the automaton side by side."""
        p = self.parts
        n = np.fromiter(map(len, words), np.int64, len(words))
        flat, starts = np.frombuffer(b"".join(words), np.uint8), starts_of(n)
        state, number = np.full(len(words), p["root"][0], np.int64), np.zeros(len(words), np.int64)
        live, step = np.arange(len(words)), 0
        result = np.full(len(words), -1, np.int64)
        while len(live):
            ended = n[live] == step
            stop = live[ended]
            result[stop] = np.where(p["final"][state[stop]] == 1, number[stop], -1)
            live = live[~ended]
            at = self.slots.find(state[live] << 8 | flat[starts[live] + step])
            live, at = live[at >= 0], at[at >= 0]
            number[live] += p["output"][at]
            state[live] = p["target"][at]
            step += 1
        return result


def chunks_of(text: str, merges: Merges) -> list[str]:
    """The chunks of a text; an added token's string is a chunk of its own, also inside a word."""
    if merges.special is None or not merges.special.search(text):
        return CHUNK.findall(text)
    out, at = [], 0
    for m in merges.special.finditer(text):
        out += [*CHUNK.findall(text[at:m.start()]), m.group()]
        at = m.end()
    return out + CHUNK.findall(text[at:])


class Encoder:
    """Encodes batches: lexicon first, merges for what it does not hold."""

    def __init__(self, merges: Merges, lexicon: Lexicon | None) -> None:
        self.merges, self.lexicon = merges, lexicon

    def distinct(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks, one after the other, and how many each has."""
        added = self.merges.added
        number = self.lexicon.numbers([c.encode() for c in chunks]) if self.lexicon else np.full(len(chunks), -1, np.int64)
        for i in [i for i, c in enumerate(chunks) if c in added]:
            number[i] = -2
        counts = np.zeros(len(chunks), np.int64)
        unseen = np.flatnonzero(number == -1)
        flat, n = self.merges.chunk_ids([chunks[i] for i in unseen])
        counts[unseen] = n
        special = np.flatnonzero(number == -2)
        counts[special] = 1
        seen = np.flatnonzero(number >= 0)
        if len(seen):
            first = np.asarray(self.lexicon.parts["first"])
            counts[seen] = first[number[seen] + 1] - first[number[seen]]
        ids, starts = np.zeros(int(counts.sum()), np.int64), starts_of(counts)
        ids[expand(starts[unseen], n)] = flat
        ids[starts[special]] = [added[chunks[i]] for i in special]
        if len(seen):
            ids[expand(starts[seen], counts[seen])] = self.lexicon.parts["ids"][expand(first[number[seen]], counts[seen])]
        return ids, counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        chunks: list[str] = []
        n = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            found = chunks_of(t, self.merges)
            chunks += found
            n[i] = len(found)
        codes, distinct = factor(chunks)
        ids, counts = self.distinct(distinct)
        size = counts[codes]
        total = np.concatenate([[0], np.cumsum(size)])
        ends = np.cumsum(n)
        return ids[expand(starts_of(counts)[codes], size)], total[ends] - total[ends - n]

    def decode(self, ids: list[int]) -> str:
        table = self.merges.bytes_of
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


_LOADED: dict[tuple[str, str | None], Encoder] = {}


def encoder(tokenizer: str, lexicon: str | None) -> Encoder:
    """This worker's encoder; a replaced executor fetches the lexicon file anew."""
    key = (tokenizer, lexicon)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(Merges(tokenizer), Lexicon(SparkFiles.get(lexicon)) if lexicon else None)
    return _LOADED[key]


def word_counts(docs: DataFrame, tokenizer: str, flush: int = 300_000) -> DataFrame:
    """(word, n): how often each chunk occurs, summed in the task before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, counts = encoder(tokenizer, None).merges, Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in pieces(batches, "text", PIECE_BYTES):
            for text in batch.column("text").to_pylist():
                counts.update(chunks_of(text, merges))
            if len(counts) >= flush:
                yield out()
                counts.clear()
        if counts:
            yield out()

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, tokenizer: str, most: int) -> DataFrame:
    """(word): the words that occur at least c times, for the least c >= 2 that leaves at most ``most`` of them."""
    counts = stage(word_counts(docs, tokenizer).filter("n > 1 and length(word) <= 64"), "word-counts")
    by_count = counts.groupBy("n").agg(F.count("*").alias("words"))
    total = counts.count()
    least = before_each(by_count, [], "n", "words", "below").filter(F.lit(total) - F.col("below") <= most).agg(F.min("n")).first()[0]
    return counts.filter(F.col("n") >= F.lit(least).cast("long")).select("word")


def pack_lexicon(words: list[str], merges: Merges) -> bytes:
    """The lexicon file of distinct words."""
    words = [w for w in words if w not in merges.added]
    parts, order = build_automaton([w.encode() for w in words])
    ids, counts = merges.chunk_ids(words)
    parts["ids"] = ids[expand(starts_of(counts)[order], counts[order])].astype(np.int32)
    parts["first"] = np.concatenate([[0], np.cumsum(counts[order])]).astype(np.int64)
    return Lexicon.pack(parts)


def publish_lexicon(words: DataFrame, tokenizer: str) -> str | None:
    """Compile words into a lexicon file in the shared folder and hand it to every executor.

    One task compiles the words, whose number is bounded; the driver sees the file's bytes only.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = [w for batch in batches for w in batch.column("word").to_pylist()]
        if listed:
            yield pa.RecordBatch.from_arrays([pa.array([pack_lexicon(listed, encoder(tokenizer, None).merges)], pa.binary())], ["lexicon"])

    spark = words.sparkSession
    blob = words.coalesce(1).mapInArrow(run, "lexicon binary").first()
    if blob is None:
        return None
    path = run_dir(spark, "lexicon")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(blob.lexicon)
    out.close()
    spark.sparkContext.addFile(path)  # the file stays with the session: executors that join later fetch it too
    return os.path.basename(path)


def compile_lexicon(docs: DataFrame, tokenizer: str, most: int = 100_000) -> str | None:
    """Count the words of all documents and publish the frequent ones. ``most`` bounds the file, not the text."""
    since = staged_so_far()
    words = settle(frequent_words(docs, tokenizer, most), "frequent-words", since)
    return publish_lexicon(words, tokenizer)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_documents(docs: DataFrame, tokenizer: str | None = None, lexicon: str | None = None,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every whole text; null and empty texts have none."""
    path = tokenizer or default_tokenizer()
    docs = narrow(docs, id_col, text_col)
    lexicon = lexicon or compile_lexicon(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, lexicon)
        for batch in pieces(batches, "text", PIECE_BYTES):
            ids, n = coder.encode(batch.column("text").to_pylist())
            offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(offsets, ids.astype(np.int32))], ["doc_id", "ids"])

    return docs.mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); bytes that are not UTF-8 become the replacement character, null ids an empty text."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, None)
        for batch in batches:
            texts = [coder.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, tokenizer: str | None = None, lexicon: str | None = None,
               id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Per row: number of ids, digest of the ids, digest of the text decoded from them; with ``keep_ids`` the ids.

    Null text is empty: no ids, digests of the empty string. Rows are independent,
    so repeated rows, null ids and other columns need no care; an empty table gives an
    empty result. Encoding and decoding share the task.
    """
    path = tokenizer or default_tokenizer()
    docs = narrow(docs, id_col, text_col)
    lexicon = lexicon or compile_lexicon(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, lexicon)
        texts_of = coder.merges.texts
        for batch in pieces(batches, "text", PIECE_BYTES):
            flat, n = coder.encode(batch.column("text").to_pylist())
            hashes, decoded, at = [], [], 0
            for k in n.tolist():
                ids = flat[at:at + k].tolist()
                at += k
                hashes.append(hashlib.sha256(",".join([texts_of[i] for i in ids]).encode()).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            cols = [batch.column("id"), pa.array(n), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(offsets, flat.astype(np.int32)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")
    return docs.mapInArrow(run, schema)
