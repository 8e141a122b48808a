import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from windward.llm import alignment
from windward.llm.bpe import byte_alphabet


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute(pairs, libraries):
    first, second = libraries
    to_byte = {c: b for b, c in enumerate(byte_alphabet())}
    docs, held = [], Counter()
    for i, text in pairs:
        groups = []
        if text:
            a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
            a_bytes = [bytes(to_byte[c] for c in first.id_to_token(x)) for x in a]
            b_bytes = [bytes([int(second.id_to_piece(x)[3:5], 16)]) if second.is_byte(x) else second.id_to_piece(x).replace("▁", " ").encode() for x in b]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a_end, b_end = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
                p = q = 0
                for e in sorted(set(a_end) & set(b_end)):
                    ga, gb = [], []
                    while p < len(a) and a_end[p] <= e:
                        ga.append(a[p])
                        p += 1
                    while q < len(b) and b_end[q] <= e:
                        gb.append(b[q])
                        q += 1
                    groups.append((ga, gb))
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        held.update(links.keys())
        docs.append((i, groups, links))
    highest = {}
    for (x, _), n in held.items():
        highest[x] = max(highest.get(x, 0), n)
    out = []
    for i, groups, links in docs:
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((i, sum(len(g) for g, _ in groups), sum(len(g) for _, g in groups), len(groups), sum(links.values()),
                    sum(n for (x, y), n in links.items() if held[x, y] == highest[x]), sum(n * held[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def run(docs, **how):
    return sorted((tuple(r) for r in alignment.align(docs, **how).collect()), key=str)


ODD = ["  two  spaces ", " \n x", "a\n\nb\n c", "a 　b", "tab\tb  c", "▁under", "x ▁ y", "it's we'll <s> </s> <|endoftext|> <0x0A>", "你好 世界 \U0001f600\U0001f3fd",
       "é ́a ﬁ x²", "1234567 89 3.14", "\x00 \x01 \x7f", " ", "\n", "a", "\r\n a\r\nb", "x" * 300 + " " * 40 + "y", "क्ष الع", "a  b   c    d",
       "​ z‍ w", "don't 'S 'll", "A. B.C . .d"]


def test_edges_against_brute_force(edges, libraries):
    pairs = [(r.doc_id, r.text) for r in edges.collect()]
    assert run(edges) == brute(pairs, libraries)


@pytest.mark.parametrize("block", [4_000_000, 60])
def test_odd_texts_against_brute_force(frame, libraries, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    r = random.Random(7)
    texts = ODD + ["".join(r.choice([" ", " ", "\n", "a", "b", "th", "é", "—", "'", "9", "　", "世", "in ", " x"]) for _ in range(r.randrange(60))) for _ in range(120)]
    pairs = list(enumerate(texts))
    got = run(frame(pairs).repartition(2))
    assert got == brute(pairs, libraries)
    assert {r[0]: r[1] for r in got}[ODD.index("▁under")] == 0


def test_documents_against_brute_force(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.collect()], libraries)


def test_kept_groups_and_empty(frame, no_docs):
    row = alignment.align(frame([(1, "a tokenization")]), keep_groups=True).collect()[0]
    assert len(row.groups.split(";")) == row.n_groups and hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    assert alignment.align(no_docs).count() == 0


def test_pointers_meet_at_the_last_token_of_a_group():
    r = np.random.default_rng(1)
    for _ in range(50):
        n = int(r.integers(1, 200))
        a = np.append(np.sort(r.choice(n, int(r.integers(0, n)), replace=False)), n)
        b = np.append(np.sort(r.choice(n, int(r.integers(0, n)), replace=False)), n)
        a, b = a[a > 0], b[b > 0]
        common = np.intersect1d(a, b)
        first, second = alignment.terminals(a, b)
        want = np.searchsorted(a, common)
        assert first.tolist() == want[np.searchsorted(common, a)].tolist() and second.tolist() == want[np.searchsorted(common, b)].tolist()
    one = np.arange(1, 100_001) * 2
    assert set(alignment.terminals(one, np.append(one - 1, 200_000))[0].tolist()) == {99_999}
    assert len(alignment.terminals(np.zeros(0, np.int64), np.zeros(0, np.int64))[0]) == 0
