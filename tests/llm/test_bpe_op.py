import hashlib
import random

import numpy as np
import pytest

from windward.llm import bpe
from windward.llm.tokencounts import length_histogram, limit_report, quantiles

tokenizers = pytest.importorskip("tokenizers")
PATH = bpe.default_tokenizer()


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_round_trip_equals_the_library(edges, library):
    got = sorted(str(tuple(r)) for r in bpe.round_trip(edges).collect())
    assert got == sorted(str((r.doc_id, *want(library, r.text))) for r in edges.collect())


def test_random_text_with_and_without_lexicon(library):
    r = random.Random(5)
    pool = "aeiothns ETC'sre\n\t  19,.!é日　\x1c\x85<|endoftext|>"
    texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 200))) for _ in range(300)] + ["<|endoftext|>" * 3, "a<|endoftext|>b", "zz" * 5000]
    merges = bpe.Merges(PATH)
    for coder in (bpe.Encoder(merges, None),):
        flat, n = coder.encode(texts)
        for t, a, k in zip(texts, bpe.starts_of(n), n, strict=True):
            ids = flat[a:a + k].tolist()
            assert ids == library.encode(t, add_special_tokens=False).ids
            assert coder.decode(ids) == t


def test_automaton_is_minimal_and_numbers_words(tmp_path):
    words = sorted({w.encode() for w in ("tap", "taps", "top", "tops", "stop", "stops", "é", "", " tap")})
    parts, order = bpe.build_automaton(words)
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    assert len(parts["final"]) == len({frozenset(w[len(p):] for w in words if w.startswith(p)) for p in prefixes})
    parts |= {"ids": np.zeros(0, np.int32), "first": np.zeros(1, np.int64)}
    path = str(tmp_path / "lexicon")
    with open(path, "wb") as f:
        f.write(bpe.Lexicon.pack(parts))
    numbers = bpe.Lexicon(path).numbers([*words, b"ta", b"xyz", b"tapss"])
    assert sorted(numbers[:-3].tolist()) == list(range(len(words))) and numbers[-3:].tolist() == [-1] * 3
    assert [words[order[k]] for k in numbers[:-3]] == words


def test_encode_then_decode(edges):
    back = bpe.decode_documents(bpe.encode_documents(edges))
    assert sorted(str(tuple(r)) for r in back.collect()) == sorted(str((r.doc_id, r.text or "")) for r in edges.collect())


def test_frequent_words_are_bounded_and_most_frequent(frame):
    docs = frame([(i, " ".join(["common"] * 5 + ["rare" + str(i % 7)])) for i in range(70)])
    for most, want in ((2, {" common", "common"}), (8, {" common", "common"}), (9, {" common", "common", *(f" rare{i}" for i in range(7))})):
        assert {r.word for r in bpe.frequent_words(docs, PATH, most).collect()} == want  # the seven stand and fall together


def test_histogram_answers_limits(edges, library):
    hist = length_histogram(edges).cache()
    lengths = {}
    for r in edges.collect():
        lengths.setdefault(r.lang, []).append(len(library.encode(r.text or "", add_special_tokens=False).ids))
    for r in hist.collect():
        own = lengths[r.lang]
        assert (r.n_docs, r.docs_from, r.tokens_from) == (
            own.count(r.n_tokens), sum(x >= r.n_tokens for x in own), sum(x for x in own if x >= r.n_tokens))
        assert r.tokens_truncated == sum(min(x, r.n_tokens) for x in own)
        assert r.share == pytest.approx(sum(x <= r.n_tokens for x in own) / len(own))
    assert hist.count() == sum(len(set(v)) for v in lengths.values())
    for r in limit_report(hist, [1, 10, 333, 10**6]).collect():
        assert r.tokens_truncated == sum(min(x, r.limit) for x in lengths[r.lang])
        assert r.docs_from == sum(x >= r.limit for x in lengths[r.lang])
    for r in quantiles(hist, [0.5, 1.0]).collect():
        own = sorted(lengths[r.lang])
        assert r.n_tokens == own[-1] if r.q == 1.0 else sum(x <= r.n_tokens for x in own) >= len(own) / 2


def test_empty(no_docs):
    assert bpe.round_trip(no_docs).count() == 0 and length_histogram(no_docs).count() == 0
