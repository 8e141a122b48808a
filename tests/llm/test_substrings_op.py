import hashlib
import random

import numpy as np
import pytest

from windward.llm import substrings


def brute(texts, length=200):
    where = {}
    data = [(t or "").encode() for t in texts]
    for d, b in enumerate(data):
        for i in range(len(b) - length + 1):
            where.setdefault(b[i:i + length], []).append((d, i))
    gone = [np.zeros(len(b), bool) for b in data]
    for places in where.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i:i + length] = True
    return [(len(b), int(g.sum()), int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()),
             hashlib.sha256(np.frombuffer(b, np.uint8)[~g].tobytes()).hexdigest()) for b, g in zip(data, gone, strict=True)]


def test_edges_against_brute_force(edges):
    pairs = [(r.doc_id, r.text) for r in edges.collect()]
    want = sorted(str((i, *x)) for (i, _), x in zip(pairs, brute([t for _, t in pairs]), strict=True))
    assert sorted(str(tuple(r)) for r in substrings.remove_repeats(edges).collect()) == want


@pytest.mark.parametrize("stretch", [1_000, 1_000_000])
def test_overlaps_periods_and_edits(frame, monkeypatch, stretch):
    monkeypatch.setattr(substrings, "STRETCH", stretch)
    r = random.Random(9)
    base = "".join(r.choice("abcdé ") for _ in range(1500))
    texts = [base, base[:199] + "#" + base[199:], base[300:700], "x" * 400, "xy" * 150, "xyz" * 70 + "w", base[100:299], base[100:300], "é" * 99, "é" * 100,
             "é" * 101, "q".join(base[i:i + 250] for i in range(0, 1500, 250)), "ab" * 1000 + base[:500]]
    for k in range(12):
        i = r.randint(0, 1200)
        copy = list(base[i:i + 300])
        copy[r.randint(0, len(copy) - 1)] = "@"
        texts.append("".join(r.choice("uvw") for _ in range(k * 20)) + "".join(copy))
    got = {row.doc_id: tuple(row)[1:] for row in substrings.remove_repeats(frame(list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_kept_text_and_empty(frame, no_docs):
    row = substrings.remove_repeats(frame([(1, "a" * 150 + "b" * 300 + "c")]), keep_text=True).collect()[0]
    assert row.text == "a" * 150 + "c" and (row.n_removed, row.n_spans) == (300, 1)
    assert substrings.remove_repeats(no_docs).count() == 0


def test_classes_of_equal_strings_are_equal():
    r = random.Random(2)
    shared = bytes(r.choice(b"abc") for _ in range(260))
    owners = []
    for k in range(2):
        data = bytes(r.choice(b"xyz") for _ in range(77 * k)) + shared
        start, count, gram = substrings.Text(data, np.array([len(data)])).classes(200, 100)
        own = np.repeat(gram, count)
        owners.append(own[-61:].tolist())
    assert owners[0] == owners[1]
