import hashlib
import random

import numpy as np
import pytest

from windward.llm import blockkeys, wordwindows


def brute(texts, window=35):
    where, rows = {}, [(t or "").encode().split() for t in texts]
    for d, w in enumerate(rows):
        for i in range(len(w) - window + 1):
            where.setdefault(tuple(w[i:i + window]), []).append((d, i))
    gone = [np.zeros(len(w), bool) for w in rows]
    for places in where.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i:i + window] = True
    return [(len(w), int(g.sum()), hashlib.sha256(b" ".join(x for x, y in zip(w, g, strict=True) if not y)).hexdigest())
            for w, g in zip(rows, gone, strict=True)]


def check(rows, **how):
    pairs = [(r.doc_id, r.text) for r in rows.collect()]
    want = sorted(str((i, *x)) for (i, _), x in zip(pairs, brute([t for _, t in pairs], how.get("window", 35)), strict=True))
    got = [tuple(r) for r in wordwindows.remove_windows(rows, **how).collect()]
    assert sorted(map(str, got)) == want
    return got


def test_edges_against_brute_force(edges):
    assert any(removed for _, _, removed, _ in check(edges))


def test_documents_against_brute_force(spark):
    assert sum(removed > 0 for _, _, removed, _ in check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5))) > 10


@pytest.mark.parametrize("window,shortest", [(35, 9), (35, 40), (8, 1), (10, 3)])
def test_overlaps_periods_and_edits(frame, monkeypatch, window, shortest):
    monkeypatch.setattr(wordwindows, "BLOCK_BYTES", 700)
    monkeypatch.setattr(blockkeys, "KEYS_PER_SHARD", 100)
    r = random.Random(5)
    base = [r.choice("abcdefghijklmnop") + str(r.randrange(30)) for _ in range(300)]
    texts = [base, base[:34] + ["#"] + base[34:], base[60:140], ["x"] * 34, ["x"] * 35, ["y"] * 36, ["u", "v"] * 40, ["u", "v", "w"] * 30, base[100:134], base[100:135],
             base[265:] + base[:265], base, base[:200], [], ["one"], base[10:45] * 2]
    for k in range(15):
        i = r.randrange(240)
        copy = base[i:i + 60]
        copy[r.randrange(60)] = "@"
        texts.append([f"{k}.{j}" for j in range(k * 3)] + copy)
    joined = [r.choice([" ", "\n", "\t ", "\x0b", "  "]).join(t) for t in texts]
    check(frame(list(enumerate(joined))), window=window, shortest=shortest)


def test_only_ascii_blanks_split(frame):
    text = " ".join(f"a{i} b c\x1cd" for i in range(40))
    assert {tuple(r)[1:3] for r in wordwindows.remove_windows(frame([(1, text), (2, text + " e")])).collect()} == {(40, 40), (41, 40)}


def test_kept_text_and_empty(frame, no_docs):
    tail = " ".join(f"t{i}" for i in range(35))
    got = {r.doc_id: r.text for r in wordwindows.remove_windows(frame([(1, f"a  b\n{tail} c"), (2, tail), (3, None)]), keep_text=True).collect()}
    assert got == {1: "a b c", 2: "", 3: ""}
    assert wordwindows.remove_windows(no_docs).count() == 0


def test_levels():
    assert wordwindows.level_lengths(35, 9) == [9, 18, 35]
    h = np.arange(1, 50, dtype=np.uint64)
    assert len(wordwindows.grow(h, 1, 35)) == 15 and len(wordwindows.grow(h[:20], 1, 35)) == 0
