import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from windward.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=50):
    """docs, items: (id, text) pairs; (item, rank, doc, score) rows."""
    bags = [(i, Counter(t), len(t)) for i, text in docs if (t := terms(text))]
    count, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, bag, n in bags:
            m = 100 - 50 + 50 * n * count // length
            s = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (1000000000 * bag[t] // (1000 * bag[t] + 20 * m)) for t in wanted if t in bag)
            if s > 0:
                scored.append((-s, i is None, i))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def run(docs, items, **how):
    return sorted((tuple(r) for r in search.ranked_search(docs, items, **how).collect()), key=str)


ITEMS = "item_id string, text string, doc_id string, term string, chunk string"


def test_edges_against_brute_force(spark, edges):
    pairs = [(r.doc_id, r.text) for r in edges.collect()]
    asked = [("a", pairs[0][1][:150]), ("b", "One TWO héllo-wörld nothing"), ("c", None), ("d", ""), ("e", "zzzz"), ("a", "one"), ("f", "x" * 900), (None, "ab endoftext"),
             ("f", "x" * 900), ("g", " ".join(t or "" for _, t in pairs))]
    items = spark.createDataFrame([(*x, "c", "c", "c") for x in asked], ITEMS)
    want = brute(pairs, asked)
    assert want and run(edges, items) == want
    assert run(edges, items, k=2) == brute(pairs, asked, 2)


@pytest.mark.parametrize("block,chunk,at_once", [(8_000_000, 500, 48), (20_000, 7, 3)])
def test_tables_against_brute_force(spark, monkeypatch, block, chunk, at_once):
    monkeypatch.setattr(search, "BLOCK_BYTES", block)
    monkeypatch.setattr(search, "ITEMS_PER_CHUNK", chunk)
    monkeypatch.setattr(search, "AT_ONCE", at_once)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert run(docs, items) == want


def test_many_equal_scores_keep_least_ids(frame, spark):
    order = list(range(300))
    random.Random(1).shuffle(order)
    docs = frame([(i, "same words here") for i in order] + [(1000, "same"), (1001, "other text")])
    got = run(docs, spark.createDataFrame([("q", "words same")], "item_id string, text string"))
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(50))


def test_range_maxima_and_bounds():
    r = np.random.default_rng(3)
    length = np.array([40, 0, 25, 1])
    docs = np.concatenate([np.sort(r.choice(60, n, replace=False)) for n in length])
    shard = search.Shard(r.integers(1, 50, 60), r.permutation(60), length, docs, r.integers(1, 9, len(docs)), 100, 3000)
    a = r.integers(0, 66, 200)
    b = np.minimum(a + r.integers(0, 40, 200), 66)
    top = shard.greatest(a, b)
    assert [int(shard.impact[t]) for t in top] == [int(max(shard.impact[x:y], default=0)) for x, y in zip(a, b, strict=True)]
    lo = r.integers(0, 59, 50)
    hi = np.minimum(lo + r.integers(1, 30, 50), 60)
    assert shard.least_id(lo, hi).tolist() == [int(shard.ids[x:y].min()) for x, y in zip(lo, hi, strict=True)]


def test_few_documents_are_scored(monkeypatch):
    """Where one document in a hundred holds the rare terms, the bounds leave most documents unread."""
    r = np.random.default_rng(4)
    n = 5000
    docs = [np.arange(n), np.sort(r.choice(n, 60, replace=False)), np.sort(r.choice(n, 60, replace=False))]
    length = np.array([len(d) for d in docs])
    shard = search.Shard(np.full(n, 100), np.arange(n), length, np.concatenate(docs), np.ones(length.sum(), np.int64), n, n * 100)
    scored = []
    monkeypatch.setattr(search, "best_of", lambda s, i, k, real=search.best_of: scored.append(len(s) - k) or real(s, i, k))
    none = np.zeros(0, np.int64)
    scores, ids = shard.search(np.arange(3), np.array([1, 4000, 4000]), (none, none), 20)
    assert set(ids.tolist()) <= set(docs[1].tolist()) | set(docs[2].tolist())
    assert sum(max(x, 0) for x in scored) < n / 5


def test_empty_tables(frame, no_docs, spark):
    items = spark.createDataFrame([("a", "one")], "item_id string, text string")
    assert run(no_docs, items) == []
    assert run(frame([(1, "one")]), items.limit(0)) == []
    assert run(frame([(1, None), (2, "-- --")]), items) == []
