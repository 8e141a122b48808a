import hashlib
import re

import pytest

from windward.llm.decontaminate import clean_documents, contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(FOLD))


def brute(docs, items, span=10):
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for i, item in items:
            v = words(item)
            for s in range(max(1, len(v) - span + 1)) if v and i is not None else ():
                window = v[s:s + span]
                for p in range(len(w) - len(window) + 1):
                    if w[p:p + len(window)] == window:
                        hit.update(range(p, p + len(window)))
                        found.add(str(i))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.fixture(scope="module")
def items(spark, passage):
    rows = [(1, passage), (2, "ONE two"), (3, None), (4, "ab " * 12), (10, "ab ab ab"), (5, passage + " more"), (6, "..."),
            (None, "one two"), (7, "héllo WÖRLD héllo wörld"), (7, "ÉTÉ été x")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_against_brute_force(edges, items, rows):
    got = rows(contamination(edges, items), *COLUMNS)
    want = brute([(r.doc_id, r.text) for r in edges.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert sorted(got, key=str) == want
    assert sum(x[-1] for x in want) >= 5


def test_every_shared_span_is_found(frame, spark, make_words):
    make = make_words
    item = make(50, 40)
    v = item.split()
    docs = [(s, f"{make(60 + s, 15)} {' '.join(v[s:s + 10])} {make(200 + s, 15)}") for s in range(31)]
    docs += [(100 + s, f"{make(60 + s, 15)} {' '.join(v[s:s + 9])} {make(200 + s, 15)}") for s in range(31)]
    got = {r.doc_id: r for r in contamination(frame(docs), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert all(got[s].n_hit == 10 for s in range(31))
    assert not any(got[100 + s].contaminated for s in range(31))


def test_items_without_id_count_for_the_words(frame, spark, passage):
    items = spark.createDataFrame([(None, passage)], "item_id long, text string")
    got = contamination(frame([(1, f"so {passage}"), (2, "so it is")]), items).orderBy("doc_id").collect()
    assert [(r.n_hit, r.n_items, r.contaminated) for r in got] == [(60, 0, True), (0, 0, False)]
    assert got[0].items_sha256 == got[1].items_sha256


def test_clean_documents_keep_their_columns(edges, items):
    left = clean_documents(edges, items)
    assert left.columns == edges.columns
    bad = {(r.doc_id, r.n_words) for r in contamination(edges, items).filter("contaminated").collect()}
    assert sorted(str((r.doc_id, r.text)) for r in left.collect()) == sorted(
        str((r.doc_id, r.text)) for r in edges.collect() if (r.doc_id, len(words(r.text))) not in bad)


def test_empty_tables(edges, no_docs, items):
    assert contamination(no_docs, items).count() == 0
    assert contamination(edges, items.limit(0)).filter("contaminated").count() == 0
