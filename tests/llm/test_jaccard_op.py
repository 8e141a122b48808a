import random

from windward.llm import jaccard


def sets(texts):
    out = []
    for t in texts:
        w = jaccard.WORD.findall((t or "").lower())
        out.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def brute(docs, similarity=0.8):
    """n_links and class per distinct (id, text)."""
    docs = sorted({(i, t or "") for i, t in docs}, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    s = sets([t for _, t in docs])
    links, root = [0] * len(docs), list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if docs[a][1] == docs[b][1] or (s[a] and s[b] and len(s[a] & s[b]) >= similarity * len(s[a] | s[b]) - 1e-9):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (docs[find(i)][0], links[i]) for i, d in enumerate(docs)}


def check(df, **options):
    docs = [(r.doc_id, r.text) for r in df.collect()]
    want = brute(docs)
    rows = jaccard.near_duplicates(df, **options).collect()
    assert sorted(str((r.doc_id, r.class_id, r.n_links)) for r in rows) == sorted(str((i, *want[i, t or ""])) for i, t in docs)
    return rows


def test_edges(edges, rows):
    got = check(edges)
    assert {r.doc_id: r.class_id for r in got}[3] == 1
    kept = jaccard.keep_one(edges)
    assert kept.columns == edges.columns
    assert kept.count() == len({(r.doc_id, r.text_key) for r in got if r.kept})


def test_clusters_chains_and_split_buckets(frame, make_words, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 20)
    r = random.Random(4)
    base = make_words(700, 120).split()
    docs = []
    for i in range(70):  # one large group of near copies
        w = list(base)
        w[r.randint(0, len(w) - 1)] = f"e{i}"
        docs.append((i, " ".join(w)))
    chain = make_words(701, 150).split()
    for i in range(30):  # neighbours are near, the ends are not
        chain[(i * 4) % 150] = f"c{i}"
        docs.append((100 + i, " ".join(chain)))
    shared = make_words(702, 60)
    docs += [(200 + i, f"{shared} {make_words(800 + i, 60)}") for i in range(40)]  # one passage in common is not enough
    check(frame(docs), leaf=10)


def test_empty(no_docs):
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_runs_reach_the_recall():
    n = jaccard.runs_for(0.9999)
    assert (1 - 0.8**jaccard.DEPTH) ** n <= 1e-4 < (1 - 0.8**jaccard.DEPTH) ** (n - 1)
