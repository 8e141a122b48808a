import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from windward.llm.pii import personal_data

# The contract's patterns.
P = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
     "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.split(".")), "card": lambda: 14 <= len(d) <= 19 and luhn(d),
            "phone": lambda: 10 <= len(d) <= 15}[kind]()


def brute(text):
    spans = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(P.items()) for m in re.finditer(p, text or "") if ok(kind, m.group())]
    spans.sort()
    digest = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
    return (*[sum(s[3] == kind for s in spans) for kind in P], hashlib.sha256(digest.encode()).hexdigest(), digest)


def test_base_spans_on_edges(edges):
    got = sorted(str(tuple(r)) for r in personal_data(edges).collect())
    want = sorted(str((r.doc_id, *brute(r.text))) for r in edges.collect())
    assert got == want


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from("1234567890..@@++-() aZ_\U0001f600é\n"), max_size=80), min_size=30, max_size=30))
def test_base_spans_on_random_texts(frame, texts):
    texts = [*texts, "4111111111111111" * 2, "1.2.3.4.5.6.7.8", "a@b.c@d.e", "+1 (202) 555-0143.", "0" * 3000, "a" * 3000 + "@"]
    got = {r.doc_id: tuple(r)[1:6] for r in personal_data(frame(list(enumerate(texts)))).collect()}
    assert got == {i: brute(t)[:5] for i, t in enumerate(texts)}


def test_contexts_discover_unseen_identifiers(frame):
    seeds = [(i, f"please write to user{i}@host{i}.org today or later") for i in range(12)]
    unseen = [(100, "please write to bob@intranet today or later"), (101, "we said in 2019 that it works"), (102, "go to 12345678 today")]
    got = {r.doc_id: r for r in personal_data(frame(seeds + unseen)).collect()}
    assert got[100].spans == "email:16:28" and got[100].n_email == 0
    assert got[101].spans == "" and got[102].spans == ""
    assert all(got[i].n_email == 1 for i in range(12))


def test_mixed_contexts_are_not_trusted(frame):
    docs = [(i, f"see at user{i}@host{i}.org now") for i in range(5)] + [(10 + i, f"see at part{i}x7 now") for i in range(5)]
    assert all(r.spans == "" for r in personal_data(frame(docs)).filter("doc_id >= 10").collect())


def test_identifiers_with_digit_runs_are_discovered(frame):
    seeds = [(i, f"please write to user{i}@host{i}.org today or later") for i in range(30)]
    ids = ["AB-123456", "555-0143", "078-05-1120", "GB82WEST12345698765432", "9f86d081884c7d65", "10.20.30.400", "4111 1111 1111 1112"]
    docs = seeds + [(100 + i, f"please write to {x} today or later") for i, x in enumerate(ids)]
    docs += [(200, "please write to 4111 1111 1111 1111 today or later")]
    got = {r.doc_id: r for r in personal_data(frame(docs)).collect()}
    for i, x in enumerate(ids):
        assert got[100 + i].spans == f"email:16:{16 + len(x)}" and got[100 + i].n_card == got[100 + i].n_ip == 0
    assert got[200].spans == "card:16:35"  # a match that passes still blocks the words in it


def test_one_sided_contexts_and_borders(frame):
    def at(i):
        return f"user{i}@host{i}.org"
    seeds = [(i, f"call me at {at(i)} word{'abcdefgh'[i]}") for i in range(8)]  # fixed on the left only
    seeds += [(10 + i, f"{at(i)} wrote {'abcdefgh'[i]}") for i in range(8)]  # at the start
    seeds += [(20 + i, f"{'abcdefgh'[i]} by {at(i)}") for i in range(8)]  # at the end
    seeds += [(30 + i, f"{'abcdefgh'[i]} -- {at(i)} {'abcdefgh'[i]}") for i in range(8)]  # beside punctuation
    texts = ["call me at AB-123456 never", "AB-223456 wrote nothing", "sent by AB-323456", "then -- AB-423456 came", "then came AB-523456 too"]
    got = {r.doc_id: r.spans for r in personal_data(frame(seeds + [(100 + i, t) for i, t in enumerate(texts)])).collect()}
    assert [got[100 + i] for i in range(5)] == ["email:11:20", "email:0:9", "email:8:17", "email:8:17", ""]


def test_empty(no_docs):
    assert personal_data(no_docs).count() == 0


@pytest.mark.parametrize("text", ["9" * 200_000, "1 " * 100_000, "a." * 100_000 + "@", "+1" + "(" * 200_000])
def test_long_runs_neither_overflow_nor_crawl(frame, text):
    assert personal_data(frame([(1, text)])).collect()[0].n_email == 0
