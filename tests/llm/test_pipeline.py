import os
import re

import pytest

import corpus_pipeline
from windward.session import drop_staged, shared_dir, stage, staged_so_far

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    """What each stage was given and what it returned."""
    docs, out = spark.read.parquet(f"{BASE}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES:
        after = stage(step(spark, docs, BASE), f"test-{name}")
        out.append((docs.toPandas().set_index("doc_id"), after.toPandas().set_index("doc_id")))
        docs = after
    return dict(zip([n for n, _ in corpus_pipeline.STAGES], out, strict=True))


def test_columns_and_ids(tables):
    for name, (before, after) in tables.items():
        assert set(after.index) <= set(before.index) and after.index.is_unique
        if name != "encode":
            assert list(after.columns) == ["text", "lang", "source", "n_chars"]


def test_quality_drops_labelled_junk_mostly(tables, spark):
    before, after = tables["quality"]
    labels = spark.read.parquet(f"{BASE}/labels.parquet").toPandas().set_index("doc_id")
    good = labels[(labels.quality == 1) & (labels.toxic == 0)].index
    assert good.isin(after.index).mean() > 0.97


def test_lines_keep_every_row_and_drop_later_passages(tables):
    before, after = tables["lines"]
    assert sorted(before.index) == sorted(after.index)
    seen = {}
    for i in sorted(before.index):
        for line in {x.strip() for x in before.text[i].split("\n")}:
            if len(line.split()) > 50 and seen.setdefault(line, i) != i:
                assert line not in after.text[i]
    assert (after.n_chars == after.text.str.len()).all()


def test_near_duplicates_leave_one_of_each(tables):
    before, after = tables["near_duplicates"]
    assert after.text.is_unique and set(before.text) >= set(after.text)


def test_benchmark_passages_are_gone(tables, spark):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    windows = set()
    for row in spark.read.parquet(f"{BASE}/benchmark.parquet").collect():
        w = word.findall(row.text.translate(fold))
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))}
    before, after = tables["benchmark"]

    def bad(text):
        w = word.findall(text.translate(fold))
        return any(tuple(w[i:i + 10]) in windows for i in range(len(w) - 9))

    assert set(before.index) - set(after.index) == {i for i in before.index if bad(before.text[i])}


def test_encoding_is_lossless(tables):
    import hashlib
    before, after = tables["encode"]
    assert sorted(before.index) == sorted(after.index)
    for i in before.index:
        assert after.decoded_sha256[i] == hashlib.sha256(before.text[i].encode()).hexdigest() and len(after.ids[i]) == after.n_tokens[i]


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)


def test_run_applies_the_stages_and_leaves_its_last_table_only(spark, tables):
    corpus_pipeline._delete_left(spark)
    folder, since = shared_dir(spark), staged_so_far()
    before, held = set(os.listdir(folder)), size(folder)
    listed = {t.name for t in spark.catalog.listTables()}
    out = corpus_pipeline.run(spark, BASE)
    assert out.count() == len(tables["encode"][1])
    new = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before if not name.startswith(".")}
    assert new == {"pipeline-encode", "lexicon"}  # executors fetch the lexicon as long as the session lasts
    lexicons = sum(os.path.getsize(os.path.join(folder, f)) for f in set(os.listdir(folder)) - before if "lexicon-" in f)
    assert size(folder) - held - lexicons < 3 * os.path.getsize(f"{BASE}/documents.parquet")
    assert {t.name for t in spark.catalog.listTables()} <= listed
    assert drop_staged(spark, since) == 1


def test_a_stage_keeps_what_its_input_still_reads(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    lines = steps["lines"](spark, docs, BASE)
    clean = steps["benchmark"](spark, lines, BASE)  # the first one's result is not written
    assert 0 < clean.count() <= docs.count()


def test_null_repeated_and_clashing_rows_pass_all_stages(spark, edges, no_docs):
    for docs in (edges, no_docs):
        ids = {r.doc_id for r in docs.collect()}
        for name, step in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stage(step(spark, docs, BASE), f"test-{name}")
            assert docs.columns == columns or name == "encode"
        assert {r.doc_id for r in docs.collect()} <= ids
    assert docs.count() == 0
