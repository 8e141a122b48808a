import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from windward.llm import quality


def discounts(counts):
    n1, n2, n3, n4 = (sum(c == i for c in counts.values()) for i in range(1, 5))
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    return [min(max(i - (i + 1) * y * b / a, 0.05), i - 0.05) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]


class Brute:
    """Interpolated modified Kneser-Ney, straight from its definition."""

    def __init__(self, texts, order):
        grams = Counter()
        for t in texts:
            s = quality.START * (order - 1) + t + quality.END
            grams.update(s[i:i + order] for i in range(len(s) - order + 1))
        self.levels = [grams]
        for k in range(order - 1, 0, -1):
            self.levels.insert(0, Counter(g[-k:] for g in self.levels[0]))
        self.cut = [discounts(c) for c in self.levels]
        self.bottom = len(self.levels[0]) + 1

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / self.bottom
        level, cut = self.levels[k - 1], self.cut[k - 1]
        context = {g: c for g, c in level.items() if g[:-1] == gram[:-1]}
        low = self.p(gram[1:])
        if not context:
            return low
        d = {g: cut[min(c, 3) - 1] for g, c in context.items()}
        total = sum(context.values())
        return (context.get(gram, 0) - d.get(gram, 0)) / total + sum(d.values()) / total * low


@pytest.mark.parametrize("order", [2, 4])
def test_scores_equal_the_definition(frame, spark, order):
    r = random.Random(3)
    texts = ["".join(r.choice("ab cd\n") for _ in range(r.randint(0, 60))) for _ in range(25)] + ["zzz \U0001f600", "a a a a b b"]
    docs = frame(list(enumerate(texts))).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("tk"), "text")
    trusted = spark.createDataFrame([(i,) for i in range(18)], "id long")
    model = Brute([quality.symbols(t) for t in texts[:18]], order)
    for row in quality.document_scores(docs, trusted, order).collect():
        s = quality.START * (order - 1) + quality.symbols(texts[row.id]) + quality.END
        logs = [math.log(model.p(s[i:i + order])) for i in range(len(s) - order + 1)]
        assert row.n_symbols == len(quality.symbols(texts[row.id]))
        assert row.nll == pytest.approx(-sum(logs) / len(logs), rel=1e-5)


def test_probabilities_sum_to_one():
    model = Brute(["abab cab", "bab"], 3)
    symbols = [g for g in model.levels[0]]
    for context in ("ab", "b", "zz"):
        assert sum(model.p(context + s) for s in symbols) + model.p(context + "?") == pytest.approx(1)


def test_symbols():
    assert quality.symbols("so so  so it\nis") == f"so{quality.AGAIN}so{quality.AGAIN}so it is"
    assert quality.symbols("") == ""


@pytest.fixture(scope="module")
def judged(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    return quality.judge(docs, labels).join(labels, "doc_id").toPandas()


def test_rejects_bad_and_keeps_good_documents(judged):
    bad, good = judged[judged.quality == 0], judged[judged.quality == 1]
    assert bad.rejected.mean() > 0.8
    assert good[good.toxic == 0].rejected.mean() < 0.01


def test_few_trusted_documents_reject_junk_too(spark):
    base = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    got = quality.judge(docs, labels).join(labels, "doc_id").toPandas()
    assert got[got.quality == 0].rejected.mean() > 0.8
    assert got[(got.quality == 1) & (got.toxic == 0)].rejected.mean() < 0.03


def test_edges(edges, spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (4, 1, 0), (4, 0, 0), (12, 1, 1), (None, 1, 0), (10, None, None)], "doc_id long, quality int, toxic int")
    assert {r.id for r in quality.trusted_ids(labels).collect()} == {1, 2}
    got = quality.judge(edges, labels).collect()
    assert len(got) == edges.count()
    assert all((r.perplexity is None) == (r.n_symbols == 0) and not (r.n_symbols == 0 and r.rejected) for r in got)
    kept = quality.keep_good(edges, labels)
    assert kept.columns == edges.columns and kept.filter("text is null").count() == 3


def test_texts_without_symbols_stay_beside_trusted_ones(frame, make_words):
    docs = frame([(i, make_words(3000 + i, 40)) for i in range(60)] + [(100, ""), (101, None), (102, " \n ")])
    labels = docs.filter("doc_id < 60").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    got = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert len(got) == 63
    for i in (100, 101, 102):
        assert (got[i].n_symbols, got[i].perplexity, got[i].rejected) == (0, None, False) and got[i].threshold > 1


def test_copies_do_not_move_the_thresholds(frame, spark, make_words):
    # In one language a third of the rows are copies of one text, in the other three quarters.
    distinct = [(i, make_words(1000 + i, 60)) for i in range(400)]
    copies = [(1000 + i, make_words(999, 60)) for i in range(100)] + [(2000 + i, make_words(998, 60)) for i in range(600)]
    junk = [(9001, "zqxj wvyk " * 30), (9002, "0192 8374 " * 30)]
    docs = frame(distinct + copies + junk).withColumn("lang", F.when(F.expr("doc_id < 200 or doc_id between 1000 and 1999 or doc_id = 9001"), "en").otherwise("de"))
    labels = docs.filter("doc_id < 9000").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    got = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert got[9001].rejected and got[9002].rejected
    assert not any(r.rejected for i, r in got.items() if i < 9000)


def test_nothing_is_rejected_without_trusted_text(edges, spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(edges, labels).filter("rejected").count() == 0
    assert quality.judge(no_docs, labels).count() == 0
