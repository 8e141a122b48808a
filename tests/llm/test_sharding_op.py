import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from windward.llm.sharding import before_each, shard_documents


def test_rows_law_and_mixture(spark, edges):
    got = shard_documents(edges).collect()
    rows = edges.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))


def test_every_shard_has_the_mixture_and_seeds_shuffle(spark):
    docs = spark.range(4000).selectExpr("id doc_id", "string(id) text", "case when id % 3 = 0 then 'hot' else concat('s', id % 20) end source")
    got = shard_documents(docs).toPandas()
    for source, counts in got.groupby("source").shard.value_counts().unstack(fill_value=0).iterrows():
        assert counts.max() - counts.min() <= (5 if source == "hot" else 2)
    again = shard_documents(docs).toPandas()
    assert sorted(got[["doc_id", "shard", "slot"]].values.tolist()) == sorted(again[["doc_id", "shard", "slot"]].values.tolist())
    other = shard_documents(docs, seed=7).toPandas()
    assert sorted(got[["doc_id", "slot"]].values.tolist()) != sorted(other[["doc_id", "slot"]].values.tolist())


def test_empty(no_docs):
    assert shard_documents(no_docs).count() == 0


def test_prefix_sums_over_stretches(spark):
    rows = spark.range(20000).selectExpr("id o", "id % 7 n")
    got = {r.o: r.before for r in before_each(rows, [], "o", "n", "before").collect()}
    total = 0
    for i in range(20000):
        assert got[i] == total
        total += i % 7


@pytest.mark.parametrize("shards", [8, 3])
def test_places_against_a_plain_sort(spark, edges, shards):
    large = spark.range(3000).selectExpr("id doc_id", "repeat('a', int(id % 50)) text", "case when id % 3 = 0 then 'hot' when id % 7 > 0 then concat('s', id % 11) end source")
    for docs in (edges.select("doc_id", "text", "source"), large):
        text = F.coalesce("text", F.lit(""))
        seen = docs.select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("crc"))
        stratum = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null"))
        rows = seen.select("*", F.xxhash64(F.lit(42), "doc_id", "crc", "size").alias("u"), stratum.alias("s"),
                           (F.pmod(F.xxhash64(F.lit(42), stratum), F.lit(1 << 20)) / (1 << 20)).alias("phase")).collect()
        own = lambda r: (r.u, r.doc_id is not None, r.doc_id or 0, r.crc, r.size)
        placed = []
        for s in {r.s for r in rows}:
            ours = sorted((r for r in rows if r.s == s), key=own)
            placed += [((k + r.phase) / len(ours), r.s, *own(r), r) for k, r in enumerate(ours)]
        placed.sort(key=lambda x: x[:-1])
        want, filled = Counter(), Counter()
        for i, (*_, r) in enumerate(placed):
            shard = i * shards // len(rows)
            want[r.doc_id, r.size, r.crc, shard, filled[shard]] += 1
            filled[shard] += 1
        assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in shard_documents(docs, shards).collect()) == want
