"""Nearest join, ranks, lookups and their behaviour on hot keys, against plain Python."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from windward.operators import derived, profile, upsert
from windward.operators.asof import nearest_join, unmatched_groups
from windward.operators.lookup import lookup_join
from windward.operators.ranks import Rank, balanced_counts, hot_groups, with_ranks


def nearest_by_hand(left, right):
    out = []
    for key, day, t, i in left:
        if key is None or t is None:
            continue
        near = [(abs(rt - t), rt, -v) for k, d, rt, v in right if (k, d) == (key, day) and rt is not None]
        if near:
            _, rt, v = min(near)
            out.append((key, day, t, i, rt, -v))
    return sorted(out, key=str)


def run_nearest(spark, left, right, **kw):
    l = spark.createDataFrame(left, "k string, d int, t double, i int")
    r = spark.createDataFrame(right, "k string, d int, rt double, v int")
    got = nearest_join(l, r, ["k", "d"], "t", "rt", ["rt", "v"], order=["v"], **kw)
    return sorted((tuple(x) for x in got.collect()), key=str)


time_ = st.one_of(st.none(), st.integers(0, 40).map(lambda x: x / 2))
key_ = st.sampled_from(["a", "b", None])


@settings(max_examples=6, deadline=None)
@given(
    st.lists(st.tuples(key_, st.integers(1, 2), time_), max_size=25),
    st.lists(st.tuples(key_, st.integers(1, 2), time_), max_size=12),
    st.sampled_from([0.5, 3.0, 100.0]),
)
def test_nearest_equals_brute_force(spark, left, right, bucket):
    left = [(*x, i) for i, x in enumerate(left)]
    right = [(*x, i) for i, x in enumerate(right)]
    assert run_nearest(spark, left, right, bucket=bucket) == nearest_by_hand(left, right)


def test_nearest_over_many_buckets(spark):
    rnd = random.Random(5)
    left = [(rnd.choice("ab"), 1, rnd.random() * 1e5, i) for i in range(800)]
    right = [(rnd.choice("abc"), 1, rnd.random() * 1e5, i) for i in range(40)]
    assert run_nearest(spark, left, right, bucket=60.0) == nearest_by_hand(left, right)


def test_tie_takes_the_earlier_reading_and_names_clash_gets_a_suffix(spark):
    l = spark.createDataFrame([("a", 10.0, "mine")], "k string, t double, note string")
    r = spark.createDataFrame([("a", 8.0, "early"), ("a", 12.0, "late")], "k string, rt double, note string")
    got = nearest_join(l, r, ["k"], "t", "rt", ["rt", "note"], suffix="_weather")
    assert got.columns == ["k", "t", "note", "rt", "note_weather"]
    assert got.first()["note_weather"] == "early"


def test_rows_stay_when_nothing_matches_at_all(spark):
    l = spark.createDataFrame([("a", 10.0)], "k string, t double")
    r = spark.createDataFrame([("z", 8.0)], "k string, rt double")
    assert nearest_join(l, r, ["k"], "t", "rt", ["rt"]).count() == 0
    assert nearest_join(l, r, ["k"], "t", "rt", ["rt"], left_if_no_match=True).collect() == [("a", 10.0, None)]


def test_unmatched_report_counts_every_dropped_row(spark, rows):
    l = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("b", 1.0), ("b", 2.0), (None, 1.0)], "k string, t double"
    )
    r = spark.createDataFrame([("a", 8.0)], "k string, rt double")
    assert rows(unmatched_groups(l, r, ["k"], "t")) == sorted([
        ("a", "no time", 1), ("b", "no reading", 2), (None, "no key", 1),
    ], key=lambda t: tuple((v is None, str(v)) for v in t))


@settings(max_examples=10, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.integers(0, 60).map(float))), max_size=40),
    st.sampled_from([1.0, 7.0, 1000.0]),
)
def test_rank_equals_counting(spark, data, bucket):
    data = [(g, v, i) for i, (g, v) in enumerate(data)]
    df = spark.createDataFrame(data, "g string, v double, i int")
    got = {r["i"]: r["r"] for r in with_ranks(df, Rank("r", ["g"], "v", bucket)).collect()}
    want = {
        i: None if g is None or v is None
        else 1 + sum(1 for g2, v2, _ in data if g2 == g and v2 is not None and v2 < v)
        for g, v, i in data
    }
    assert got == want


def test_no_window_is_large_for_continuous_values_of_a_hot_group(spark):
    n, most = 30_000, 1000
    df = spark.range(n).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 3 == 0, F.concat(F.lit("g"), F.col("id") % 500)).alias("g"),
                               F.exp(F.rand(7) * 30).alias("v"), "id")
    df = df.union(spark.range(2000).select(F.lit("hot"), F.lit(5.0), F.col("id") + n))  # one value very often
    r = Rank("r", ["g"], "v", most)
    rows_ = hot_groups(df, ["g"], most).first()["_rows"]
    sizes = balanced_counts(df.where("g = 'hot'"), r, rows_).groupBy("g", "_b").count()
    assert sizes.agg(F.max("count")).first()[0] <= most and sizes.count() > 20
    got = with_ranks(df, r).orderBy("id").select("r").collect()
    values = sorted((x.g, x.v, x.id) for x in df.collect())
    want, place = {}, {}
    for i, (g, v, k) in enumerate(values):
        start = place.setdefault(g, i)
        want[k] = want[values[i - 1][2]] if i > start and values[i - 1][1] == v else i - start + 1
    assert [x.r for x in got] == [want[k] for k in sorted(want)]


def test_small_groups_share_one_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 50 as g", "id * 1.5 as a", "-id as b")
    plan = with_ranks(df, Rank("x", ["g"], "a"), Rank("y", ["g"], "b"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_rows_without_a_group_are_not_gathered(spark):
    df = spark.range(5000).selectExpr("if(id % 2 = 0, null, id % 7) as g", "id * 1.0 as v")
    got = with_ranks(df, Rank("x", ["g"], "v"))
    assert got.where("x is null").count() == 2500 and got.where("g is null and x is not null").count() == 0


def test_segment_ranks_by_time_and_by_finish(spark, rows):
    df = spark.sql("""SELECT 1 AS race_id, 1 AS segment_no, * FROM VALUES
      ('a', 30D, timestamp_ntz'2024-01-01 10:00:40'), ('b', 20D, timestamp_ntz'2024-01-01 10:00:50'),
      ('c', 20D, timestamp_ntz'2024-01-01 10:00:45') AS t(who, segment_time_s, segment_end)""")
    got = rows(derived.segment_ranks(df), "who", "rank_segment", "rank_segment_end")
    assert got == [("a", 3, 1), ("b", 1, 3), ("c", 1, 2)]


def hot(spark, n=20000):
    """A third of the rows hold one key."""
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 997).alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("pad"),
    )


def test_hot_key_rows_are_all_joined(spark):
    rows_ = hot(spark)
    lookup = rows_.groupBy("k").agg(F.max("id").alias("last"))
    got = lookup_join(rows_, lookup, ["k"])
    assert got.count() == 20000 and got.where("last is null").count() == 0


def test_hot_partition_is_split_even_when_the_lookup_is_aggregated_by_the_same_key(spark):
    settings_ = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings_}
    try:
        for k, v in settings_.items():
            spark.conf.set(k, v)
        rows_ = hot(spark, 60000).repartition(8)
        known = profile.fill_from_key(
            rows_.withColumn("v", F.when(F.col("id") % 7 == 0, F.col("pad"))), ["k"], "v", F.col("id"), "none"
        )
        known.collect()
        plan = known._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_age_comes_from_the_last_row_that_has_one(spark, rows):
    df = spark.createDataFrame(
        [(1, "s", "n", "U17"), (2, "s", "n", "U19"), (3, "s", "n", None), (4, "s", "m", None), (5, None, "n", None)],
        "o int, serial_no string, athlete_name string, age_class string",
    )
    got = profile.fill_from_key(df, ["serial_no", "athlete_name"], "age_class", F.col("o"), "Senior")
    assert rows(got, "o", "age_class") == [(1, "U17"), (2, "U19"), (3, "U19"), (4, "Senior"), (5, "Senior")]


def test_sex_from_first_names(spark, rows):
    df = spark.createDataFrame(
        [("Ana Sol", None), ("BEN x", None), ("Kit y", None), ("Zed z", None), ("Ana w", "Men"), (None, None)],
        "athlete_name string, sex string",
    )
    names = spark.createDataFrame(
        [("ana", 0.1, 0.9), ("Ben", 0.8, 0.2), ("kit", 0.5, 0.5)], "first_name string, p_male double, p_female double"
    )
    assert dict(profile.fill_sex(df, names).collect()) == {
        "Ana Sol": "Women", "BEN x": "Men", "Kit y": None, "Zed z": None, "Ana w": "Men", None: None,
    }


def test_locations_attach_once_per_row(spark, rows):
    df = spark.createDataFrame([("e1",), ("e2",), ("e1",)], "event_name string")
    listed = [("e1", 1.0, 2.0), ("e1", 1.0, 2.0)]
    places = spark.createDataFrame(listed, "event_name string, lat double, lon double")
    for listed in ([("e1", 1.0, 2.0, 1), ("e1", 0.0, 9.0, 2)], [("e1", 0.0, 9.0, 2), ("e1", 1.0, 2.0, 1)]):
        two = spark.createDataFrame(listed, "event_name string, lat double, lon double, seen int")
        assert rows(profile.attach_location(df.limit(1), two, order=F.col("seen"))) == [("e1", 0.0, 9.0)]
        assert rows(profile.attach_location(df.limit(1), two)) == [("e1", 1.0, 2.0)]
    assert rows(profile.attach_location(df, places)) == [("e1", 1.0, 2.0), ("e1", 1.0, 2.0), ("e2", None, None)]


def test_upsert_keeps_the_last_write_and_can_be_repeated(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    once = upsert.upsert(old, new, ["k"], [F.col("v")])
    assert rows(once) == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(upsert.upsert(once, new, ["k"], [F.col("v")])) == rows(once)


def test_keep_last_cuts_rows_before_the_shuffle(spark):
    plan = upsert.keep_last(hot(spark), ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_only_new_races(spark, rows):
    df = spark.createDataFrame([("r1",), ("r2",), (None,)], "race_id string")
    known = spark.createDataFrame([("r1",), ("r1",), (None,)], "race_id string")
    assert rows(upsert.not_yet_known(df, known, "race_id")) == [("r2",), (None,)]
