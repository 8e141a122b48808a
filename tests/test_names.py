"""Similar names against the comparison of all pairs."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from windward.operators import names


def score(a, b):
    a, b = a.lower(), b.lower()
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b, 1):
            row[j] = last[j - 1] + 1 if x == y else max(row[j - 1], last[j])
    return round((1 - (len(a) + len(b) - 2 * row[-1]) / (len(a) + len(b))) * 100)


def score_exact(a, b):
    """As ``score``, of the texts as they are."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b, 1):
            row[j] = last[j - 1] + 1 if x == y else max(row[j - 1], last[j])
    return round((1 - (len(a) + len(b) - 2 * row[-1]) / (len(a) + len(b))) * 100)


def pairs_by_hand(listed, threshold):
    return sorted(
        (a, b, score(a, b))
        for i, a in enumerate(listed) for b in listed[i + 1:] if score(a, b) > threshold
    )


def map_by_hand(listed, threshold=85):
    """For each name the outcome of its last similar predecessor."""
    out = {}
    for j, later in enumerate(listed):
        out[later] = later
        for earlier in listed[:j]:
            if score(earlier, later) > threshold:
                out[later] = earlier if len(earlier) > len(later) else later
    return out


def frame(spark, listed):
    return spark.createDataFrame(list(zip(listed, range(len(listed)))), "name string, ord int")


def found(spark, listed, threshold=85):
    df = names.similar_pairs(frame(spark, listed), threshold)
    return sorted((r["earlier"], r["later"], r["score"]) for r in df.collect())


def variants(seed, n, first=None):
    """Invented names with small changes, so that scores lie on both sides of the threshold."""
    rnd = random.Random(seed)
    word = lambda k: "".join(rnd.choice("abcdeimnorst") for _ in range(k))
    base = [f"{first or word(rnd.randint(2, 6))} {word(rnd.randint(1, 9))}".title() for _ in range(n // 3)]
    out = list(base)
    while len(out) < n:
        s = list(rnd.choice(base))
        for _ in range(rnd.randint(1, 4)):
            i = rnd.randrange(len(s) + 1)
            rnd.choice([lambda: s.insert(i, rnd.choice("aeiXz ")), lambda: s and s.pop(min(i, len(s) - 1))])()
        out.append("".join(s))
    return [x for x in dict.fromkeys(out) if x]


@pytest.mark.parametrize("threshold", [60, 75, 85, 95])
def test_no_pair_is_missed(spark, threshold):
    listed = variants(threshold, 240)
    assert found(spark, listed, threshold) == pairs_by_hand(listed, threshold)


def test_no_pair_is_missed_when_most_share_a_first_name(spark):
    listed = variants(3, 240, first="maria del")
    assert found(spark, listed) == pairs_by_hand(listed, 85)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="abAé", min_size=1, max_size=7), unique=True, min_size=2, max_size=25))
def test_short_and_mixed_case_names(spark, listed):
    assert found(spark, listed, 70) == pairs_by_hand(listed, 70)


def test_map_is_one_way_and_one_step(spark):
    listed = variants(11, 150) + ["Anna Berglund", "Anna Berglun", "Anna Berglu", "ANNA BERGLUND"]
    got = dict((r["name"], r["canonical"]) for r in names.canonical_names(frame(spark, listed)).collect())
    assert got == map_by_hand(listed)


def test_rows_are_renamed_and_none_is_lost(spark, rows):
    df = spark.createDataFrame(
        [(1, "Jon Smithsen"), (2, "Jon Smithse"), (3, None), (4, "Jon Smithse"), (5, "Eve")], "o int, n string"
    )
    assert rows(names.unify_names(df, "n", F.col("o"))) == [
        (1, "Jon Smithsen"), (2, "Jon Smithsen"), (3, None), (4, "Jon Smithsen"), (5, "Eve"),
    ]


def invented(seed, n, letters, least, most):
    """Names of random letters, half of them with a letter more than another."""
    rnd = random.Random(seed)
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(least, most))) for _ in range(n // 2)]
    return list(dict.fromkeys(base + [s[:3] + rnd.choice(letters) + s[3:] for s in base]))


def met(spark, listed):
    folds = frame(spark, listed).selectExpr("name f").withColumn("n", F.length("f"))
    return names.meetings(folds).count()


def test_meetings_grow_with_the_names_not_with_their_pairs(spark):
    few, many = (met(spark, invented(n, n, "abcdeimnorst", 6, 16)) for n in (2000, 8000))
    assert 1000 <= few and many <= 5 * few


def test_few_pairs_of_long_names_meet(spark):
    assert met(spark, invented(3, 3000, "abcdeimnorst", 18, 28)) <= 0.002 * 3000**2 / 2


def test_names_of_few_letters_meet_little_more_than_they_are_similar(spark):
    listed = invented(1, 1000, "abcde", 9, 15)  # so like each other that similar pairs themselves grow with the square
    similar = names.similar_pairs(frame(spark, listed)).count()
    assert similar > 400 and met(spark, listed) <= 2.5 * similar


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abAé😀", min_size=1, max_size=9), st.text(alphabet="abé😀", min_size=1, max_size=9)), min_size=1, max_size=20),
       st.integers(1, 30))
def test_score_of_short_and_long_texts(spark, pairs, times):
    df = spark.createDataFrame([(a * times, b * times) for a, b in pairs], "a string, b string")
    got = df.select("a", "b", names.score(F.col("a"), F.col("b")).alias("s")).collect()
    assert all(round(r.s) == score_exact(r.a, r.b) for r in got)


def test_pairing_is_an_equi_join(spark):
    plan = names.similar_pairs(frame(spark, variants(1, 30)))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan
