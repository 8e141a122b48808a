import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names the operators use inside.
    *[T.StructField(c, T.StringType()) for c in ("id", "tk", "row", "kept", "n", "component", "block", "position")]])


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(n))


PASSAGE = words(1, 60)
LONG = "\n".join(words(100 + i, 12) for i in range(400))


def edge_rows():
    """Nulls, empty and long texts, copies, repeated rows, ties, shared passages, odd characters."""
    a, b = words(2, 80), words(3, 90)
    near = a.replace(a.split()[40], "changed", 1)
    texts = [
        (1, a), (2, a), (3, near), (4, b), (5, None), (6, ""), (7, None), (8, "one two"), (9, "one two"),
        (10, f"{words(4, 30)}\n{PASSAGE}\n{words(5, 30)}"), (11, f"{words(6, 20)}\n{PASSAGE}\n{words(7, 40)}"), (12, LONG), (13, LONG + "\nend"),
        (14, "x" * 900), (15, "héllo wörld \U0001f600 " * 40), (16, "\n\n \t \n"), (17, "ab " * 300), (4, b), (4, b + " tail"),
        (None, words(8, 50)), (None, None), (20, "\x00nul\x00 <|endoftext|> it's wide   space\r\n"),
        (21, "mail a.b@c.example.org, ip 10.0.0.300 or 10.0.0.30, +44 20 7946 0958, 4111 1111 1111 1111, a@b.c_x@y.zz"),
    ]
    return [(i, t, ["en", "de", None][k % 3], ["s1", "s1", "s2", None][k % 4], None if t is None else len(t), *["c"] * 8)
            for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def passage():
    return PASSAGE


@pytest.fixture(scope="session")
def make_words():
    return words


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs."""
    def make(pairs):
        return spark.createDataFrame([(i, t, "en", "s", None, *["c"] * 8) for i, t in pairs], SCHEMA)
    return make
