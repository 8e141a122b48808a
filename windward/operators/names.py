"""Unifying near-identical names.

Two names are similar when their score, 100 * (1 - d / (m + n)) rounded, is
above a threshold; d is the number of single-character insertions and deletions
between the lower-cased names and m, n are their lengths.

Comparing all pairs is out of the question, and no pair may be missed, so pairs are found by equi-join on what
similar names must share. k, the most edits a similar pair allows, is known from the lengths.

- Two names that are not long have a common subsequence of a length that follows from k: each is left with it
  after a few deletions, so they meet on a whole name less a few letters (its deletion neighbourhood).
- A longer name is cut into more than k / 2 parts, one of which has one edit at most, so it and the piece of the
  other name it is aligned with meet as they are or less one letter.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windward.operators.lookup import lookup_join
from windward.session import stage

THRESHOLD = 85

# A name is compared as a whole up to the length where one number of deletions gives at most so many results.
MOST_KEYS = 2_000
WORD = 62  # bits of a word of the common subsequence, so that sums of two and a carry fit a bigint


def distinct_names(df: DataFrame, name: str, order: Column) -> DataFrame:
    """Distinct non-null names with the order of their first appearance."""
    return (
        df.where(F.col(name).isNotNull())
        .groupBy(F.col(name).alias("name")).agg(F.min(order).alias("ord"))
    )


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _letters(c: Column) -> Column:
    """The characters of a text that is not empty."""
    return F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.substring(c, i, F.lit(1)))


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two texts that are not empty.

    One bit per character of ``a``, in words; per character of ``b`` each word is changed by one addition, whose
    carry goes to the next. The zeros left are the common characters.
    """
    full = (1 << WORD) - 1
    words = F.sequence(F.lit(0), F.floor((F.length(a) - 1) / WORD).cast("int"))

    def mask(letters: Column, letter: Column) -> Column:
        bit = lambda w: lambda acc, i: F.when(F.get(letters, w * WORD + i) == letter, acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i))).otherwise(acc)
        return F.transform(words, lambda w: F.aggregate(F.sequence(F.lit(0), F.lit(WORD - 1)), F.lit(0).cast("bigint"), bit(w)))

    masks = _let(_letters(a), lambda letters: F.map_from_entries(
        F.transform(F.array_distinct(letters), lambda c: F.struct(c.alias("key"), mask(letters, c).alias("value")))))

    def word(row: Column, hits: Column):
        def step(done: Column, w: Column) -> Column:
            v = F.get(row, w)
            hit = v.bitwiseAND(F.get(hits, w))
            total = v + hit + done["carry"]
            left = total.bitwiseAND(F.lit(full)).bitwiseOR(v.bitwiseAND(F.bitwise_not(hit)))
            return F.struct(F.concat(done["out"], F.array(left)).alias("out"), F.shiftright(total, WORD).alias("carry"))
        return step

    def letter(table: Column):
        def step(row: Column, c: Column) -> Column:
            none = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("carry"))
            return _let(F.try_element_at(table, c), lambda hits: F.when(hits.isNull(), row).otherwise(F.aggregate(words, none, word(row, hits), lambda x: x["out"])))
        return step

    start = F.transform(words, lambda w: F.lit(full))
    last = F.length(a) - 1
    ones = lambda row: F.aggregate(words, F.lit(0), lambda n, w: n + F.bit_count(F.get(row, w).bitwiseAND(
        F.when(last - w * WORD >= WORD - 1, F.lit(full)).otherwise(F.call_function("shiftleft", F.lit(1).cast("bigint"), (last - w * WORD + 1)) - 1))))
    return F.length(a) - _let(masks, lambda table: _let(F.aggregate(_letters(b), start, letter(table)), ones))


def score(a: Column, b: Column) -> Column:
    """100 * (1 - d / (m + n)), not rounded."""
    total = F.length(a) + F.length(b)
    return (1 - (total - 2 * common_length(a, b)) / total) * 100


def _max_edits(total_length: str, threshold: int) -> str:
    # score >= threshold + 0.5, kept in whole numbers
    return f"(({total_length}) * {995 - 10 * threshold} div 1000)"


def _edits(total_length: int, threshold: int) -> int:
    return total_length * (995 - 10 * threshold) // 1000


def _deletions(n: int, threshold: int) -> list[int]:
    """How many letters a name of length n loses, as against each length the other name may have, down to what they must have in common."""
    fit = [m for m in range(1, 2 * n + 2) if abs(m - n) <= _edits(m + n, threshold)]
    return [n - (m + n - _edits(m + n, threshold) + 1) // 2 for m in fit]


def whole_limit(threshold: int) -> int:
    """The length up to which names are compared as a whole."""
    n = 1
    while n < 60 and max(comb(n + 1, max(d, 0)) for d in _deletions(n + 1, threshold)) <= MOST_KEYS:
        n += 1
    return n


def _whole_keys(folds: DataFrame, threshold: int, limit: int) -> DataFrame:
    """(f, n, token) of names up to the limit: what is left of them after each number of deletions that counts."""
    wanted = {n: sorted({d for d in _deletions(n, threshold) if d >= 0}) for n in range(1, limit + 1)}
    counts = F.create_map(*[x for n, ds in wanted.items() for x in (F.lit(n), F.array(*map(F.lit, ds)))])
    start = "array(named_struct('s', f, 'at', 0, 'gone', 0))"
    # Letters go from left to right, so that each choice of letters comes once.
    one_less = ("transform(sequence(x.at, length(x.s) - 1), i -> named_struct('s', concat(left(x.s, i), substring(x.s, i + 2)), 'at', i, 'gone', d))")
    level = f"flatten(transform(filter(acc, x -> x.gone = d - 1 and length(x.s) > x.at), x -> {one_less}))"
    left = f"if(array_max(wanted) = 0, {start}, aggregate(sequence(1, array_max(wanted)), {start}, (acc, d) -> concat(acc, {level})))"
    tokens = f"array_distinct(transform(filter({left}, x -> array_contains(wanted, x.gone)), x -> xxhash64(x.s)))"
    rows = folds.where(F.col("n") <= limit).withColumn("wanted", F.element_at(counts, F.col("n")))
    return rows.select("f", "n", F.explode(F.expr(tokens)).alias("token"))


def _parted(names: DataFrame, threshold: int) -> DataFrame:
    """For names with the length ``n`` of the longer of a pair: p, the number of its parts, and each part's number j, start and len."""
    p = f"int(greatest(2, ({_max_edits('2 * n', threshold)} + 2) div 2))"
    parts = names.selectExpr("*", f"{p} as p", f"explode(sequence(0, {p} - 1)) as j")
    return parts.selectExpr("*", "int(j * n div p) as start", "int((j + 1) * n div p) - int(j * n div p) as len")


def _tokens(rows: DataFrame, strings: str) -> DataFrame:
    """(f, of, token): an array of texts as tokens of one part of names of length n."""
    return rows.select("f", "of", F.explode(F.expr(f"array_distinct(transform({strings}, s -> xxhash64(n, j, s)))")).alias("token"))


_ONE_LESS = "transform(sequence(0, length({0}) - 1), i -> concat(left({0}, i), substring({0}, i + 2)))"


def _part_keys(folds: DataFrame, threshold: int, limit: int) -> DataFrame:
    """(f, of, token) of longer names of length ``of``: each part, and each part less one letter."""
    rows = _parted(folds.where(F.col("n") > limit), threshold).withColumns({"of": F.col("n"), "part": F.expr("substring(f, start + 1, len)")})
    return _tokens(rows, f"concat(array(part), {_ONE_LESS.format('part')})")


def _part_probes(folds: DataFrame, threshold: int, limit: int) -> DataFrame:
    """(f, of, token): the pieces of each name, of length ``of``, that a part of a name as long or longer may be aligned with.

    A piece is as long as the part, or one letter shorter (which the part then has more), or one letter
    longer (and is taken less one letter). The first part's piece begins where the name begins, the last
    one's ends where it ends; between, edits before shift it.
    """
    longer = folds.selectExpr("f", "n as of", f"explode(sequence(n, int(n * {1995 - 10 * threshold} div {5 + 10 * threshold}))) as n")
    longer = longer.where(f"n > {limit} and n - of <= {_max_edits('of + n', threshold)}").selectExpr("f", "of", "n", f"{_max_edits('of + n', threshold)} as edits")
    parts = _parted(longer, threshold).selectExpr("*", "edits >= p as one", "int(start - (edits + n - of) div 2) as lead")

    def pieces(size: str) -> str:
        lo = f"case when j = 0 then 0 when j = p - 1 then of - ({size}) else greatest(0, lead) end"
        hi = f"case when j = 0 then 0 when j = p - 1 then of - ({size}) else least(of - ({size}), int(start + (edits - n + of) div 2)) end"
        here = f"transform(sequence({lo}, {hi}), q -> substring(f, q + 1, {size}))"
        return f"if({size} < 0 or {size} > of or {lo} > {hi}, cast(array() as array<string>), {here})"

    longer_ones = f"flatten(transform({pieces('len + 1')}, t -> {_ONE_LESS.format('t')}))"
    return _tokens(parts, f"concat({pieces('len')}, if(one, concat({pieces('len - 1')}, {longer_ones}), cast(array() as array<string>)))")


def meetings(folds: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs (a, n_a, b, n_b), n_a <= n_b, that share what similar names share, each once. ``folds``: distinct texts f and their lengths n."""
    limit = whole_limit(threshold)
    # A name is small but has many keys: names are dealt to all cores, however few bytes they are. They are read four times.
    folds = stage(folds.select("f", "n").repartition(folds.sparkSession.sparkContext.defaultParallelism, "f"), "names")
    whole = _whole_keys(folds, threshold, limit)
    side = lambda x: F.struct(F.col(f"{x}.n").alias("n"), F.col(f"{x}.f").alias("f"))
    met = whole.alias("x").join(whole.alias("y"), "token").where("x.f < y.f").select(side("x").alias("x"), side("y").alias("y"))
    keys, probes = (t.withColumnRenamed("of", "n") for t in (_part_keys(folds, threshold, limit), _part_probes(folds, threshold, limit)))
    parted = keys.alias("x").join(probes.alias("y"), "token").where("x.f <> y.f").select(side("x").alias("x"), side("y").alias("y"))
    pairs = met.unionByName(parted).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    return pairs.select(F.col("x.f").alias("a"), F.col("x.n").alias("n_a"), F.col("y.f").alias("b"), F.col("y.n").alias("n_b"))


def similar_pairs(names: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """All pairs (earlier, later) of similar names with their score.

    ``names`` has one row per name (``name``, ``ord``).
    """
    if not 50 <= threshold < 100:
        raise ValueError("threshold must be in 50..99")
    names = names.withColumn("f", F.lower("name"))
    folds = names.select("f").distinct().withColumn("n", F.length("f")).where("n > 0")
    edits = _max_edits("n_a + n_b", threshold)
    candidates = (
        meetings(folds, threshold)
        # Edit distance with substitutions is never larger: a cheap first test.
        .where(F.expr(f"levenshtein(a, b, int({edits})) >= 0"))
        .select("a", "b")
    )
    # Exploded, so that the score is computed once and not again for the filter.
    close = candidates.withColumn("score", F.explode(F.array(F.rint(score(F.col("a"), F.col("b")))))).where(F.col("score") > threshold)
    one = names.select(F.col("f").alias("a"), F.col("name").alias("name_a"), F.col("ord").alias("ord_a"))
    two = names.select(F.col("f").alias("b"), F.col("name").alias("name_b"), F.col("ord").alias("ord_b"))
    # Names that differ in case only score 100.
    same = (
        one.join(two.withColumnRenamed("b", "a"), "a").where("ord_a < ord_b")
        .withColumn("score", F.lit(100.0))
    )
    either = (
        close.join(one, "a").join(two, "b").select("name_a", "ord_a", "name_b", "ord_b", "score")
        .unionByName(same.select("name_a", "ord_a", "name_b", "ord_b", "score"))
    )
    first = F.col("ord_a") < F.col("ord_b")
    return either.select(
        F.when(first, F.col("name_a")).otherwise(F.col("name_b")).alias("earlier"),
        F.when(first, F.col("name_b")).otherwise(F.col("name_a")).alias("later"),
        F.least("ord_a", "ord_b").alias("ord_earlier"),
        F.greatest("ord_a", "ord_b").alias("ord_later"),
        F.col("score").cast("int").alias("score"),
    )


def canonical_names(names: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Name -> the name it is unified to, for every distinct name.

    A name takes its last similar predecessor if that one is longer, else it
    stays as it is. The rule looks one way and one step only.
    """
    longer = F.length("earlier") > F.length("later")
    chosen = (
        similar_pairs(names, threshold)
        .groupBy(F.col("later").alias("name"))
        .agg(
            F.max_by(F.when(longer, F.col("earlier")).otherwise(F.col("later")), "ord_earlier")
            .alias("canonical")
        )
    )
    return names.join(chosen, "name", "left").select(
        "name", F.coalesce("canonical", "name").alias("canonical")
    )


def unify_names(
    df: DataFrame, name: str, order: Column, threshold: int = THRESHOLD
) -> DataFrame:
    """Replace each name by its canonical form.

    The map of changed names is written to the shared folder once, so that
    later steps which read the result several times do not pair names again.
    """
    changed = canonical_names(distinct_names(df, name, order), threshold).where("name <> canonical")
    renamed = stage(changed.select(F.col("name").alias(name), "canonical"), "names")
    return (
        lookup_join(df, renamed, [name])
        .withColumn(name, F.coalesce("canonical", name))
        .select(*df.columns)
    )
