"""Personal data by fixed patterns, widened by bootstrapped contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windward.llm.common import text_key, text_of
from windward.operators.lookup import lookup_join
from windward.session import stage

# The contract's patterns (fixed values), written so that a match starts at the first character
# it can and never backs up: the same matches, in linear time and without deep recursion.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Any other word that could be an identifier: letters, digits and joining marks, with a digit or an at-sign.
TOKEN = r"(?<![A-Za-z0-9._%+@/:-])[A-Za-z._%+/:-]*+[0-9@][A-Za-z0-9._%+@/:-]*+"
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "token": TOKEN}
KINDS = ["email", "ip", "card", "phone"]
CONTEXT = 80  # characters on either side in which the neighbouring words are read
BESIDE = 4  # matches of the same kind on either side that are read with them
FIRST, LAST = "\x02", "\x03"  # stand as words before and after a text


def luhn(digits: Column) -> Column:
    """The check sum of a string of digits is a multiple of ten."""
    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c: c.cast("int"))
    parts = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(parts, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    small = r"^0*+(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
    return (F.when(kind == "ip", F.forall(F.split(match, r"\."), lambda p: p.rlike(small)))
            .when(kind == "card", F.when((n >= 14) & (n <= 19), luhn(digits)).otherwise(False))
            .when(kind == "phone", (n >= 10) & (n <= 15)).otherwise(True))


def _word(text: Column, pattern: str) -> Column:
    """A word in lower case, letters and digits only; one of other signs as it is; empty where there is none."""
    word = F.lower(F.regexp_extract(text, pattern, 1))
    bare = F.regexp_replace(word, r"[^\p{L}\p{N}]", "")
    return F.when(bare == "", word).otherwise(bare)


def _left(text: Column) -> Column:
    """The text before a match, as far as its words are read."""
    return F.when(F.length(text) < CONTEXT, F.concat(F.lit(f"{FIRST} "), text)).otherwise(F.substring(text, -CONTEXT, CONTEXT))


def _right(text: Column) -> Column:
    """The text after a match, as far as its words are read."""
    return F.when(F.length(text) < CONTEXT, F.concat(F.lit("x"), text, F.lit(f" {LAST}"))).otherwise(
        F.concat(F.lit("x"), F.substring(text, 1, CONTEXT)))


def candidates(docs: DataFrame) -> DataFrame:
    """(id, tk, kind, start, end, match, ok, open, left, left2, right) of every match, in code points.

    A text with n matches of a pattern splits into n + 1 pieces; running sums of
    the lengths are the offsets. One shuffle brings the matches of a document
    together, never its text. ``ok``: the match passes its kind's test. ``open``: a
    token, or a match that fails its test, that may be an unseen identifier: no match
    that passes touches it. A failed match inside an open token is only a part of that word.
    """
    kinds = F.array(*[F.struct(
        F.lit(k).alias("kind"), F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias("m"),
        F.split("text", p, -1).alias("s")) for k, p in PATTERNS.items()])
    has = F.col("text").rlike("[0-9@]")  # every pattern needs one of these
    found = docs.filter(has).select("id", "tk", F.explode(kinds).alias("k")).filter(F.size("k.m") > 0)
    # Gaps and matches in turn; of a long gap only its borders are near a match.
    short = F.transform("k.s", lambda t: F.when(F.length(t) > 2 * CONTEXT, F.concat(
        F.substring(t, 1, CONTEXT), F.lit(" "), F.substring(t, -CONTEXT, CONTEXT))).otherwise(t))
    turn = F.flatten(F.transform(short, lambda t, i: F.array(t, F.coalesce(F.get("k.m", i), F.lit("")))))
    found = found.select("id", "tk", "k", turn.alias("turn"))

    def around(i: Column) -> list[Column]:
        first = F.greatest(2 * (i - BESIDE), F.lit(0))
        left = _left(F.array_join(F.slice("turn", first + 1, 2 * i - first + 1), ""))
        right = _right(F.array_join(F.slice("turn", 2 * i + 3, 2 * BESIDE + 1), ""))
        return [_word(left, r"(?:^|\s)(\S++)\s*+$").alias("left"), _word(left, r"(?:^|\s)(\S++)\s++\S++\s*+$").alias("left2"),
                _word(right, r"^\S*+\s++(\S++)").alias("right")]

    each = F.transform("k.m", lambda m, i: F.struct(m.alias("match"), F.length(F.get("k.s", i)).alias("gap"), *around(i)))
    pieces = found.select("id", "tk", "k.kind", F.posexplode(each).alias("i", "x")).select("id", "tk", "kind", "i", "x.*")
    pieces = pieces.repartition("id", "tk").dropDuplicates(["id", "tk", "kind", "i"])
    upto = F.sum(F.col("gap") + F.length("match")).over(Window.partitionBy("id", "tk", "kind").orderBy("i"))
    spans = pieces.withColumn("end", upto).withColumn("start", F.col("end") - F.length("match"))
    trimmed = F.rtrim(F.col("match"), F.lit("._%+@/:-"))
    spans = spans.withColumn("match", F.when(F.col("kind") == "token", trimmed).otherwise(F.col("match")))
    spans = spans.withColumn("end", F.col("start") + F.length("match"))
    base = F.col("kind") != "token"
    spans = spans.withColumn("ok", base & _valid(F.col("kind"), F.col("match")))
    order = [F.col("start"), F.when(F.col("ok"), 0).when(base, 2).otherwise(1), F.col("kind")]
    doc = Window.partitionBy("id", "tk").rowsBetween(Window.unboundedPreceding, -1)
    earlier, later = doc.orderBy(*order), doc.orderBy(*[c.desc() for c in order])  # a frame to the end of the text would be quadratic
    before = F.max(F.when(F.col("ok"), F.col("end"))).over(earlier)
    after = F.min(F.when(F.col("ok"), F.col("start"))).over(later)
    free = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    spans = spans.withColumn("free", ~F.col("ok") & free & (F.length("match") >= 6))
    word = F.max(F.when(F.col("free") & ~base, F.col("end"))).over(earlier)
    return spans.withColumn("open", F.col("free") & (~base | (F.coalesce(word, F.lit(0)) < F.col("end")))).select(
        "id", "tk", "kind", F.col("start").cast("long"), F.col("end").cast("long"), "match", "ok", "open", "left", "left2", "right")


def shape(match: Column) -> Column:
    """Runs of letters and of digits as one sign each."""
    return F.regexp_replace(F.regexp_replace(match, "[0-9]++", "0"), "[A-Za-z]++", "a")


def bootstrap(spans: DataFrame, rounds: int = 3, min_seeds: int = 3, min_confidence: float = 0.9) -> DataFrame:
    """Spans of unseen identifiers: (id, tk, kind, start, end).

    A pattern is a kind with a context: the words left and right of an entity, the word
    or the two words left of it, or the word right of it. Seeds score 1,
    open instances 0. In each round a pattern scores the mean over its distinct
    entities, and an open one the best of its patterns with ``min_seeds`` distinct seeds
    of one kind. After the last round an open instance in a pattern of at least
    ``min_confidence`` is new, if its shape is not that of a plain number; of new
    spans inside each other the outermost stays. Patterns and entities are only ever
    aggregated and joined by key; a pattern as common as a third of all matches is
    combined map-side, and its join partition can be split.
    """
    ok = contexts(spans.filter("ok or open").withColumn("kind", F.when(F.col("open"), "open").otherwise(F.col("kind"))))
    pairs = ok.select("context", F.lower("match").alias("entity"), "kind").distinct()
    seeded = pairs.filter("kind <> 'open'").groupBy("context", "kind").agg(F.count("*").alias("seeds")).filter(F.col("seeds") >= min_seeds)
    seeded = stage(seeded.select("context", F.col("kind").alias("of"), "seeds"), "pii-patterns")
    # Open instances, and entities of other kinds as counter-evidence, in the seeded patterns.
    edges = lookup_all(pairs, seeded).select("context", "of", "entity", (F.col("kind") == F.col("of")).alias("seed"),
                                             (F.col("kind") == "open").alias("open"))
    edges = stage(edges, "pii-edges")
    scores = edges.withColumn("score", F.when(F.col("seed"), 1.0).otherwise(0.0))
    patterns = scores.groupBy("context", "of").agg(F.avg("score").alias("conf"))
    for _ in range(rounds - 1):
        tokens = lookup_join(edges.filter("open"), patterns, ["context", "of"], "inner").groupBy("entity", "of").agg(F.max("conf").alias("best"))
        tokens = stage(tokens, "pii-scores")
        again = lookup_join(edges, tokens, ["entity", "of"]).withColumn(
            "score", F.when(F.col("seed"), 1.0).when(F.col("open"), F.coalesce("best", F.lit(0.0))).otherwise(0.0))
        patterns = stage(again.groupBy("context", "of").agg(F.avg("score").alias("conf")), "pii-confidence")
    good = patterns.filter(F.col("conf") >= min_confidence)
    new = lookup_all(ok.filter("open"), good).filter(shape(F.col("match")) != "0")
    new = new.groupBy("id", "tk", "start", "end").agg(F.max_by("of", F.struct("conf", "of")).alias("kind"))
    wider = F.max("end").over(Window.partitionBy("id", "tk").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1))
    return new.withColumn("wider", wider).filter("wider is null or wider < end").select("id", "tk", "kind", "start", "end")


def contexts(spans: DataFrame) -> DataFrame:
    """One row per span and context it stands in; borders of the text count as words, an absent word gives no context."""
    def of(mark: str, *words: str) -> Column:
        whole = F.concat_ws(" ", F.lit(mark), *words)
        for w in words:
            whole = F.when(F.col(w) != "", whole)
        return whole

    every = F.array(of("both", "left", "right"), of("left", "left"), of("left2", "left2", "left"), of("right", "right"))
    return spans.withColumn("context", F.explode(F.array_compact(every))).drop("left", "left2", "right")


def lookup_all(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """Join by context; a context has at most one pattern per kind."""
    key = F.xxhash64("context")
    return rows.withColumn("_c", key).join(patterns.withColumn("_c", key), ["context", "_c"]).drop("_c")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """Per document: counts of the base kinds, a digest of the base spans, and all spans.

    Spans are kind:start:end in code points, end exclusive, ordered by start, then by
    kind as listed. Counts are those of the base patterns. Null texts are empty and
    have no spans; rows that repeat id and text get one row each with the same
    values; other columns are not read; an empty table gives an empty result.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("tk"), text_of(text_col).alias("text"))
    spans = stage(candidates(keyed), "pii-spans")
    new = bootstrap(spans, **options)
    cols = ["id", "tk", "kind", "start", "end"]
    every = spans.filter("ok").select(*cols, F.lit(True).alias("base")).union(new.select(*cols, F.lit(False).alias("base")))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    every = every.withColumn("s", F.struct("start", rank.alias("rank"), "end", "kind", "base"))
    per = every.groupBy("id", "tk").agg(
        F.array_sort(F.collect_list("s")).alias("all"), *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS])

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    per = per.select(F.col("id").alias("i2"), F.col("tk").alias("t2"), *[f"n_{k}" for k in KINDS],
                     joined(F.filter("all", lambda s: s["base"])).alias("base"), joined(F.col("all")).alias("spans"))
    out = keyed.select("id", "tk").join(per, F.col("id").eqNullSafe(F.col("i2")) & (F.col("tk") == F.col("t2")), "left")
    return out.select(
        F.col("id").alias("doc_id"), *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
