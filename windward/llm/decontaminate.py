"""Benchmark decontamination by winnowed fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windward.llm.common import match_documents, text_key, text_of
from windward.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed by the contract
SPAN = 10
GRAM = 5
_PLACE = 30  # low bits of a ranked gram that hold its position


# Characters other than A-Z that lower() would change; without any, lower() is the A-Z folding and much faster.
OTHER_UPPER = r"[\p{javaUpperCase}\p{javaTitleCase}&&[^A-Z]]"


def words_of(text: Column) -> Column:
    folded = F.when(text.rlike(OTHER_UPPER), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.regexp_extract_all(folded, F.lit(f"({WORD})"), F.lit(0))


def _gram(hashes: str, i: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(hashes, i + j) for j in range(n)])


def _indices(count: Column) -> Column:
    """0 .. count - 1, or nothing."""
    return F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def _runs(n: Column, length: int) -> Column:
    """Every run of ``length`` of n words."""
    return F.transform(_indices(n - length + 1), lambda i: F.slice("words", i + 1, length))


def fingerprints(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """Winnowed fingerprints: (place, fp) of the minimal gram of every run of ``span`` words.

    Adds ``fps``: the distinct choices over all windows of span - gram + 1 grams.
    Of equal grams the rightmost is chosen: the rank is the gram's hash with its
    position in the low bits, so one comparison decides both.
    """
    window, low = span - gram + 1, (1 << _PLACE) - 1
    n = F.size("words")
    out = docs.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    out = out.withColumn("grams", F.transform(_indices(n - gram + 1), lambda i: _gram("hashes", i, gram)))
    out = out.withColumn("ranked", F.transform("grams", lambda g, p: g.bitwiseAND(F.lit(~low)).bitwiseOR(F.lit(low) - p)))
    least = F.transform(_indices(n - span + 1), lambda i: F.least(*[F.get("ranked", i + j) for j in range(window)])
                        if window > 1 else F.get("ranked", i))
    return out.withColumn("fps", F.transform(F.array_distinct(least), lambda r: F.lit(low) - r.bitwiseAND(F.lit(low))))


def item_windows(items: DataFrame, item_id: str, text_col: str, span: int) -> DataFrame:
    """(item, window): every run of ``span`` words of an item, or a shorter item as one window; a null id stays null."""
    words = items.select(F.col(item_id).cast("string").alias("item"), words_of(text_of(text_col)).alias("words"))
    n = F.size("words")
    runs = F.when(n >= span, _runs(n, span)).otherwise(F.array("words"))
    return words.filter(n > 0).select("item", F.explode(runs).alias("window")).distinct()


def window_hits(docs: DataFrame, windows: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(id, tk, at, window, n_words): where item windows occur, and one row per document with ``at`` -1.

    ``docs`` has id, tk, words. Any run of ``span`` words holds a winnowed
    fingerprint of its document, and all grams of the item windows are kept, so
    the join on fingerprints misses no shared run. A fingerprint brings along the
    words around it, and each joined window is compared word by word. Windows
    shorter than ``span`` come from short items and are looked up at every word.
    The row per document rides along, so that texts are split into words once.
    """
    wanted = windows.select("window").distinct()
    long_, short = wanted.filter(F.size("window") == span), wanted.filter(F.size("window") < span)
    grams = long_.withColumn("hashes", F.transform("window", lambda w: F.xxhash64(w))).select(
        "window", F.posexplode(F.array(*[_gram("hashes", F.lit(j), gram) for j in range(span - gram + 1)])).alias("off", "fp"))
    lead, n = span - gram, F.size("words")
    at_places = F.transform("fps", lambda p: F.struct(
        p.alias("p"), F.get("grams", p.cast("int")).alias("fp"),
        F.slice("words", F.greatest(p - lead, F.lit(0)).cast("int") + 1, span + lead).alias("around"), F.lit(None).cast("long").alias("n_words")))
    itself = F.struct(F.lit(-1).cast("long").alias("p"), F.xxhash64("id", "tk").alias("fp"), F.array().cast("array<string>").alias("around"),
                      n.cast("long").alias("n_words"))
    chosen = fingerprints(docs, span, gram).select("id", "tk", F.explode(F.array_append(at_places, itself)).alias("f")).select("id", "tk", "f.*")
    found = chosen.join(grams, "fp", "left").withColumn("at", F.when(F.col("p") < 0, -1).otherwise(F.col("p") - F.col("off")))
    start = F.col("at") - F.greatest(F.col("p") - lead, F.lit(0))
    same = (F.col("at") >= 0) & (F.slice("around", F.greatest(start, F.lit(0)).cast("int") + 1, span) == F.col("window"))
    cols = ["id", "tk", "at", "window", "n_words"]
    hits = found.filter((F.col("p") < 0) | same).withColumn("window", F.when(F.col("p") >= 0, F.col("window"))).select(*cols)
    for row in short.select(F.size("window").alias("m")).distinct().collect():  # at most span - 1 lengths
        runs = _runs(F.size("words"), row.m)
        hits = hits.union(docs.select("id", "tk", F.posexplode(runs).alias("at", "window")).join(
            short.filter(F.size("window") == row.m), "window").select("id", "tk", F.col("at").cast("long"), "window", F.lit(None).cast("long")))
    return hits


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM, id_col: str = "doc_id",
                  text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document: words, words inside an item window, and the items with occurring windows.

    Null or wordless texts have no words and no hits; items without words are
    left out; those without id count for the words, not among the items; an id that several items share counts once. Rows that repeat id and
    text get one row each with the same values. Other columns are not read. An
    empty table on either side gives no hits.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("tk"), text_of(text_col).alias("text"))
    windows = stage(item_windows(items, item_id, item_text, span), "item-windows")
    tokens = keyed.select("id", "tk", words_of(F.col("text")).alias("words"))
    found = stage(window_hits(tokens, windows, span, gram), "window-hits")
    hits = found.filter("at >= 0")
    covered = hits.select("id", "tk", F.explode(F.sequence("at", F.col("at") + F.size("window") - 1)).alias("w")).distinct()
    n_hit = covered.groupBy("id", "tk").agg(F.count("*").alias("n_hit"))
    named = hits.select("id", "tk", "window").distinct().join(windows, "window").select("id", "tk", "item").distinct()
    named = named.groupBy("id", "tk").agg(F.count("item").alias("n_items"), F.array_sort(F.collect_list("item")).alias("items"))
    facts = n_hit.join(
        named.select(F.col("id").alias("i2"), F.col("tk").alias("t2"), "n_items", "items"),
        F.col("id").eqNullSafe(F.col("i2")) & (F.col("tk") == F.col("t2"))).select("id", "tk", "n_hit", "n_items", "items")
    counts = found.filter("at < 0").select("id", "tk", "n_words")
    out = counts.join(facts.select(F.col("id").alias("i2"), F.col("tk").alias("t2"), "n_hit", "n_items", "items"),
                      F.col("id").eqNullSafe(F.col("i2")) & (F.col("tk") == F.col("t2")), "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", F.array().cast("array<string>"))), 256).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"), F.col("tk").alias("text_key"))


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """The documents without any word inside an item window, with all their columns."""
    bad = contamination(docs, items, id_col=id_col, text_col=text_col, **options).filter("contaminated").select(
        F.col("doc_id").alias("id"), F.col("text_key").alias("tk")).distinct()
    return match_documents(docs, bad, "left_anti", id_col, text_col).select("row.*")
