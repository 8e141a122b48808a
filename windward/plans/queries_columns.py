"""Queries over columns, filters, texts and clocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from windward.functions import text, times
from windward.operators import columns, filters, profile, weather
from windward.operators.lookup import lookup_join
from windward.plans import standins as s
from windward.plans.registry import query

# ---------------------------------------------------------------- columns


@query("SELECT p_partkey, p_brand, p_retailprice FROM part")
def scan_projected(spark, d):
    return s.table(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice")


@query("SELECT p_partkey, p_brand FROM part WHERE p_size >= 25")
def scan_filtered(spark, d):
    """The filter that reaches the scan is the feature here."""
    return s.table(spark, d, "part").where("p_size >= 25").select("p_partkey", "p_brand")


@query("SELECT n_nationkey AS place_id, n_name AS place, n_regionkey FROM nation")
def rename_map(spark, d):
    return columns.rename_columns(
        s.table(spark, d, "nation"), {"n_nationkey": "place_id", "n_name": "place", "absent": "x"}
    )


@query("""SELECT p_partkey AS a, p_name AS b, p_brand AS c, p_type AS d, p_size AS e, p_retailprice AS f
FROM part""")
def rename_positional(spark, d):
    return columns.rename_by_position(s.table(spark, d, "part"), list("abcdef"))


@query("SELECT r_name, CAST(NULL AS VARCHAR) AS note, r_regionkey FROM region")
def reorder_columns(spark, d):
    return columns.columns_first(s.table(spark, d, "region"), ["r_name", "note"])


@query("SELECT p_partkey, p_name, p_brand, p_size FROM part")
def drop_tolerant(spark, d):
    return columns.drop_columns(s.table(spark, d, "part"), ["p_type", "p_retailprice", "absent"])


@query("""SELECT c_custkey, c_nationkey, c_acctbal, n FROM customer JOIN (
  SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) ON s_nationkey = c_nationkey""")
def suffix_drop(spark, d):
    per_nation = (
        s.table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("c_nationkey"))
        .agg(F.count("*").alias("n"), F.avg("s_acctbal").alias("c_acctbal_right"))
    )
    customers = s.table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return columns.drop_suffixed(lookup_join(customers, per_nation, ["c_nationkey"], "inner"), "_right").select(
        "c_custkey", "c_nationkey", "c_acctbal", "n"
    )


# ---------------------------------------------------------------- filters

_LABELLED = "(SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def _labelled(spark, d):
    docs = s.table(spark, d, "documents").select("doc_id", "lang")
    return lookup_join(docs, s.table(spark, d, "labels"), ["doc_id"])


@query(f"SELECT doc_id, lang, quality FROM {_LABELLED} WHERE quality IS NOT NULL")
def dropna_subset(spark, d):
    return filters.drop_nulls(_labelled(spark, d), ["quality"]).select("doc_id", "lang", "quality")


@query(f"""SELECT doc_id, grade, toxic FROM (SELECT doc_id, nullif(quality, 0) AS grade, toxic FROM {_LABELLED})
WHERE doc_id IS NOT NULL AND grade IS NOT NULL AND toxic IS NOT NULL""")
def dropna_any(spark, d):
    return filters.drop_nulls(
        _labelled(spark, d).select("doc_id", F.nullif("quality", F.lit(0)).alias("grade"), "toxic")
    )


@query(f"""SELECT count(*) AS rows_before, count(*) FILTER (WHERE quality >= 1) AS rows_kept,
  count(*) FILTER (WHERE quality IS NULL OR quality < 1) AS rows_removed FROM {_LABELLED}""")
def filter_report(spark, d):
    return filters.filter_report(_labelled(spark, d), F.col("quality") >= 1)


COURSES = """(SELECT o_orderkey AS race_id, 'EVENT ' || CAST(o_custkey % 10 AS VARCHAR) AS event_name,
  CASE o_orderkey % 9
    WHEN 1 THEN o_orderpriority || ' U 17 Women' WHEN 2 THEN o_orderpriority || ' Under 19 men IQfoil'
    WHEN 3 THEN o_orderpriority || ' youth   Final' WHEN 4 THEN o_orderpriority || ' Recall'
    WHEN 5 THEN o_orderpriority || ' ABANDON 2' WHEN 6 THEN o_orderpriority || ' tournament'
    WHEN 7 THEN 'JUNIOR u19 Women ' || o_orderpriority WHEN 8 THEN 'R' || CAST(o_custkey AS VARCHAR)
  END AS course, o_totalprice AS total_length_m, o_totalprice * 1.05::DOUBLE AS total_dist_m,
  CAST(o_custkey % 500 AS DOUBLE) AS total_time_s FROM orders)"""
_TOKENS = "|".join([text.U17_PATTERN, text.U19_PATTERN, text.SEX_PATTERN, text.BOARD_PATTERN])
EXTRACTED = f"""(SELECT race_id, event_name, course AS raw,
  upper(substr(x, 1, 1)) || lower(substr(x, 2)) AS sex,
  CASE WHEN regexp_matches(course, '{text.U19_PATTERN}', 'i') THEN 'U19'
       WHEN regexp_matches(course, '{text.U17_PATTERN}', 'i') THEN 'U17' END AS age_class,
  trim(regexp_replace(regexp_replace(course, '({_TOKENS})', '', 'gi'), '\\s+', ' ', 'g')) AS course
  FROM (SELECT *, nullif(regexp_extract(course, '({text.SEX_PATTERN})', 1, 'i'), '') AS x FROM {COURSES}))"""


@query(f"""SELECT race_id, course FROM {COURSES}
WHERE course IS NULL OR NOT regexp_matches(course, 'abandon|recall', 'i')""")
def exclude_regex(spark, d):
    return filters.exclude_matching(s.courses(spark, d), "course").select("race_id", "course")


@query(f"""SELECT race_id, event_name, course FROM {COURSES}
WHERE event_name <> 'EVENT 3' OR coalesce(regexp_matches(course, 'IQFOIL', 'i'), FALSE)""")
def exclude_rule(spark, d):
    return filters.exclude_by_rule(s.courses(spark, d), {"EVENT 3": "IQFOIL"}).select(
        "race_id", "event_name", "course"
    )


@query(f"SELECT race_id, sex FROM {EXTRACTED}")
def extract_sex(spark, d):
    return s.courses(spark, d).select("race_id", text.extract_sex(F.col("course")).alias("sex"))


@query(f"SELECT race_id, age_class FROM {EXTRACTED}")
def classify_age(spark, d):
    return s.courses(spark, d).select("race_id", text.age_class(F.col("course")).alias("age_class"))


@query(f"SELECT race_id, course, sex, age_class FROM {EXTRACTED}")
def course_clean(spark, d):
    return profile.extract_profile(s.courses(spark, d)).select("race_id", "course", "sex", "age_class")


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('view', 'signup')")
def filter_isin(spark, d):
    return filters.keep_members(
        s.table(spark, d, "events").select("event_id", "event_type"), "event_type", ["view", "signup"]
    )


@query("SELECT event_id, value FROM events WHERE value >= 6")
def filter_threshold(spark, d):
    return filters.keep_at_least(s.table(spark, d, "events").select("event_id", "value"), "value", 6.0)


@query("""SELECT DISTINCT kind FROM (SELECT nullif(event_type, 'error') AS kind FROM events)
WHERE kind IS NOT NULL ORDER BY 1""")
def distinct_nonnull(spark, d):
    kinds = s.table(spark, d, "events").select(F.nullif("event_type", F.lit("error")).alias("kind"))
    return filters.distinct_values(kinds, "kind")


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE event_type <> 'error') AS succeeded,
count(*) FILTER (WHERE event_type = 'error') AS failed FROM events""")
def run_report(spark, d):
    return filters.run_report(s.table(spark, d, "events"), F.col("event_type") != "error")


# ---------------------------------------------------------------- texts


@query("""SELECT c_custkey, replace(regexp_replace(
  ' ' || chr(9) || replace(c_name, '#', '''') || ' ''' || c_mktsegment || '  ', '^\\s+|\\s+$', '', 'g'),
  '''', ' ') AS name FROM customer""")
def name_clean(spark, d):
    raw = F.concat(
        F.lit(" \t"), F.replace("c_name", F.lit("#"), F.lit("'")), F.lit(" '"), "c_mktsegment", F.lit("  ")
    )
    return s.table(spark, d, "customer").select("c_custkey", text.clean_name(raw).alias("name"))


@query("SELECT event_id, value AS direction FROM events")
def wind_text(spark, d):
    shown = F.concat(F.lit(" Wind "), F.format_string("%.2f", "value"), F.lit("° "))
    # Trailing zeros differ between ways of printing a double: compare the parsed number.
    return s.table(spark, d, "events").select("event_id", text.wind_text(shown).cast("double").alias("direction"))


@query("""SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS lenient, value AS strict FROM events""")
def decimal_comma(spark, d):
    comma = F.replace(F.format_string("%.2f", "value"), F.lit("."), F.lit(","))
    broken = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(comma)
    return s.table(spark, d, "events").select(
        "event_id",
        text.decimal_comma(broken, strict=False).alias("lenient"),
        text.decimal_comma(comma).alias("strict"),
    )


@query("""SELECT event_id, CASE WHEN event_type <> 'error' THEN round(value / 7, 4) END AS lat,
CASE WHEN event_type NOT IN ('error', 'signup') THEN round(user_id / 7, 4) END AS lon FROM events""")
def parse_coords(spark, d):
    value, user = (F.col("value") / 7).cast("string"), (F.col("user_id") / 7).cast("string")
    place = (
        F.when(F.col("event_type") == "error", F.lit("N/A"))
        .when(F.col("event_type") == "signup", F.concat(value, F.lit(", east")))
        .otherwise(F.concat(value, F.lit(", "), user))
    )
    e = s.table(spark, d, "events").select("event_id", place.alias("event_location"))
    return weather.parse_coordinates(e).drop("event_location")


# ---------------------------------------------------------------- clocks


@query("""SELECT event_id, CASE WHEN event_type <> 'signup' THEN strftime(ts, '%H:%M:%S') END AS clock FROM events""")
def epoch_to_clock(spark, d):
    epoch = (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).cast("string")
    t = F.when(F.col("event_type") == "signup", F.lit("soon")).otherwise(epoch)
    return s.table(spark, d, "events").select("event_id", times.epoch_clock(t).alias("clock"))


@query("""SELECT event_id, year(ts)::INT AS y, month(ts)::INT AS m, day(ts)::INT AS d,
CASE WHEN day(ts) + 3 <= 31 THEN strftime(ts + INTERVAL 3 DAY, '%Y-%m-%d') END AS later FROM events""")
def date_parts(spark, d):
    ts = F.col("ts")
    later = times.date_from_parts(F.year(ts), F.month(ts), F.dayofmonth(ts) + 3)
    return s.table(spark, d, "events").select(
        "event_id", F.year(ts).alias("y"), F.month(ts).alias("m"), F.dayofmonth(ts).alias("d"),
        later.cast("string").alias("later"),
    )


_SPANS = """(SELECT event_id, date_trunc('second', ts) AS a, CASE WHEN z < a0 THEN z + INTERVAL 1 DAY ELSE z END AS b
FROM (SELECT *, date_trunc('second', ts) AS a0,
  date_trunc('day', ts) + (date_trunc('second', ts + to_seconds(CAST(floor(value * 60) AS BIGINT)))
    - date_trunc('day', ts + to_seconds(CAST(floor(value * 60) AS BIGINT)))) AS z FROM events))"""


def _spans(spark, d):
    from windward.operators.derived import segment_times as with_times

    end = F.timestamp_seconds(
        F.floor(F.unix_seconds(F.col("ts").cast("timestamp"))) + F.floor(F.col("value") * 60)
    )
    e = s.table(spark, d, "events").select(
        "event_id", F.col("ts").cast("date").alias("race_date"),
        F.date_format("ts", "HH:mm:ss").alias("segment_start_clock"),
        F.date_format(end.cast("timestamp_ntz"), "HH:mm:ss").alias("segment_end_clock"),
    )
    return with_times(e)


@query(f"""SELECT event_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS segment_start,
strftime(b, '%Y-%m-%d %H:%M:%S') AS segment_end,
strftime(a + to_microseconds((epoch_us(b) - epoch_us(a)) // 2), '%H:%M:%S.%g') AS segment_mid_clock,
(epoch_us(b) - epoch_us(a)) / 1e6 AS segment_time_s FROM {_SPANS}""")
def segment_times(spark, d):
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return _spans(spark, d).select(
        "event_id", show("segment_start"), show("segment_end"), "segment_mid_clock", "segment_time_s"
    )


@query(f"""SELECT event_id, hour(a) * 3600 + minute(a) * 60 + second(a) + (epoch_us(b) - epoch_us(a)) / 1e6 / 2
AS mid_seconds FROM {_SPANS}""")
def seconds_of_day(spark, d):
    return _spans(spark, d).select("event_id", "mid_seconds")
