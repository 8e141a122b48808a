"""Queries over segments: joins, ranks, measures, distributions, features, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from windward.operators import derived, distributions, features, model, names, profile, weather
from windward.operators.asof import nearest_join, unmatched_groups
from windward.operators.counted import StepCounts
from windward.operators.lookup import lookup_join
from windward.plans import enrich
from windward.plans import standins as s
from windward.plans.queries_columns import COURSES, EXTRACTED
from windward.plans.registry import query
from windward.session import stage

SEG = """(SELECT l_orderkey AS race_id, l_linenumber AS segment_no, l_suppkey AS serial_no, l_partkey AS athlete_no,
  l_extendedprice / 100 AS segment_length_m, l_extendedprice / 100 * (1 + l_discount) AS segment_dist_m,
  l_quantity - 1 AS segment_time_s, CAST(l_partkey % 360 AS DOUBLE) AS heading_deg,
  CAST(l_suppkey * 37 % 360 AS DOUBLE) AS wind_dir_site, (l_discount + l_tax) * 100 AS wind_speed_kn,
  l_shipdate AS segment_start FROM lineitem)"""
SPEEDS = f"""(SELECT *, segment_dist_m / nullif(segment_time_s, 0) * 1.94384::DOUBLE AS segment_speed_kn,
  segment_length_m / nullif(segment_time_s, 0) * 1.94384::DOUBLE AS segment_vmc_kn,
  abs((wind_dir_site - heading_deg + 540) % 360 - 180) AS angle FROM {SEG})"""
SAIL = """CASE WHEN angle < 45 THEN 'Vent debout' WHEN angle < 80 THEN 'Allures remontantes'
  WHEN angle < 100 THEN 'Reaching' WHEN angle < 160 THEN 'Allures portantes' ELSE 'Vent arrière' END"""
ID = ["race_id", "segment_no", "serial_no", "athlete_no"]
_ID = ", ".join(ID)

# ---------------------------------------------------------------- nearest in time

_EV = """(SELECT *, user_id % 25 AS site, CAST(ts AS DATE) AS day, (epoch_us(ts) % 86400000000) / 1e6 AS t FROM events)"""


@query(f"""SELECT event_id, site, t, right_id, right_t, right_value FROM (
  SELECT p.event_id, p.site, p.t, v.event_id AS right_id, v.t AS right_t, v.value AS right_value,
    row_number() OVER (PARTITION BY p.event_id ORDER BY abs(p.t - v.t), v.t, v.event_id DESC) AS rn
  FROM {_EV} p JOIN {_EV} v ON p.site = v.site AND p.day = v.day
  WHERE p.event_type = 'purchase' AND v.event_type = 'view') WHERE rn = 1""")
def asof_nearest(spark, d):
    e = s.site_events(spark, d)
    views = e.where("event_type = 'view'").select(
        "site", "day", F.col("t").alias("right_t"), F.col("event_id").alias("right_id"),
        F.col("value").alias("right_value"),
    )
    return nearest_join(
        e.where("event_type = 'purchase'").select("event_id", "site", "day", "t"), views,
        ["site", "day"], "t", "right_t", ["right_id", "right_t", "right_value"], order=["right_id"],
    ).drop("day")


_ASKED = f"""(SELECT CASE WHEN event_id % 13 > 0 THEN site END AS site, day, CASE WHEN event_id % 11 > 0 THEN t END AS t FROM {_EV} WHERE event_type = 'purchase')"""


@query(f"""SELECT site, strftime(day, '%Y-%m-%d') AS day, reason, sum(lost)::BIGINT AS rows_dropped FROM (
  SELECT p.site, p.day, CASE WHEN p.site IS NULL THEN 'no key' WHEN v.site IS NULL THEN 'no reading' ELSE 'no time' END AS reason,
    CASE WHEN v.site IS NULL OR p.t IS NULL THEN 1 ELSE 0 END AS lost
  FROM {_ASKED} p LEFT JOIN (SELECT DISTINCT site, day FROM {_EV} WHERE event_type = 'view' AND user_id % 5 > 0) v ON v.site = p.site AND v.day = p.day)
GROUP BY 1, 2, 3 HAVING sum(lost) > 0""")
def asof_unmatched(spark, d):
    """Rows without a place, without a time, or at a place and day without a reading."""
    e = s.site_events(spark, d)
    asked = e.where("event_type = 'purchase'").select(
        F.when(F.col("event_id") % 13 > 0, F.col("site")).alias("site"), "day", F.when(F.col("event_id") % 11 > 0, F.col("t")).alias("t"))
    report = unmatched_groups(asked, e.where("event_type = 'view' and user_id % 5 > 0"), ["site", "day"], "t")
    return report.withColumn("day", F.col("day").cast("string"))


_RACED = """(SELECT l_orderkey AS race_id, l_linenumber AS segment_no, l_suppkey AS serial_no,
  l_partkey AS athlete_no, l_extendedprice / 100 AS segment_length_m,
  l_extendedprice / 100 * (1 + l_discount) AS segment_dist_m, CAST(l_partkey % 360 AS DOUBLE) AS heading_deg,
  CAST(l_suppkey * 37 % 360 AS DOUBLE) AS wind_dir_site, l_suppkey % 25 AS site,
  DATE '2024-01-01' + CAST(l_orderkey % 32 AS INTEGER) AS day, l_quantity - 1 AS segment_time_s,
  (l_partkey * 37 + l_linenumber * 600) % 86400 AS start_s,
  l_extendedprice / 100 * 5 AS total_length_m, l_extendedprice / 100 * 5 * (1 + l_tax) AS total_dist_m,
  CAST(l_partkey % 500 AS DOUBLE) AS total_time_s, row_number() OVER () AS rid FROM lineitem)"""
_READ = """(SELECT user_id % 25 AS site, CAST(ts AS DATE) AS day, floor((epoch_us(ts) % 86400000000) / 1e6) AS t,
  value AS temperature_c, CAST(event_id % 100 + 950 AS INTEGER) AS pressure_hpa,
  CAST(user_id % 100 AS INTEGER) AS humidity_pct, round(value % 20, 2) AS wind_speed_kn, event_id FROM events)"""
ENRICHED = f"""(SELECT *,
  segment_dist_m / nullif(segment_time_s, 0) * 1.94384::DOUBLE AS segment_speed_kn,
  segment_length_m / nullif(segment_time_s, 0) * 1.94384::DOUBLE AS segment_vmc_kn,
  total_length_m / nullif(total_time_s, 0) * 1.94384::DOUBLE AS course_vmc_kn,
  total_dist_m / nullif(total_time_s, 0) * 1.94384::DOUBLE AS course_speed_kn,
  {SAIL} AS point_of_sail,
  CAST(rank() OVER (PARTITION BY race_id, segment_no ORDER BY segment_time_s) AS INTEGER) AS rank_segment,
  CAST(rank() OVER (PARTITION BY race_id, segment_no ORDER BY day, start_s + segment_time_s) AS INTEGER) AS rank_segment_end
  FROM (SELECT s.*, w.temperature_c, w.pressure_hpa, w.humidity_pct, w.wind_speed_kn, w.t AS time_seconds, w.event_id AS reading,
    abs((wind_dir_site - heading_deg + 540) % 360 - 180) AS angle,
    row_number() OVER (PARTITION BY rid ORDER BY abs(start_s + segment_time_s / 2 - w.t), w.t,
      w.temperature_c DESC, w.pressure_hpa DESC) AS rn
  FROM {_RACED} s JOIN {_READ} w ON w.site = s.site AND w.day = s.day) WHERE rn = 1)"""


@query(f"""SELECT {_ID}, segment_time_s, segment_speed_kn, segment_vmc_kn, course_vmc_kn, course_speed_kn,
temperature_c, pressure_hpa, humidity_pct, wind_speed_kn, time_seconds, point_of_sail,
segment_speed_kn / nullif(wind_speed_kn, 0) AS speed_wind_ratio, rank_segment, rank_segment_end,
total_dist_m - total_length_m AS course_diff_m, segment_dist_m - segment_length_m AS segment_diff_m
FROM {ENRICHED}""")
def enriched_segments(spark, d):
    """Times, speeds, nearest weather, point of sail and ranks of every segment in one plan."""
    return enrich.enrich_segments(s.race_segments(spark, d), s.weather_table(spark, d)).select(
        *ID, "segment_time_s", "segment_speed_kn", "segment_vmc_kn", "course_vmc_kn", "course_speed_kn",
        "temperature_c", "pressure_hpa", "humidity_pct", "wind_speed_kn", "time_seconds", "point_of_sail",
        "speed_wind_ratio", "rank_segment", "rank_segment_end", "course_diff_m", "segment_diff_m",
    )


_CLOCK = "'%H:%M:%S'"
_AT = "(day + to_seconds(CAST({} AS BIGINT)))"
_LAYER = {
    "race_id": "race_id", "event_name": "'E' || (race_id % 10)", "event_location": "CAST(site * 0.5::DOUBLE + 40.125 AS VARCHAR) || ', ' || CAST(site * 0.25::DOUBLE + 3.5 AS VARCHAR)",
    "course": "'R' || (race_id % 7)", "race_date": "strftime(day, '%Y-%m-%d')", "wind_dir_site": "wind_dir_site", "athlete_name": "'C' || athlete_no", "serial_no": "serial_no",
    "total_time_s": "total_time_s", "total_length_m": "total_length_m", "total_dist_m": "total_dist_m", "total_efficiency_pct": "95.5::DOUBLE", "segment_no": "segment_no",
    "port_pct": "40.0::DOUBLE", "starboard_pct": "60.0::DOUBLE", "segment_time_s": "segment_time_s", "segment_dist_m": "segment_dist_m", "segment_length_m": "segment_length_m",
    "heading_deg": "heading_deg", "segment_efficiency_pct": "90.0::DOUBLE", "segment_start_clock": f"strftime({_AT.format('start_s')}, {_CLOCK})",
    "segment_end_clock": f"strftime({_AT.format('start_s + segment_time_s')}, {_CLOCK})", "rank_entry": "CAST(segment_no AS INTEGER)",
    "sex": "CASE WHEN serial_no % 2 = 0 THEN 'Men' ELSE 'Women' END", "age_class": "'U19'", "race_year": "CAST(year(day) AS INTEGER)", "race_month": "CAST(month(day) AS INTEGER)",
    "race_day": "CAST(day(day) AS INTEGER)", "segment_start": f"strftime({_AT.format('start_s')}, '%Y-%m-%d %H:%M:%S')",
    "segment_end": f"strftime({_AT.format('start_s + segment_time_s')}, '%Y-%m-%d %H:%M:%S')", "segment_date": "strftime(day, '%Y-%m-%d')",
    "segment_mid_clock": f"strftime({_AT.format('start_s')} + to_milliseconds(CAST(segment_time_s * 500 AS BIGINT)), '%H:%M:%S.%g')",
    "segment_speed_kn": "segment_speed_kn", "segment_vmc_kn": "segment_vmc_kn", "mid_seconds": "start_s + segment_time_s / 2", "day": "CAST(day(day) AS INTEGER)",
    "month": "CAST(month(day) AS INTEGER)", "year": "CAST(year(day) AS INTEGER)", "time": f"strftime({_AT.format('time_seconds')}, {_CLOCK})", "city": "'Site ' || site",
    "latitude": "site * 0.5::DOUBLE + 40.125", "longitude": "site * 0.25::DOUBLE + 3.5", "temperature_c": "temperature_c", "pressure_hpa": "pressure_hpa", "humidity_pct": "humidity_pct",
    "wind_speed_kn": "wind_speed_kn", "wind_dir_weather": "CAST(reading % 360 AS DOUBLE)", "rain_mm": "0.0::DOUBLE", "time_seconds": "time_seconds", "course_vmc_kn": "course_vmc_kn",
    "course_speed_kn": "course_speed_kn", "course_diff_m": "total_dist_m - total_length_m", "segment_diff_m": "segment_dist_m - segment_length_m", "point_of_sail": "point_of_sail",
    "speed_wind_ratio": "segment_speed_kn / nullif(wind_speed_kn, 0)", "rank_segment": "rank_segment", "rank_segment_end": "rank_segment_end",
}


@query(f"SELECT {', '.join(f'{v} AS {k}' for k, v in _LAYER.items())} FROM {ENRICHED}")
def processed_layer(spark, d):
    """The processed layer as it is written: 57 columns in their order, days and moments as text."""
    race = F.col("race_id")
    cleaned = s.race_segments(spark, d).withColumns({
        "event_name": F.concat(F.lit("E"), race % 10), "course": F.concat(F.lit("R"), race % 7), "athlete_name": F.concat(F.lit("C"), F.col("athlete_no")),
        "total_efficiency_pct": F.lit(95.5), "segment_efficiency_pct": F.lit(90.0), "port_pct": F.lit(40.0), "starboard_pct": F.lit(60.0),
        "rank_entry": F.col("segment_no").cast("int"), "sex": F.when(F.col("serial_no") % 2 == 0, "Men").otherwise("Women"), "age_class": F.lit("U19"),
    }).drop("athlete_no")
    layer = enrich.processed_layer(enrich.enrich_segments(cleaned, s.weather_table(spark, d)))
    return layer.withColumns({c: F.col(c).cast("string") for c, kind in layer.dtypes if kind in ("date", "timestamp", "timestamp_ntz")})


@query(f"""SELECT wind_bin, point_of_sail, count(*) AS n, CAST(sum(CAST(round(segment_vmc_kn, 4) AS DECIMAL(18,4))) AS DOUBLE) AS sum_vmc
FROM (SELECT *, CAST(floor(wind_speed_kn / 2) * 2 AS INTEGER) AS wind_bin FROM {ENRICHED})
WHERE wind_speed_kn >= 6 AND segment_vmc_kn IS NOT NULL GROUP BY 1, 2""")
def vmc_by_wind(spark, d):
    """VMC per wind bin and point of sail, of segments with their nearest weather: the flagship query."""
    timed = enrich.timed_segments(s.race_segments(spark, d)).select(
        *enrich.PLACE_KEYS, "mid_seconds", "segment_speed_kn", "segment_vmc_kn", "wind_dir_site", "heading_deg"
    )
    rows = (
        stage(timed, "timed")
        .transform(enrich.attach_weather, s.weather_table(spark, d))
        .transform(derived.sailing_angle)
        .transform(distributions.sailing_rows)
    )
    exact = F.round("segment_vmc_kn", 4).cast("decimal(18,4)")
    return rows.groupBy("wind_bin", "point_of_sail").agg(
        F.count("*").alias("n"), F.sum(exact).cast("double").alias("sum_vmc")
    )


# ---------------------------------------------------------------- lookups

_KIND = """(CASE WHEN event_type = 'purchase' AND user_id % 3 > 0 THEN event_type
  WHEN event_type = 'click' AND user_id % 3 = 1 THEN event_type END)"""


@query(f"""SELECT event_id, user_id, coalesce(kind, last, 'Senior') AS kind FROM (
  SELECT event_id, user_id, {_KIND} AS kind FROM events) e LEFT JOIN (
  SELECT user_id AS u, arg_max({_KIND}, event_id) FILTER ({_KIND} IS NOT NULL) AS last
  FROM events GROUP BY 1) k ON k.u = e.user_id""")
def fill_from_key(spark, d):
    kind = F.when((F.col("event_type") == "purchase") & (F.col("user_id") % 3 > 0), F.col("event_type"))
    kind = kind.when((F.col("event_type") == "click") & (F.col("user_id") % 3 == 1), F.col("event_type"))
    e = s.table(spark, d, "events").select("event_id", "user_id", kind.alias("kind"))
    return profile.fill_from_key(e, ["user_id"], "kind", F.col("event_id"), "Senior")


@query("""SELECT event_id, CASE WHEN value < 50 THEN CASE event_type WHEN 'view' THEN 'Men' WHEN 'click' THEN 'Women'
WHEN 'signup' THEN 'Women' END ELSE 'Men' END AS sex FROM events""")
def fill_from_lookup(spark, d):
    e = s.table(spark, d, "events").select(
        "event_id", F.concat(F.initcap("event_type"), F.lit(" Sailor")).alias("athlete_name"),
        F.when(F.col("value") >= 50, "Men").alias("sex"),
    )
    table = spark.createDataFrame(s.FIRST_NAMES, "first_name string, p_male double, p_female double")
    return profile.fill_sex(e, table).select("event_id", "sex")


@query("""SELECT c_custkey, n_regionkey * 10.5::DOUBLE AS lat, n_nationkey * 1.25::DOUBLE AS lon FROM customer
LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 0""")
def location_lookup(spark, d):
    places = s.table(spark, d, "nation").where("n_regionkey <> 0").select(
        F.col("n_nationkey").alias("c_nationkey"),
        (F.col("n_regionkey") * 10.5).alias("lat"), (F.col("n_nationkey") * 1.25).alias("lon"),
    )
    customers = s.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return profile.attach_location(customers, places, "c_nationkey").drop("c_nationkey")


# Common subsequence by rows: each row of the table is a running maximum.
def _pairs_sql(names_sql: str) -> str:
    return f"""(SELECT earlier, later, ord_earlier, ord_later, CAST(round(100 * 2.0 * lcs / total) AS INTEGER) AS score
FROM (SELECT *, length(earlier) + length(later) AS total, list_last(list_reduce(
  list_prepend(list_transform(range(length(later) + 1), lambda z: 0), list_transform(string_split(lower(earlier), ''), lambda ch:
    list_transform(range(length(later) + 1), lambda j: CASE WHEN j > 0 AND substr(lower(later), j, 1) = ch THEN 1 ELSE 0 END))),
  lambda row, eq: list_transform(range(1, length(later) + 2), lambda upto: list_max(list_transform(range(1, upto + 1), lambda j:
    greatest(row[j], CASE WHEN j > 1 THEN row[j - 1] + eq[j] ELSE 0 END)))))) AS lcs
FROM (SELECT a.name AS earlier, b.name AS later, a.ord AS ord_earlier, b.ord AS ord_later
  FROM {names_sql} a JOIN {names_sql} b ON a.ord < b.ord
  WHERE abs(length(a.name) - length(b.name)) <= 0.145 * (length(a.name) + length(b.name))))
WHERE round(100 * 2.0 * lcs / total) > 85)"""


def _canonical_sql(names_sql: str) -> str:
    return f"""(SELECT later, arg_max(CASE WHEN length(earlier) > length(later) THEN earlier ELSE later END,
  ord_earlier) AS canonical FROM {_pairs_sql(names_sql)} GROUP BY 1)"""


_NAMES = "(SELECT p_name || ' ' || p_type AS name, min(p_partkey) AS ord FROM part GROUP BY 1)"


def _part_names(spark, d):
    p = s.table(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("athlete_name"))
    return p


@query(f"SELECT * FROM {_pairs_sql(_NAMES)}")
def fuzzy_pairs(spark, d):
    return names.similar_pairs(names.distinct_names(_part_names(spark, d), "athlete_name", F.col("p_partkey")))


@query(f"""SELECT p_partkey, coalesce(canonical, p_name || ' ' || p_type) AS athlete_name FROM part
LEFT JOIN {_canonical_sql(_NAMES)} ON later = p_name || ' ' || p_type""")
def fuzzy_canonical(spark, d):
    return names.unify_names(_part_names(spark, d), "athlete_name", F.col("p_partkey"))


_SAILED = f"""(SELECT l_orderkey AS race_id, l_linenumber AS segment_no, l_suppkey AS serial_no, l_partkey AS athlete_no,
  (l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey AS o, p_name || ' ' || p_type AS name, e.sex, e.age_class,
  e.course FROM lineitem JOIN part ON p_partkey = l_partkey JOIN {EXTRACTED} e ON e.race_id = l_orderkey
  WHERE (e.raw IS NULL OR NOT regexp_matches(e.raw, 'abandon|recall', 'i'))
    AND (e.event_name <> 'EVENT 3' OR coalesce(regexp_matches(e.raw, 'IQFOIL', 'i'), FALSE)))"""


@query(f"""WITH sailed AS {_SAILED},
names AS (SELECT name, min(o) AS ord FROM sailed GROUP BY 1), canon AS {_canonical_sql("names")},
unified AS (SELECT s.*, coalesce(canonical, name) AS athlete_name FROM sailed s LEFT JOIN canon ON later = name),
known AS (SELECT serial_no AS ks, athlete_name AS kn, arg_max(age_class, o) AS last FROM unified
  WHERE age_class IS NOT NULL GROUP BY 1, 2)
SELECT race_id, segment_no, serial_no, athlete_no, athlete_name, course, sex,
  coalesce(age_class, last, 'Senior') AS age_class
FROM unified LEFT JOIN known ON ks = serial_no AND kn = athlete_name""")
def cleaned_segments(spark, d):
    """Names unified, excluded runs out, profile extracted and completed, in one plan."""
    return _cleaned(spark, d).select(*ID, "athlete_name", "course", "sex", "age_class")


def _cleaned(spark, d, counts=None):
    sailed = lookup_join(
        s.segments(spark, d).select(*ID),
        _part_names(spark, d).withColumnRenamed("p_partkey", "athlete_no"), ["athlete_no"], "inner",
    )
    race = s.courses(spark, d).select("race_id", "event_name", "course")
    order = (F.col("race_id") * 10 + F.col("segment_no")) * 10_000_000 + F.col("athlete_no")
    return enrich.clean_segments(
        lookup_join(sailed, race, ["race_id"], "inner"), order, rules={"EVENT 3": "IQFOIL"}, counts=counts
    )


@query(f"""WITH landed AS (SELECT e.raw, e.event_name FROM lineitem JOIN part ON p_partkey = l_partkey JOIN {EXTRACTED} e ON e.race_id = l_orderkey),
steps AS (SELECT count(*) AS a, count(*) FILTER (kept) AS b, count(*) FILTER (kept AND ruled) AS c FROM (
  SELECT raw IS NULL OR NOT regexp_matches(raw, 'abandon|recall', 'i') AS kept,
    event_name <> 'EVENT 3' OR coalesce(regexp_matches(raw, 'IQFOIL', 'i'), FALSE) AS ruled FROM landed))
SELECT 0 AS no, 'landed' AS step, a AS rows, 0::BIGINT AS removed FROM steps UNION ALL SELECT 1, 'excluded runs', b, a - b FROM steps
UNION ALL SELECT 2, 'event rules', c, b - c FROM steps""")
def clean_counts(spark, d):
    """Rows each cleaning step leaves and removes, counted while names are unified."""
    counts = StepCounts()
    _cleaned(spark, d, counts)
    return counts.table(spark)


# ---------------------------------------------------------------- places and hours

_VISITS = """(SELECT user_id % 25 * 1.11111::DOUBLE AS la, user_id % 25 * 0.5::DOUBLE AS lo, ts AS a,
  ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS b FROM events)"""
_RANGES = f"""(SELECT round(la, 4) AS lat, round(lo, 4) AS lon, CAST(min(a) AS DATE) AS first_day,
  CAST(max(b) AS DATE) AS last_day FROM {_VISITS} GROUP BY 1, 2)"""


def _visits(spark, d):
    site = F.col("user_id") % 25
    took = F.make_dt_interval(secs=F.floor(F.col("value") * 60).cast("decimal(18,6)"))
    located = s.table(spark, d, "events").select(
        F.concat((site * 1.11111).cast("string"), F.lit(", "), (site * 0.5).cast("string")).alias("event_location"),
        F.col("ts").alias("segment_start"), (F.col("ts") + took).alias("segment_end"),
    )
    return weather.parse_coordinates(located)


def _ranges(spark, d):
    return weather.location_ranges(_visits(spark, d))


@query(f"""SELECT lat, lon, strftime(first_day, '%Y-%m-%d') AS first_day, strftime(last_day, '%Y-%m-%d') AS last_day,
'Location (' || CAST(lat AS VARCHAR) || ', ' || CAST(lon AS VARCHAR) || ')' AS city FROM {_RANGES}""")
def location_ranges(spark, d):
    days = {c: F.col(c).cast("string") for c in ("first_day", "last_day")}
    return _ranges(spark, d).withColumns(days)


@query(f"""SELECT lat, lon, strftime(day, '%Y-%m-%d') AS day, CAST(hour AS INTEGER) AS hour FROM (
  SELECT lat, lon, unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS day FROM {_RANGES}),
  (SELECT unnest(range(8, 21)) AS hour)""")
def hour_spine(spark, d):
    return weather.hour_spine(_ranges(spark, d)).select("lat", "lon", F.col("day").cast("string").alias("day"), "hour")


_ISLANDS = f"""(SELECT lat, lon, min(a) AS first_time, max(b) AS last_time FROM (
  SELECT *, sum(CASE WHEN reached >= date_trunc('hour', a) THEN 0 ELSE 1 END) OVER (PARTITION BY lat, lon ORDER BY a, b, k) AS island FROM (
    SELECT *, max(b) OVER (PARTITION BY lat, lon ORDER BY a, b, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM (
      SELECT round(la, 4) AS lat, round(lo, 4) AS lon, a, greatest(a, b) AS b, row_number() OVER () AS k FROM {_VISITS})))
  GROUP BY lat, lon, island)"""


@query(f"""SELECT DISTINCT lat, lon, strftime(h, '%Y-%m-%d') AS day, CAST(hour(h) AS INTEGER) AS hour FROM (
  SELECT lat, lon, unnest(generate_series(date_trunc('hour', first_time), date_trunc('hour', last_time), INTERVAL 1 HOUR)) AS h FROM {_ISLANDS})
  WHERE hour(h) BETWEEN 8 AND 20""")
def hour_islands(spark, d):
    """Hours to be fetched only inside the times that visits cover."""
    found = weather.hour_islands(weather.occupied_intervals(_visits(spark, d)))
    return found.select("lat", "lon", F.col("day").cast("string").alias("day"), "hour")


# ---------------------------------------------------------------- measures


@query(f"SELECT {_ID}, segment_speed_kn, segment_vmc_kn FROM {SPEEDS}")
def segment_speed(spark, d):
    return derived.segment_speeds(s.segments(spark, d)).select(*ID, "segment_speed_kn", "segment_vmc_kn")


@query(f"""SELECT race_id, total_length_m / nullif(total_time_s, 0) * 1.94384::DOUBLE AS course_vmc_kn,
total_dist_m / nullif(total_time_s, 0) * 1.94384::DOUBLE AS course_speed_kn FROM {COURSES}""")
def course_speed(spark, d):
    return derived.course_speeds(s.courses(spark, d)).select("race_id", "course_vmc_kn", "course_speed_kn")


def _with_course(spark, d):
    totals = s.courses(spark, d).select("race_id", "total_length_m", "total_dist_m")
    return s.segments(spark, d).join(totals, "race_id")


_WITH_COURSE = f"(SELECT s.*, total_length_m, total_dist_m FROM {SEG} s JOIN {COURSES} c ON c.race_id = s.race_id)"


@query(f"""SELECT {_ID}, total_dist_m - total_length_m AS course_diff_m,
segment_dist_m - segment_length_m AS segment_diff_m FROM {_WITH_COURSE}""")
def distance_diff(spark, d):
    return derived.distance_diffs(_with_course(spark, d)).select(*ID, "course_diff_m", "segment_diff_m")


@query(f"""SELECT {_ID}, segment_length_m / nullif(segment_dist_m, 0) * 100 AS segment_efficiency_pct,
total_dist_m / nullif(total_length_m, 0) * 100 AS total_efficiency_pct FROM {_WITH_COURSE}""")
def segment_efficiency(spark, d):
    return derived.efficiencies(_with_course(spark, d)).select(
        *ID, "segment_efficiency_pct", "total_efficiency_pct"
    )


@query(f"SELECT {_ID}, segment_speed_kn / nullif(wind_speed_kn, 0) AS speed_wind_ratio FROM {SPEEDS}")
def speed_wind_ratio(spark, d):
    return derived.wind_ratio(derived.segment_speeds(s.segments(spark, d))).select(*ID, "speed_wind_ratio")


@query(f"SELECT {_ID}, {SAIL} AS point_of_sail FROM {SPEEDS}")
def point_of_sail(spark, d):
    return derived.sailing_angle(s.segments(spark, d)).select(*ID, "point_of_sail")


@query(f"""SELECT {_ID}, segment_time_s,
CAST(rank() OVER (PARTITION BY race_id, segment_no ORDER BY segment_time_s) AS INTEGER) AS rank_segment FROM {SEG}""")
def rank_segment(spark, d):
    return derived.rank_segment(s.segments(spark, d)).select(*ID, "segment_time_s", "rank_segment")


@query(f"""SELECT {_ID}, CAST(rank() OVER (PARTITION BY race_id ORDER BY segment_time_s) AS INTEGER) AS rank_segment,
CAST(rank() OVER (PARTITION BY race_id ORDER BY
segment_start + to_seconds(CAST(segment_time_s AS BIGINT))) AS INTEGER) AS rank_segment_end FROM {SEG}""")
def rank_segment_end(spark, d):
    took = F.make_dt_interval(secs=F.col("segment_time_s").cast("decimal(18,6)"))
    ended = s.segments(spark, d).withColumn("segment_end", F.col("segment_start") + took)
    return derived.segment_ranks(ended, ["race_id"]).select(*ID, "rank_segment", "rank_segment_end")


@query(f"""SELECT round(corr(segment_vmc_kn, rank_segment), 6) AS r FROM (SELECT *,
rank() OVER (PARTITION BY race_id, segment_no ORDER BY segment_time_s) AS rank_segment FROM {SPEEDS})
WHERE segment_vmc_kn IS NOT NULL""")
def vmc_rank_corr(spark, d):
    ranked = derived.rank_segment(derived.segment_speeds(s.segments(spark, d)))
    return ranked.agg(F.round(F.corr("segment_vmc_kn", "rank_segment"), 6).alias("r"))


# ---------------------------------------------------------------- distributions

_BINNED = f"""(SELECT *, CAST(floor(wind_speed_kn / 2) * 2 AS INTEGER) AS wind_bin FROM (
  SELECT *, {SAIL} AS point_of_sail FROM {SPEEDS})
  WHERE wind_speed_kn >= 6 AND segment_speed_kn IS NOT NULL AND segment_vmc_kn IS NOT NULL)"""


def _sailing(spark, d, **kw):
    seg = s.segments(spark, d).transform(derived.segment_speeds).transform(derived.sailing_angle)
    return distributions.sailing_rows(seg, **kw)


@query(f"""SELECT {_ID}, wind_speed_kn, CAST(floor(wind_speed_kn / 2) * 2 AS INTEGER) AS wind_bin,
CASE WHEN wind_speed_kn < (SELECT ceil(max(wind_speed_kn) / 2) * 2 FROM {SEG})
  THEN floor(wind_speed_kn / 2) * 2 END AS strict_bin FROM {SEG}""")
def wind_bin(spark, d):
    seg = s.segments(spark, d).select(*ID, "wind_speed_kn")
    strict = distributions.with_wind_bin(seg, strict_edges=True)
    return distributions.with_wind_bin(
        strict.withColumn("strict_bin", F.col("wind_bin").cast("double")).drop("wind_bin")
    )


@query(f"""SELECT wind_bin, point_of_sail, CAST(floor(segment_speed_kn) AS INTEGER) AS speed_lo, count(*) AS n
FROM {_BINNED} GROUP BY 1, 2, 3""")
def speed_histogram(spark, d):
    return distributions.speed_histogram(_sailing(spark, d))


@query(f"""WITH b AS {_BINNED},
spine AS (SELECT wind_bin, point_of_sail, unnest(range(0, CAST(ceil(max(segment_speed_kn)) AS BIGINT))) AS vmc_lo
  FROM b GROUP BY 1, 2),
counts AS (SELECT wind_bin, point_of_sail, CAST(floor(segment_vmc_kn) AS BIGINT) AS vmc_lo, count(*) AS n FROM b GROUP BY 1, 2, 3)
SELECT s.wind_bin, s.point_of_sail, CAST(s.vmc_lo AS INTEGER) AS vmc_lo, s.vmc_lo + 0.5::DOUBLE AS vmc_mid,
  coalesce(c.n, 0) AS n FROM spine s LEFT JOIN counts c
  ON c.wind_bin = s.wind_bin AND c.point_of_sail = s.point_of_sail AND c.vmc_lo = s.vmc_lo""")
def vmc_histogram_dense(spark, d):
    return distributions.vmc_curve(_sailing(spark, d))


# ---------------------------------------------------------------- features and models


@query("""SELECT event_id, round(sin(radians(user_id % 361)), 9) AS angle_sin,
round(cos(radians(user_id % 361)), 9) AS angle_cos FROM events""")
def circular_encode(spark, d):
    e = s.table(spark, d, "events").select("event_id", (F.col("user_id") % 361).alias("angle"))
    return features.circular_encode(e, "angle").withColumns({
        c: F.round(c, 9) for c in ("angle_sin", "angle_cos")
    })


@query("""SELECT event_id, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS kind_click,
CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS kind_purchase,
CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS kind_signup,
CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS kind_view FROM events""")
def one_hot(spark, d):
    e = s.table(spark, d, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("kind"))
    return features.one_hot(e, {"kind": ["click", "purchase", "signup", "view"]})


_HASH = "('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '{}'), 1, 8))::BIGINT"


@query(f"""SELECT {_HASH.format(':13')} % 100 < 80 AS is_train, CAST({_HASH.format(':fold13')} % 3 AS INTEGER) AS fold,
count(*) AS n FROM lineitem GROUP BY 1, 2""")
def split_hash(spark, d):
    key = F.col("race_id")
    seg = features.with_fold(features.with_split(s.segments(spark, d).select("race_id"), key), key)
    return seg.groupBy("is_train", "fold").agg(F.count("*").alias("n"))


@query("""SELECT count(*) AS n, round(avg(abs(e)), 6) AS mae, round(avg(e * e), 6) AS mse, round(sqrt(avg(e * e)), 6) AS rmse,
round(1 - sum(e * e) / (var_pop(l_quantity) * count(*)), 6) AS r2
FROM (SELECT l_quantity, l_quantity - l_extendedprice / 2000 AS e FROM lineitem)""")
def regression_metrics(spark, d):
    li = s.table(spark, d, "lineitem")
    m = model.regression_metrics(li, F.col("l_quantity"), F.col("l_extendedprice") / 2000)
    return m.select("n", *[F.round(c, 6).alias(c) for c in ("mae", "mse", "rmse", "r2")])


_PROCESSED = f"""(SELECT s.*, {SAIL} AS point_of_sail, segment_no AS rank_entry,
  CASE serial_no % 3 WHEN 0 THEN 'Men' WHEN 1 THEN 'Women' END AS sex,
  CASE serial_no % 4 WHEN 0 THEN 'U17' WHEN 1 THEN 'U19' WHEN 2 THEN 'U19' ELSE 'Senior' END AS age_class,
  CAST(rank() OVER (PARTITION BY race_id ORDER BY segment_time_s) AS INTEGER) AS rank_segment FROM {SPEEDS} s)"""


def _processed(spark, d):
    """Segments with the columns of the processed layer that models read."""
    serial = F.col("serial_no")
    seg = (
        s.segments(spark, d).transform(derived.segment_speeds).transform(derived.sailing_angle)
        .withColumns({
            "sex": F.when(serial % 3 == 0, "Men").when(serial % 3 == 1, "Women"),
            "age_class": F.when(serial % 4 == 0, "U17").when(serial % 4 < 3, "U19").otherwise("Senior"),
            "rank_entry": F.col("segment_no"),
            "temperature_c": F.col("segment_length_m") / 50,
            "pressure_hpa": F.col("athlete_no") % 60 + 980,
            "humidity_pct": serial % 100,
            "rain_mm": F.lit("0,5"),
        })
    )
    return derived.rank_segment(seg, ["race_id"])


_HOT = ", ".join(
    f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\""
    for c, vs in {
        "sex": ["Men", "Women"], "age_class": ["U17", "U19"],
        "point_of_sail": ["Allures portantes", "Allures remontantes", "Reaching", "Vent arrière", "Vent debout"],
    }.items() for v in vs
)


@query(f"""SELECT {_ID}, wind_speed_kn, segment_length_m / 50 AS temperature_c, CAST(serial_no % 100 AS DOUBLE) AS humidity_pct,
CAST(rank_entry AS DOUBLE) AS rank_entry, CAST(rank_segment AS DOUBLE) AS rank_segment,
round(sin(radians(wind_dir_site)), 9) AS wind_dir_site_sin, round(cos(radians(wind_dir_site)), 9) AS wind_dir_site_cos, {_HOT}
FROM {_PROCESSED} WHERE age_class IN ('U17', 'U19') AND sex IS NOT NULL""")
def model_matrix(spark, d):
    m = features.model_matrix(_processed(spark, d), "rank_v2", keep=ID)
    return m.withColumns({c: F.round(c, 9) for c in ("wind_dir_site_sin", "wind_dir_site_cos")})


def _split(spark, d):
    m = features.model_matrix(_processed(spark, d), "rank_v2", keep=ID)
    names_ = features.feature_names(m, "rank_segment", ID)
    key = F.col("race_id")
    return stage(features.with_fold(features.with_split(m, key), key), "matrix"), names_


SMALL = {"n_estimators": 8, "max_depth": 5, "min_samples_leaf": 2, "max_features": "sqrt"}


@query()
def rf_predict(spark, d):
    """Forest fitted on the training part of all segments, evaluated on the held-out part."""
    data, names_ = _split(spark, d)
    fitted = model.fit_forest(data.where("is_train"), names_, "rank_segment", SMALL)
    pred = model.predict(fitted, data.where("not is_train"), names_, "rank_segment")
    return model.regression_metrics(pred)


@query()
def rf_importance(spark, d):
    data, names_ = _split(spark, d)
    fitted = model.fit_forest(data.where("is_train"), names_, "rank_segment", SMALL)
    return model.importances(spark, fitted, names_)


@query()
def rf_grid(spark, d):
    """Cross-validated R2 of each point of a small grid over all training rows."""
    data, names_ = _split(spark, d)
    found = model.grid_search(
        data.where("is_train"), names_, "rank_segment",
        {"n_estimators": [4], "max_depth": [3, 5], "min_samples_leaf": [2], "max_features": ["sqrt"]},
    )
    rows = [(str(sorted(point.items())), score, point == found.best) for point, score in found.scores]
    return spark.createDataFrame(rows, "point string, cv_r2 double, is_best boolean")


@query(f"""SELECT count(*) FILTER (NOT train) AS held_out, CAST(15 AS BIGINT) AS features,
1.0::DOUBLE AS importance, CAST(4 AS BIGINT) AS points, true AS best_is_a_point
FROM (SELECT {_HASH.format(':13').replace('l_orderkey', 'race_id')} % 100 < 80 AS train FROM {_PROCESSED}
WHERE age_class IN ('U17', 'U19') AND sex IS NOT NULL)""")
def rf_facts(spark, d):
    """What must hold for any forest of these rows: held-out rows, whole importances, a score per point."""
    data, names_ = _split(spark, d)
    train_rows, test_rows = data.where("is_train"), data.where("not is_train")
    found = model.grid_search(train_rows, names_, "rank_segment", {**{k: [v] for k, v in SMALL.items()}, "min_samples_split": [2, 4], "max_depth": [3, 5]})
    m = model.regression_metrics(model.predict(found.model, test_rows, names_, "rank_segment"))
    total = round(float(sum(found.model.featureImportances.toArray())), 9)
    return m.select(
        F.col("n").alias("held_out"), F.lit(len(names_)).cast("bigint").alias("features"), F.lit(total).alias("importance"),
        F.lit(len(found.scores)).cast("bigint").alias("points"), F.lit(found.best in [p for p, _ in found.scores]).alias("best_is_a_point"))
