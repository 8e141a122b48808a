"""Queries over documents, pages and payloads, and over growing tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from windward.functions import text
from windward.operators import filters, upsert
from windward.plans import collect, enrich
from windward.plans import standins as s
from windward.plans.registry import query
from windward.schemas import WEATHER_KEY
from windward.session import run_dir
from windward.sources import race_pages, race_xml, weather_json
from windward.streaming import ingest
from windward.streaming.log_table import read_batches, read_latest


_XML_RACE = """CAST(o_orderkey AS VARCHAR) AS race_id, 'E' || (o_custkey % 50) AS event_name, o_orderstatus AS event_location,
  o_orderpriority AS course, '2024-05-01' AS race_date, CAST(o_orderkey % 360 AS VARCHAR) AS wind_dir_site"""
_XML_RACER = {
    "athlete_name": "'C' || o_custkey || CASE WHEN o_orderkey % 11 = 0 AND o_orderkey % 7 > 0 THEN '</StatisticheDato>' ELSE '' END",
    "serial_no": "o_orderkey", "total_time_s": "o_custkey", "total_length_m": "o_orderkey % 1000", "total_dist_m": "o_orderkey % 1000 + 7",
    "start_position": "o_orderkey % 30", "total_efficiency_pct": "'101,25'", "max_speed_kn": "o_custkey % 31", "max_vmg": "o_custkey % 29",
    "max_vmc": "o_custkey % 23", "avg_vmg": "o_custkey % 19", "avg_vmc": "o_custkey % 17", "avg_speed_kn": "o_custkey % 10",
}
_XML_SEGMENT = {
    "segment_no": "i", "port_pct": "i * 10", "starboard_pct": "100 - i * 10", "segment_time_s": "o_custkey % 90 + i", "segment_dist_m": "o_custkey + i",
    "segment_length_m": "CASE WHEN i = 1 THEN o_custkey ELSE 100 END", "heading_deg": "o_custkey * i % 360",
    "segment_efficiency_pct": "CASE WHEN i > 0 THEN '97,5' END",
    "segment_start_clock": "CASE WHEN i < 3 THEN strftime(make_timestamp((o_custkey * 60 + i) * 1000000), '%H:%M:%S') END",
    "segment_end_clock": "CASE WHEN i > 0 THEN strftime(make_timestamp((o_custkey * 60 + i + 30) * 1000000), '%H:%M:%S') END",
    "rank_entry": "i + 1", "rank_exit_scraped": "i + 2",
}
_XML_ALL = ", ".join(f"CAST({v} AS VARCHAR) AS {k}" for k, v in (_XML_RACER | _XML_SEGMENT).items())
_XML_BARE = ", ".join("'N/A'" if k == "athlete_name" else "'0'" if k == "serial_no" else "NULL" for k in _XML_RACER | _XML_SEGMENT)


@query(f"""SELECT {_XML_RACE}, {_XML_ALL} FROM orders LEFT JOIN (SELECT unnest([1, 2, 3]) AS i) k ON k.i <= o_orderkey % 4
UNION ALL SELECT {_XML_RACE}, {_XML_BARE} FROM orders WHERE o_orderkey % 3 = 0""")
def xml_explode(spark, d):
    return race_xml.parse_races(s.race_xml(spark, d))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS race_id, CASE o_orderkey % 7 WHEN 0 THEN 'null'
WHEN 2 THEN 'no racer' WHEN 4 THEN 'no racer' ELSE 'not well-formed' END AS reason FROM orders WHERE o_orderkey % 7 < 6""")
def xml_rejects(spark, d):
    """Documents that give no rows, each with its reason."""
    kind = F.col("race_id").cast("bigint") % 7
    broken = (
        F.when(kind == 0, F.lit(None)).when(kind == 1, F.replace("xml", F.lit("</ArrayOfDato>"), F.lit("")))
        .when(kind == 2, F.lit("<ArrayOfDato><Other/></ArrayOfDato>")).when(kind == 3, F.replace("xml", F.lit("Seriale>"), F.lit("q:Seriale>")))
        .when(kind == 4, F.concat(F.lit("<a xmlns='http://a/'>"), race_xml.strip_envelope(F.col("xml")), F.lit("</a>")))
        .when(kind == 5, F.replace("xml", F.lit("<Segments>"), F.lit("<Segments> & "))).otherwise(F.col("xml"))
    )
    races = s.race_xml(spark, d).select("race_id", broken.alias("xml"))
    return race_xml.rejected_races(races).select("race_id", "reason")


_STATUS = """CASE WHEN page_id % 7 = 0 THEN 'known' WHEN page_id % 5 = 0 THEN 'no token' WHEN page_id % 9 = 0 THEN 'no document'
WHEN page_id % 4 >= 2 THEN 'no event' WHEN page_id % 3 = 0 THEN 'not well-formed' ELSE 'new' END"""
_LINKS = f"""SELECT CAST(page_id AS VARCHAR) AS race_id, {_STATUS} AS status FROM pages
UNION ALL SELECT CAST(page_id AS VARCHAR), CASE WHEN page_id % 7 > 0 AND page_id % 5 > 0 AND page_id % 9 > 0 AND page_id % 4 < 2 THEN 'repeated' ELSE {_STATUS} END
FROM pages WHERE page_id % 8 = 0
UNION ALL SELECT NULL, 'no token' FROM pages WHERE page_id % 10 = 3"""


def _races(spark, d):
    """Saved pages as races: some known, some without token, event or sound document, some landed twice, some asked for by two links.

    Further links have no race id.
    """
    pages = s.page_scripts(spark, d).select(
        "page_id", F.col("page_id").cast("string").alias("race_id"), "html", F.concat(F.lit("Wind "), F.col("page_id") % 360, F.lit("°")).alias("wind"))
    i = F.col("page_id")

    def landing(initial: str, day: str, part):
        xml = F.concat(F.lit(f"<a><StatisticheDato><Nome>{initial}"), i, F.lit("</Nome><cInfoRaceSegment><SegNum>1</SegNum></cInfoRaceSegment></StatisticheDato>"))
        return pages.where(part).select(
            "race_id", F.when(i % 3 == 0, xml).otherwise(F.concat(xml, F.lit("</a>"))).alias("xml"), F.lit(day).cast("timestamp").alias("landed"))

    # The earlier landing has the greater text.
    documents = landing("N", "2024-05-02", i % 9 != 0).union(landing("Z", "2024-05-01", (i % 9 != 0) & (i % 2 == 0)))
    link = lambda end: F.concat(F.lit("https://races.example/?"), i, F.lit(end))
    requests = pages.select("race_id", (i % 5 != 0).alias("ok"), link("").alias("url")).union(
        pages.where(i % 8 == 0).select("race_id", i % 5 != 0, link("&again"))).union(
        pages.where(i % 10 == 3).select(F.lit(None), F.lit(False), F.concat(F.lit("https://races.example/p"), i)))
    return collect.assemble_races(requests, pages, documents, pages.where(i % 7 == 0).select("race_id"))


@query(f"""SELECT CAST(page_id AS VARCHAR) AS race_id, 'E' || n AS event_name, 'R' || n AS course,
CAST(page_id % 360 AS DOUBLE) AS wind_dir_site, 'N' || page_id AS athlete_name, 1 AS segment_no
FROM (SELECT page_id, regexp_extract(html, 'track\\(([0-9]+)\\);', 1) AS n, {_STATUS} AS status FROM pages) WHERE status = 'new'""")
def race_assembly(spark, d):
    """Page, document and request of each new race brought together, and its segments typed; the document landed last counts."""
    return collect.bronze_segments(_races(spark, d)).select("race_id", "event_name", "course", "wind_dir_site", "athlete_name", "segment_no")


@query(f"SELECT race_id, status, status IN ('known', 'new', 'repeated') AS ok FROM ({_LINKS})")
def ingest_log(spark, d):
    return collect.ingest_log(_races(spark, d)).drop("link")


@query(f"""SELECT count(*) AS total, count(*) FILTER (status IN ('known', 'new', 'repeated')) AS succeeded,
count(*) FILTER (status NOT IN ('known', 'new', 'repeated')) AS failed FROM ({_LINKS})""")
def ingest_report(spark, d):
    """The run report, from the log of a run: every link counts."""
    return filters.run_report(collect.ingest_log(_races(spark, d)), F.col("ok"))


@query("""SELECT day, month, year, city, n AS hours, last FROM (SELECT day(ts)::INTEGER AS day, month(ts)::INTEGER AS month, year(ts)::INTEGER AS year,
'Site ' || CAST(user_id % 25 AS VARCHAR) AS city, count(DISTINCT strftime(ts, '%H')) AS n, arg_max(value, event_id) AS last
FROM events GROUP BY ALL)""")
def weather_latest(spark, d):
    """Readings written again and again: the last one of each hour counts, and with it the last of the day."""
    w = s.site_events(spark, d).select(
        F.dayofmonth("ts").alias("day"), F.month("ts").alias("month"), F.year("ts").alias("year"), F.date_format("ts", "HH:00:00").alias("time"),
        F.concat(F.lit("Site "), F.col("site").cast("string")).alias("city"), "event_id", "value")
    latest = enrich.latest_weather(w, ["event_id"])
    return latest.groupBy("day", "month", "year", "city").agg(F.count("*").alias("hours"), F.max_by("value", "event_id").alias("last"))


@query("SELECT o_orderkey, '<a>' || o_orderpriority || '</a>' AS body FROM orders")
def xml_envelope(spark, d):
    whole = F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?>\n<string xmlns="http://a/">'),
        F.lit("<a>"), "o_orderpriority", F.lit("</a>"), F.lit("</string>\n"),
    )
    return s.table(spark, d, "orders").select("o_orderkey", race_xml.strip_envelope(whole).alias("body"))


@query("""SELECT page_id, CASE WHEN page_id % 4 < 2 THEN 'E' || n ELSE 'N/A' END AS event_name,
CASE WHEN page_id % 4 < 2 THEN 'R' || n ELSE 'N/A' END AS course, CASE WHEN page_id % 4 = 0 THEN 'D' || n ELSE 'N/A' END AS race_date
FROM (SELECT page_id, regexp_extract(html, 'track\\(([0-9]+)\\);', 1) AS n FROM pages)""")
def script_json(spark, d):
    return race_pages.page_info(s.page_scripts(spark, d)).drop("html")


@query("""SELECT DISTINCT replace(unnest(regexp_extract_all(html, 'href="(/[^"]*)"', 1)), '&amp;', '&') AS url
FROM pages ORDER BY 1""")
def url_extract_distinct(spark, d):
    return race_pages.extract_links(
        s.table(spark, d, "pages").select("html"), pattern=r'href="(/[^"]*)"', group=1
    )


_QUERY = "nullif(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '')"


@query(f"""SELECT page_id, {_QUERY} AS query_text,
nullif(regexp_extract({_QUERY}, '(^|&)page=([^&]+)', 2), '') AS page,
nullif(regexp_extract({_QUERY}, '(^|&)utm_source=([^&]+)', 2), '') AS source FROM pages""")
def url_params(spark, d):
    u = F.col("url")
    return s.table(spark, d, "pages").select(
        "page_id", text.query_string(u).alias("query_text"),
        text.query_param(u, "page").alias("page"), text.query_param(u, "utm_source").alias("source"),
    )


@query("""SELECT page_id, 'https://stats.example.org/' ||
CASE WHEN page_id % 2 = 0 THEN '(S(k' || CAST(page_id AS VARCHAR) || '))' ELSE '' END ||
'/Stats.asmx/getStatistiche?idgara=' || CAST(page_id AS VARCHAR) || '&token=t' AS stats_url FROM pages""")
def url_build(spark, d):
    p = F.col("page_id").cast("string")
    inside = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/(S(k"), p, F.lit("))"))).otherwise(F.lit(""))
    url = F.concat("url", inside)
    return s.table(spark, d, "pages").select(
        "page_id", text.stats_url(url, p, F.lit("t"), "stats.example.org", "Stats.asmx").alias("stats_url")
    )


@query("""SELECT event_id,
CASE WHEN event_type IN ('click', 'purchase') THEN round(value, 2) ELSE 0.0::DOUBLE END AS temperature_c,
round(value * 1.94384::DOUBLE, 2) AS wind_speed_kn, k AS pressure_hpa, k AS humidity_pct,
CAST(k AS DOUBLE) AS wind_dir_weather, CASE WHEN event_type = 'click' THEN 0.0::DOUBLE ELSE value END AS rain_mm
FROM (SELECT *, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k FROM events)
WHERE event_type <> 'error'""", name="weather_json")
def weather_json_rows(spark, d):
    return weather_json.parse_payload(s.payloads(spark, d)).drop("ts", "user_id")


# ---------------------------------------------------------------- growing tables


@query("""SELECT o_orderkey, o_totalprice, NULL AS o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'""")
def append_align(spark, d):
    o = s.table(spark, d, "orders")
    return upsert.append_aligned(
        o.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"),
        o.where("o_orderstatus <> 'F'").select("o_orderpriority", "o_orderkey"),
    )


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
ORDER BY (o_orderstatus = 'O')::INT DESC, o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def upsert_keep_last(spark, d):
    o = s.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    return upsert.upsert(
        o.where("o_orderstatus <> 'O'"), o.where("o_orderstatus = 'O'"),
        ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")],
    ).select("o_custkey", "o_orderkey", "o_totalprice")


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN
(SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def anti_incremental(spark, d):
    o = s.table(spark, d, "orders")
    return upsert.not_yet_known(
        o.select("o_orderkey", "o_custkey"), o.where("o_orderstatus = 'P'"), "o_custkey"
    )


def _in_three_batches(spark, table, part, folder):
    """The rows landed in three parts by ``part``, one after the other."""
    for k in range(3):
        table.where(part == k).write.mode("append").parquet(folder)
        yield ingest.file_stream(spark, folder, table.schema, "*.parquet")


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (
PARTITION BY user_id, event_type ORDER BY event_id % 3 DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def stream_upsert(spark, d):
    """Events as a stream landed in a table of three batches; its current state is read back."""
    events, root = s.table(spark, d, "events"), run_dir(spark, "upsert")
    for stream in _in_three_batches(spark, events, F.col("event_id") % 3, f"{root}/landing"):
        ingest.upsert_stream(stream, f"{root}/table", f"{root}/checkpoint")
    latest = read_latest(spark, f"{root}/table", events.schema, ["user_id", "event_type"], ["event_id"])
    return latest.select("user_id", "event_type", "event_id", "value")


@query("""SELECT day, month, year, time, city, temperature_c, pressure_hpa, wind_speed_kn FROM (SELECT *, row_number() OVER (
PARTITION BY day, month, year, time, city ORDER BY part DESC, event_id DESC) AS rn FROM (
SELECT day(ts)::INTEGER AS day, month(ts)::INTEGER AS month, year(ts)::INTEGER AS year, strftime(ts, '%H:00:00') AS time, event_id, event_id % 3 AS part,
'Site ' || CAST(user_id % 25 AS VARCHAR) AS city, value AS temperature_c, (event_id % 100 + 950)::INTEGER AS pressure_hpa, round(value % 20, 2) AS wind_speed_kn
FROM events)) WHERE rn = 1""")
def upsert_partitions(spark, d):
    """Weather readings in three batches brought in place into a table partitioned by day: the last write of each hour stays."""
    readings = s.weather_table(spark, d, "event_id", time=F.date_format("ts", "HH:00:00"))
    root, day = run_dir(spark, "in-place"), ["year", "month", "day"]
    for stream in _in_three_batches(spark, readings, F.col("event_id") % 3, f"{root}/landing"):
        ingest.upsert_in_place(stream, f"{root}/table", f"{root}/checkpoint", WEATHER_KEY, ["event_id"], day)
    table = s.read_table(spark, f"{root}/table", readings.schema)
    return table.select(*WEATHER_KEY, "temperature_c", "pressure_hpa", "wind_speed_kn")


@query("""SELECT 'o' || o_orderkey AS race_id, CAST(i AS INTEGER) AS segment_no, 'C' || o_custkey AS athlete_name, o_orderkey % 2 AS batch_id
FROM orders CROSS JOIN (SELECT unnest([1, 2]) AS i) WHERE o_orderkey % 7 > 0""")
def stream_races(spark, d):
    """Race documents in three landings, the last one with all of them again: each race gives its segments once, broken ones none."""
    orders, root = s.table(spark, d, "orders"), run_dir(spark, "races")
    i = F.col("o_orderkey")
    segment = lambda n: F.lit(f"<cInfoRaceSegment><SegNum>{n}</SegNum></cInfoRaceSegment>")
    xml = F.concat(F.lit("<a><StatisticheDato><Nome>C"), "o_custkey", F.lit("</Nome>"), segment(1), segment(2), F.lit("</StatisticheDato>"),
                   F.when(i % 7 > 0, "</a>").otherwise(""))
    documents = orders.select(i, F.concat(F.lit("in/o"), i, F.lit(".xml")).alias("path"), F.timestamp_seconds(i).alias("landed"), xml.alias("xml"))
    for part in (i % 2 == 0, i % 2 == 1, F.lit(True)):
        documents.where(part).drop("o_orderkey").write.mode("append").parquet(f"{root}/landing")
        stream = ingest.file_stream(spark, f"{root}/landing", documents.drop("o_orderkey").schema, "*.parquet")
        ingest.ingest_races(stream, f"{root}/table", f"{root}/checkpoint")
    schema = "race_id string, segment_no int, athlete_name string"
    return read_batches(spark, f"{root}/table", StructType.fromDDL(schema))


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 0::BIGINT ELSE 1 END AS batch_id FROM orders")
def stream_ingest(spark, d):
    """Two landings, the second with all races: each race is processed once."""
    orders = s.table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    root = run_dir(spark, "ingest")
    landing = f"{root}/landing"
    for landed in (orders.where("o_orderstatus = 'F'"), orders):
        landed.write.mode("append").parquet(landing)
        stream = ingest.file_stream(spark, landing, orders.schema, "*.parquet")
        ingest.ingest_new(stream, f"{root}/table", f"{root}/checkpoint", "o_orderkey")
    return read_batches(spark, f"{root}/table", orders.schema)
