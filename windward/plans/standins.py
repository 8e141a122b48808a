"""Segments, courses, payloads and weather derived from the given tables.

Each function reads whole tables and only renames or computes columns, so that
the operators run on every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windward.schemas import WEATHER_HOURLY
from windward.sources.tables import read_table

FIRST_NAMES = [("view", 0.9, 0.1), ("Click", 0.2, 0.8), ("error", 0.5, 0.5), ("signup", None, 0.3)]
SITES = 25
DAYS = 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sailed segments; a third of a percent of them take zero seconds."""
    length = F.col("l_extendedprice") / 100
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("race_id"),
        F.col("l_linenumber").alias("segment_no"),
        F.col("l_suppkey").alias("serial_no"),
        F.col("l_partkey").alias("athlete_no"),
        length.alias("segment_length_m"),
        (length * (1 + F.col("l_discount"))).alias("segment_dist_m"),
        (F.col("l_quantity") - 1).alias("segment_time_s"),
        (F.col("l_partkey") % 360).cast("double").alias("heading_deg"),
        (F.col("l_suppkey") * 37 % 360).cast("double").alias("wind_dir_site"),
        ((F.col("l_discount") + F.col("l_tax")) * 100).alias("wind_speed_kn"),
        F.col("l_shipdate").alias("segment_start"),
    )


def courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as races of an event, with course texts of every kind."""
    key = F.col("o_orderkey") % 9
    p = F.col("o_orderpriority")
    course = (
        F.when(key == 1, F.concat(p, F.lit(" U 17 Women")))
        .when(key == 2, F.concat(p, F.lit(" Under 19 men IQfoil")))
        .when(key == 3, F.concat(p, F.lit(" youth   Final")))
        .when(key == 4, F.concat(p, F.lit(" Recall")))
        .when(key == 5, F.concat(p, F.lit(" ABANDON 2")))
        .when(key == 6, F.concat(p, F.lit(" tournament")))
        .when(key == 7, F.concat(F.lit("JUNIOR u19 Women "), p))
        .when(key == 8, F.concat(F.lit("R"), F.col("o_custkey").cast("string")))
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("race_id"),
        F.concat(F.lit("EVENT "), (F.col("o_custkey") % 10).cast("string")).alias("event_name"),
        course.alias("course"),
        F.col("o_totalprice").alias("total_length_m"),
        (F.col("o_totalprice") * 1.05).alias("total_dist_m"),
        (F.col("o_custkey") % 500).cast("double").alias("total_time_s"),
    )


def race_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as race documents: one racer with 0 to 3 segments, every third also a nameless one.

    Some have prefixed elements, some a racer in a comment or in another namespace, some the
    name one level down or in a CDATA section that looks like an end tag.
    """
    # A document is far wider than its order, so the orders are dealt to all cores first.
    o = table(spark, sf_dir, "orders").repartition(spark.sparkContext.defaultParallelism, "o_orderkey")

    def element(tag: str, value: str) -> str:
        return f"'<{tag}>', {value}, '</{tag}>'"

    segment = ", ".join(element(*x) for x in (
        ("SegNum", "i"), ("CrtRaceSegSX", "i * 10"), ("CrtRaceSegDX", "100 - i * 10"), ("TimeSecPercorsi", "o_custkey % 90 + i"),
        ("SegDistRealePercorsa", "o_custkey + i"), ("LungLato", "if(i = 1, string(o_custkey), '')"), ("DirLato", "o_custkey * i % 360"), ("PercEffettivo", "'97,5'"),
        ("StartSeg", "if(i = 3, 'bad', string(o_custkey * 60 + i))"), ("EndSeg", "o_custkey * 60 + i + 30"), ("SegEnteredRank", "i + 1"), ("SegExitRank", "i + 2")))
    segments = ("transform(if(o_orderkey % 4 = 0, array(), sequence(1, int(o_orderkey % 4))), "
                f"i -> concat('\n <cInfoRaceSegment>', {segment}, '</cInfoRaceSegment>'))")
    name = "if(o_orderkey % 11 = 0 and o_orderkey % 7 > 0, concat('<![CDATA[C', o_custkey, '</StatisticheDato>]]>'), concat('C', o_custkey))"
    racer = ", ".join(element(*x) for x in (
        ("Seriale", "o_orderkey"), ("TotTempPerc", "o_custkey"), ("TotLungLato", "o_orderkey % 1000"), ("TotDistPerc", "o_orderkey % 1000 + 7"),
        ("PosPartenza", "o_orderkey % 30"), ("TotDistRealeSuIdeale", "'101,25'"), ("TopSpeed", "o_custkey % 31"), ("TopVMG", "o_custkey % 29"),
        ("TopVMC", "o_custkey % 23"), ("AvgVMG", "o_custkey % 19"), ("AvgVMC", "o_custkey % 17"), ("AvgSpeed", "concat('&#', 48 + o_custkey % 10, ';')"), ("LungLato", "100")))
    xml = F.expr(
        "concat('<?xml version=\"1.0\"?>\n<string xmlns=\"http://a/\"><ArrayOfDato xmlns=\"http://b/\">',"
        "if(o_orderkey % 6 = 0, '<!-- <StatisticheDato><Nome>Ghost</Nome></StatisticheDato> -->', ''),"
        "if(o_orderkey % 13 = 0, '<z:StatisticheDato xmlns:z=\"http://z/\"><z:Nome>Other</z:Nome></z:StatisticheDato>', ''),"
        f"'<StatisticheDato>', if(o_orderkey % 5 = 0, '<Who>', ''), '<Nome>', {name}, '</Nome>', if(o_orderkey % 5 = 0, '</Who>', ''),"
        f"{racer}, '<Segments>', array_join({segments}, ''), '</Segments></StatisticheDato>',"
        "if(o_orderkey % 3 = 0, '<StatisticheDato><Seriale>0</Seriale></StatisticheDato>', ''), '</ArrayOfDato></string>')"
    )
    prefixed = F.regexp_replace(F.regexp_replace(xml, "<(/?)(StatisticheDato|Nome|cInfoRaceSegment|SegNum)(?=[ >])", "<$1p:$2"),
                                "<ArrayOfDato", '<ArrayOfDato xmlns:p="http://b/"')
    return o.select(
        F.col("o_orderkey").cast("string").alias("race_id"),
        F.concat(F.lit("E"), F.col("o_custkey") % 50).alias("event_name"),
        F.col("o_orderstatus").alias("event_location"),
        F.col("o_orderpriority").alias("course"),
        F.lit("2024-05-01").alias("race_date"),
        (F.col("o_orderkey") % 360).cast("string").alias("wind_dir_site"),
        F.when(F.col("o_orderkey") % 7 == 0, prefixed).otherwise(xml).alias("xml"),
    )


def page_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose script passes race data: sound with a day or without, broken, or none."""
    dated = "dataLayer.push({'eventName': 'E$1', 'race': 'R$1', 'raceDate': 'D$1'});"
    sound = "dataLayer.push({'eventName': 'E$1', 'race': 'R$1'});"
    broken = "dataLayer.push({'eventName': E$1});"
    call = F.lit(r"track\(([0-9]+)\);")
    kind = F.col("page_id") % 4
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(kind == 0, F.regexp_replace("html", call, F.lit(dated)))
        .when(kind == 1, F.regexp_replace("html", call, F.lit(sound)))
        .when(kind == 2, F.regexp_replace("html", call, F.lit(broken)))
        .otherwise(F.col("html")).alias("html"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as weather payloads, with every gap a payload can have."""
    v = F.col("value").cast("string")
    k = F.get_json_object("props", "$.k")
    tail = F.concat(F.lit('"pressure":'), k, F.lit(',"humidity":'), k, F.lit(',"wind_deg":'), k)
    wind = F.concat(F.lit('"wind_speed":'), v, F.lit(","))
    rain = F.concat(F.lit(',"rain":{"1h":'), v, F.lit("}"))
    temp = F.concat(F.lit('"temp":'), v, F.lit(","))
    one = lambda *parts: F.concat(F.lit('{"data":[{'), *parts, F.lit('},{"temp":-99}]}'))
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id",
        F.when(kind == "error", F.lit('{"data":[]}'))
        .when(kind == "click", one(temp, wind, tail))
        .when(kind == "signup", one(wind, tail, rain))
        .when(kind == "view", one(F.lit('"temp":null,'), wind, tail, rain))
        .otherwise(one(temp, wind, tail, rain)).alias("payload"),
    )


def site_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a site, a day and seconds of day."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", "ts", "user_id",
        (F.col("user_id") % SITES).alias("site"),
        F.col("ts").cast("date").alias("day"),
        (F.pmod(us, F.lit(86_400_000_000)) / 1e6).alias("t"),
    )


def site_location(site: str) -> str:
    return f"concat(string({site} * 0.5D + 40.125D), ', ', string({site} * 0.25D + 3.5D))"


def race_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as untimed race segments at a site and day."""
    begin = "(athlete_no * 37 + segment_no * 600) % 86400"
    clock = "date_format(timestamp_seconds({0}), 'HH:mm:ss')"
    length = F.col("l_extendedprice") / 100
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("race_id"),
        F.col("l_linenumber").alias("segment_no"),
        F.col("l_suppkey").alias("serial_no"),
        F.col("l_partkey").alias("athlete_no"),
        length.alias("segment_length_m"),
        (length * (1 + F.col("l_discount"))).alias("segment_dist_m"),
        (length * 5).alias("total_length_m"),
        (length * 5 * (1 + F.col("l_tax"))).alias("total_dist_m"),
        (F.col("l_partkey") % 500).cast("double").alias("total_time_s"),
        (F.col("l_partkey") % 360).cast("double").alias("heading_deg"),
        (F.col("l_suppkey") * 37 % 360).cast("double").alias("wind_dir_site"),
        F.col("l_quantity").cast("bigint").alias("took"),
    )
    return rows.select(
        "*",
        F.expr(site_location(f"(serial_no % {SITES})")).alias("event_location"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("race_id") % (DAYS + 2)).cast("int")).alias("race_date"),
        F.expr(clock.format(begin)).alias("segment_start_clock"),
        F.expr(clock.format(f"(({begin}) + took - 1) % 86400")).alias("segment_end_clock"),
    ).drop("took")


def weather_table(spark: SparkSession, sf_dir: str, *more: str, time: Column | None = None) -> DataFrame:
    """Events as weather readings at the sites; ``more`` columns of the events after the usual ones."""
    e = site_events(spark, sf_dir)
    rows = e.select(
        F.dayofmonth("ts").alias("day"), F.month("ts").alias("month"), F.year("ts").alias("year"),
        (F.date_format("ts", "HH:mm:ss") if time is None else time).alias("time"),
        F.concat(F.lit("Site "), F.col("site").cast("string")).alias("city"),
        (F.col("site") * 0.5 + 40.125).alias("latitude"),
        (F.col("site") * 0.25 + 3.5).alias("longitude"),
        F.col("value").alias("temperature_c"),
        (F.col("event_id") % 100 + 950).alias("pressure_hpa"),
        (F.col("user_id") % 100).alias("humidity_pct"),
        F.round(F.col("value") % 20, 2).alias("wind_speed_kn"),
        (F.col("event_id") % 360).alias("wind_dir_weather"),
        F.lit(0.0).alias("rain_mm"), *more,
    )
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in WEATHER_HOURLY], *more)
