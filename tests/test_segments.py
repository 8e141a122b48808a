"""Weather hours, distributions, the enrichment plan and the incremental jobs."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windward import session
from windward.operators import distributions, upsert, weather
from windward.operators.counted import StepCounts
from windward.plans import collect, enrich
from windward.schemas import PROCESSED_COLUMNS, WEATHER_HOURLY, WEATHER_KEY
from windward.sources import tables
from windward.streaming import ingest, ledger
from windward.streaming.log_table import compact, read_batches, read_latest, write_batch

SEG = "race_id string, who int, point_of_sail string, wind_speed_kn double, segment_speed_kn double, segment_vmc_kn double"


def test_ranges_merge_events_unless_kept_apart(spark, rows):
    df = spark.sql("""SELECT * FROM VALUES
      ('e1', 1D, 2D, timestamp_ntz'2024-01-01 10:00:00', timestamp_ntz'2024-01-01 11:00:00'),
      ('e2', 1D, 2D, timestamp_ntz'2024-01-03 23:00:00', timestamp_ntz'2024-01-04 00:10:00'),
      ('e3', NULL, 2D, timestamp_ntz'2024-01-03 23:00:00', timestamp_ntz'2024-01-04 00:10:00')
      AS t(event_name, lat, lon, segment_start, segment_end)""")
    span = weather.location_ranges(df)
    assert rows(span, "first_day", "last_day", "city") == [(date(2024, 1, 1), date(2024, 1, 4), "Location (1.0, 2.0)")]
    assert weather.hour_spine(span).count() == 4 * 13
    assert weather.hour_spine(weather.location_ranges(df, by=["event_name"])).count() == 3 * 13


def test_wind_bin_edges(spark, rows):
    df = spark.createDataFrame([(6.0,), (7.99,), (12.0,), (-1.0,), (None,)], "wind_speed_kn double")
    assert rows(distributions.with_wind_bin(df)) == [(-1.0, None), (12.0, 12), (6.0, 6), (7.99, 6), (None, None)]
    assert (12.0, None) in rows(distributions.with_wind_bin(df, strict_edges=True))
    odd = spark.createDataFrame([(13.0,), (12.0,)], "wind_speed_kn double")
    assert rows(distributions.with_wind_bin(odd, strict_edges=True)) == [(12.0, 12), (13.0, 12)]


def test_vmc_curve_is_dense_and_ends_at_the_top_speed(spark, rows):
    df = spark.createDataFrame([
        ("r", 1, "Reaching", 8.0, 3.5, 0.2), ("r", 2, "Reaching", 8.0, 2.0, 2.9), ("r", 3, "Reaching", 8.0, 1.0, 9.0),
        ("r", 4, "Vent debout", 8.0, 0.0, 0.0), ("r", 5, "Reaching", 5.9, 9.0, 8.0), ("r", 6, None, 8.0, 9.0, 8.0),
        ("r", 7, "Reaching", 8.0, 2.5, -0.5),
    ], SEG)
    sail = distributions.sailing_rows(df)
    assert rows(distributions.vmc_curve(sail), "wind_bin", "point_of_sail", "vmc_lo", "vmc_mid", "n") == [
        (8, "Reaching", 0, 0.5, 1), (8, "Reaching", 1, 1.5, 0), (8, "Reaching", 2, 2.5, 1), (8, "Reaching", 3, 3.5, 0),
    ]
    assert rows(distributions.speed_histogram(sail), "speed_lo", "n") == [(1, 1), (2, 2), (3, 1)]


def test_curve_counts_add_up(spark):
    rnd = random.Random(1)
    data = [("r", i, rnd.choice(["a", "b"]), rnd.uniform(0, 20), rnd.uniform(0, 30), rnd.uniform(-2, 35)) for i in range(500)]
    sail = distributions.sailing_rows(spark.createDataFrame(data, SEG))
    inside = sum(
        1 for _, i, p, w, v, m in data if w >= 6 and 0 <= m < -(-max(
            v2 for _, _, p2, w2, v2, _ in data if w2 >= 6 and p2 == p and w2 // 2 == w // 2) // 1)
    )
    assert distributions.vmc_curve(sail).agg(F.sum("n")).first()[0] == inside


def landed(spark):
    """Two races at one place: clocks across midnight, a repeated name, an excluded run, bad coordinates."""
    cols = ("race_id, event_name, event_location, course, race_date, wind_dir_site, athlete_name, serial_no, total_time_s, "
            "total_length_m, total_dist_m, start_position, segment_no, segment_dist_m, segment_length_m, heading_deg, "
            "segment_start_clock, segment_end_clock, rank_entry, avg_vmc, o")
    return spark.sql(f"""SELECT * FROM VALUES
      ('r1','Cup','43.10001, 5.9','U17 Women R1',date'2024-05-01',0D,"Ann O'Hara",'1',200D,400D,500D,1,1,120D,100D,10D,'10:00:00','10:01:40',1,0D,1),
      ('r1','Cup','43.1, 5.9','U17 Women R1',date'2024-05-01',0D,'Bea Lindqvist','2',0D,400D,500D,2,1,110D,100D,10D,'10:00:00','10:01:20',2,0D,2),
      ('r2','Cup','43.1, 5.9','Final',date'2024-05-01',0D,'Bea Lindqvis','2',100D,400D,500D,1,1,110D,100D,180D,'23:59:50','00:00:10',1,0D,3),
      ('r2','Cup','43.1, 5.9','Final Recall',date'2024-05-01',0D,'Bea Lindqvis','2',100D,400D,500D,1,1,110D,100D,180D,'11:00:00','11:00:10',1,0D,4),
      ('r3','Cup','unknown','Final',date'2024-05-01',0D,'Cid','3',100D,400D,500D,1,1,110D,100D,180D,'11:00:00','11:00:10',1,0D,5)
      AS t({cols})""")


def readings(spark, *rows_):
    return spark.createDataFrame(
        [(1, 5, 2024, t, "Location (43.1, 5.9)", 43.1, 5.9, temp, 1010, 50, wind, 12.0, 0.0) for t, temp, wind in rows_],
        WEATHER_HOURLY,
    )


def test_clean_and_enrich_end_to_end(spark):
    clean = enrich.clean_segments(landed(spark), F.col("o"), rules={"Cup": "R1|Final"})
    got = {r["o"]: r for r in clean.collect()}
    assert set(got) == {1, 2, 3, 5}
    assert got[1]["athlete_name"] == "Ann O Hara" and got[1]["course"] == "R1" and got[1]["sex"] == "Women"
    assert got[3]["athlete_name"] == "Bea Lindqvist"  # unified with the longer, earlier name
    assert got[3]["age_class"] == "U17" and got[5]["age_class"] == "Senior" and got[3]["sex"] is None
    assert "start_position" not in clean.columns

    weather_ = readings(spark, ("10:00:00", 20.0, 8.0), ("20:00:00", 15.0, 0.0))
    out = {r["o"]: r for r in enrich.enrich_segments(clean, weather_).collect()}
    assert set(out) == {1, 2, 3}  # no coordinates, no weather
    a, b, c = out[1], out[2], out[3]
    assert (a["segment_time_s"], a["mid_seconds"], a["temperature_c"]) == (100.0, 36050.0, 20.0)
    assert (c["segment_time_s"], c["mid_seconds"], c["temperature_c"]) == (20.0, 86400.0, 15.0)
    assert str(c["segment_end"]) == "2024-05-02 00:00:10" and c["segment_mid_clock"] == "00:00:00.000"
    assert a["segment_vmc_kn"] == 100 / 100 * 1.94384 and a["course_vmc_kn"] == 400 / 200 * 1.94384
    assert b["course_vmc_kn"] is None and c["speed_wind_ratio"] is None
    assert (a["rank_segment"], b["rank_segment"], a["rank_segment_end"], b["rank_segment_end"]) == (2, 1, 2, 1)
    assert a["point_of_sail"] == "Vent debout" and c["point_of_sail"] == "Vent arrière"
    assert a["course_diff_m"] == 100.0 and a["segment_diff_m"] == 20.0
    missing = set(PROCESSED_COLUMNS) - set(a.asDict())
    assert missing <= {"total_efficiency_pct", "segment_efficiency_pct", "port_pct", "starboard_pct"}


def test_ranks_count_only_segments_with_weather(spark):
    timed = landed(spark).where("o <= 2").withColumn(
        "event_location", F.when(F.col("o") == 2, "1.0, 1.0").otherwise(F.col("event_location"))
    )
    out = enrich.enrich_segments(timed, readings(spark, ("10:00:00", 20.0, 8.0))).collect()
    assert [(r["o"], r["rank_segment"], r["rank_segment_end"]) for r in out] == [(1, 1, 1)]


def test_segments_stay_when_there_is_no_weather_at_all(spark):
    out = enrich.enrich_segments(landed(spark), readings(spark).where("false"), left_if_no_match=True)
    assert out.count() == 5 and out.where("temperature_c is not null").count() == 0
    some = enrich.enrich_segments(landed(spark), readings(spark, ("10:00:00", 20.0, 8.0)), left_if_no_match=True)
    assert some.count() == 4


@pytest.mark.parametrize("most", [2, 100])
def test_staged_segments_are_as_landed_and_met_in_parts(spark, monkeypatch, most):
    weather_ = readings(spark, ("10:00:00", 20.0, 8.0), ("20:00:00", 15.0, 0.0))
    many = landed(spark).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3))))
    monkeypatch.setattr(enrich, "PART_ROWS", most)
    since = session.staged_so_far()
    out = enrich.enrich_segments(many, weather_)
    tables_ = [spark.read.parquet(path) for path, _ in session._STAGED[since:]]
    assert not [t for t in tables_ if {"segment_speed_kn", "segment_mid_clock", "lat_key"} & set(t.columns)]
    assert len(tables_) > 2 if most == 2 else [len(t.columns) for t in tables_][0] == len(many.columns) + 1
    assert sum(t.count() for t in tables_) == (12 if most == 2 else 15 + 12)
    assert sorted((r["o"], r["copy"], r["temperature_c"], r["rank_segment"], r["segment_mid_clock"]) for r in out.collect()) == sorted(
        (r["o"], c, r["temperature_c"], 1 + 3 * (r["rank_segment"] - 1), r["segment_mid_clock"])
        for r in enrich.enrich_segments(landed(spark), weather_).collect() for c in (1, 2, 3))


def test_weather_hours_cover_the_midnight_end(spark):
    hours = enrich.weather_hours(landed(spark))
    assert {str(r[0]) for r in hours.select("day").distinct().collect()} == {"2024-05-01", "2024-05-02"}


def test_collected_races_skip_known_ones(spark):
    doc = "<a><StatisticheDato><Nome>X</Nome><LungLato>1,5</LungLato></StatisticheDato></a>"
    races = spark.createDataFrame([("r1", doc), ("r2", doc)], "race_id string, xml string")
    known = spark.createDataFrame([("r1",)], "race_id string")
    got = enrich.collect_segments(races, known).collect()
    assert [(r["race_id"], r["segment_length_m"]) for r in got] == [("r2", 1.5)]


def test_weather_stream_last_write_wins_and_rerun_adds_nothing(spark, tmp_path, rows):
    land, table, check = (str(tmp_path / p) for p in ("land", "table", "check"))
    def run():
        ingest.upsert_stream(ingest.file_stream(spark, land, WEATHER_HOURLY, "*.parquet"), table, check)
        return rows(read_latest(spark, table, WEATHER_HOURLY, WEATHER_KEY, ["temperature_c"]), "time", "temperature_c")

    readings(spark, ("08:00:00", 1.0, 0.0), ("09:00:00", 2.0, 0.0)).write.parquet(land)
    assert run() == [("08:00:00", 1.0), ("09:00:00", 2.0)]
    assert run() == [("08:00:00", 1.0), ("09:00:00", 2.0)]
    readings(spark, ("09:00:00", -5.0, 0.0), ("10:00:00", 3.0, 0.0)).write.mode("append").parquet(land)
    assert run() == [("08:00:00", 1.0), ("09:00:00", -5.0), ("10:00:00", 3.0)]
    compact(spark, table, str(tmp_path / "c"), WEATHER_HOURLY, WEATHER_KEY, ["temperature_c"])
    assert read_batches(spark, str(tmp_path / "c"), WEATHER_HOURLY).count() == 3


def test_race_stream_takes_each_race_once(spark, tmp_path, rows):
    land, table, check = (str(tmp_path / p) for p in ("land", "table", "check"))
    schema = spark.createDataFrame([], "race_id string, v int").schema
    def run():
        ingest.ingest_new(
            ingest.file_stream(spark, land, schema, "*.parquet"), table, check, "race_id", order=[F.col("v")]
        )
        return rows(read_batches(spark, table, schema), "race_id", "v")

    spark.createDataFrame([("a", 1), ("b", 1)], schema).write.parquet(land)
    assert run() == [("a", 1), ("b", 1)]
    for landed in ([("b", 2), ("c", 2)], [("c", 3)]):  # c lands twice before one run
        spark.createDataFrame(landed, schema).write.mode("append").parquet(land)
    assert run() == [("a", 1), ("b", 1), ("c", 3)]
    assert run() == [("a", 1), ("b", 1), ("c", 3)]


def test_document_stream_keeps_files_whole(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "r1.xml").write_text("<a>\n<b/>\n</a>")
    docs = ingest.document_stream(spark, str(tmp_path / "in"))
    table = str(tmp_path / "t")
    ingest.upsert_stream(docs, table, str(tmp_path / "c"))
    got = spark.read.parquet(table).collect()
    assert [(r.path.rsplit("/", 1)[1], r.xml) for r in got] == [("r1.xml", "<a>\n<b/>\n</a>")]


def test_reads_of_an_absent_log_are_empty(spark, tmp_path):
    assert read_batches(spark, str(tmp_path / "no"), WEATHER_HOURLY).count() == 0


def test_processed_layer_has_its_columns_in_order(spark):
    from windward.schemas import PROCESSED_COLUMNS, MissingColumns
    wide = spark.createDataFrame([tuple(range(58))], ", ".join(f"{c} int" for c in [*reversed(PROCESSED_COLUMNS), "more"]))
    assert enrich.processed_layer(wide).columns == PROCESSED_COLUMNS
    with pytest.raises(MissingColumns):
        enrich.processed_layer(wide.drop("rank_segment"))


def test_the_reading_written_last_counts(spark):
    again = readings(spark, ("08:00:00", 30.0, 0.0), ("08:00:00", 20.0, 0.0), ("09:00:00", 1.0, 0.0)).withColumn(
        "written", F.when(F.col("temperature_c") == 20.0, 2).otherwise(1))
    got = enrich.latest_weather(again, ["written"]).collect()
    assert sorted((r.time, r.temperature_c) for r in got) == [("08:00:00", 20.0), ("09:00:00", 1.0)]


def test_landed_races_to_bronze_over_three_batches(spark, tmp_path, rows):
    land, table, check = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "c")
    about = spark.createDataFrame([("idgara=1&token=a", "Cup"), ("idgara=2&token=b", "Cup"), ("idgara=4&token=d", "Cup")], "race_id string, event_name string")

    def land_and_run(day, *files):
        (land / day).mkdir(parents=True)
        for name, racer, end in files:
            (land / day / f"{name}.xml").write_text(f"<a><StatisticheDato><Nome>{racer}</Nome></StatisticheDato>{end}", "utf-8")
        ingest.ingest_races(ingest.document_stream(spark, f"{land}/*"), table, check, about)

    def have(name, columns):
        schema = T.StructType.fromDDL("race_id string, event_name string, athlete_name string, reason string")
        return rows(read_batches(spark, f"{table}{name}", schema).select(*columns, "batch_id"))

    land_and_run("1", ("idgara=1&token=a", "Ann", "</a>"), ("idgara=2&token=b", "Bea", ""), ("idgara=3&token=c", "Cyd", "</a>"))
    assert have("", ["race_id", "event_name", "athlete_name"]) == [("idgara=1&token=a", "Cup", "Ann", 0)]
    assert have("_rejects", ["race_id", "reason"]) == [("idgara=2&token=b", "not well-formed", 0), ("idgara=3&token=c", "no page", 0)]
    land_and_run("2", ("idgara=1&token=a", "Zoe", "</a>"), ("idgara=4&token=d", "Dee", "</a>"))  # a known race lands again
    land_and_run("3", ("idgara=2&token=b", "Bea", "</a>"), ("idgara=4&token=d", "Eve", "</a>"))  # and a rejected one
    assert have("", ["race_id", "athlete_name"]) == [("idgara=1&token=a", "Ann", 0), ("idgara=2&token=b", "Bea", 2), ("idgara=4&token=d", "Dee", 1)]
    land_and_run("4")
    assert len(have("", ["race_id"])) == 3 and len(have("_rejects", ["race_id"])) == 2


def test_of_a_race_landed_twice_the_last_document_counts(spark, rows):
    doc = lambda name: f"<a><StatisticheDato><Nome>{name}</Nome></StatisticheDato></a>"
    page = "<script>dataLayer.push({'eventName':'E','race':'R','raceDate':'2024-05-01'});</script>"
    documents = spark.createDataFrame([("r", doc("Zoe"), datetime(2024, 5, 1)), ("r", doc("Ann"), datetime(2024, 5, 2)), (None, doc("No"), datetime(2024, 5, 3))],
                                      "race_id string, xml string, landed timestamp")
    pages = spark.createDataFrame([("r", page, "Wind 10°")], "race_id string, html string, wind string")
    links = spark.createDataFrame([("r", True, "u1"), ("r", True, "u2"), ("r", False, "u0"), (None, False, "x"), (None, False, "y"), (None, False, "y"), (None, False, None)],
                                  "race_id string, ok boolean, url string")
    races = collect.assemble_races(links, pages, documents)
    assert rows(collect.bronze_segments(races), "race_id", "athlete_name") == [("r", "Ann")]
    assert rows(collect.ingest_log(races)) == sorted([
        ("r", "u0", "no token", False), ("r", "u1", "new", True), ("r", "u2", "repeated", True),
        (None, "x", "no token", False), (None, "y", "no token", False), (None, None, "no token", False)], key=lambda t: tuple((v is None, str(v)) for v in t))
    bare = collect.assemble_races(links.drop("url"), pages, documents.drop("landed"))
    assert rows(collect.ingest_log(bare), "race_id", "status", "ok") == [("r", "new", True)] + [(None, "no token", False)] * 4
    assert rows(collect.bronze_segments(bare), "athlete_name") == [("Zoe",)]


def test_a_landing_within_the_delay_is_dropped_and_a_late_one_listed(spark, tmp_path, rows):
    land, table, check = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")
    schema = "path string, landed timestamp, xml string"
    doc = lambda name: f"<a><StatisticheDato><Nome>{name}</Nome></StatisticheDato></a>"
    at = lambda minutes: datetime(2024, 5, 1) + timedelta(minutes=minutes)
    batches = [[("in/r1.xml", at(0), doc("a")), ("in/r2.xml", at(10), doc("b"))], [("in2/r1.xml", at(20), doc("a again")), ("in/r3.xml", at(180), doc("c"))],
               [("in/r4.xml", at(30), doc("late")), ("in/r5.xml", at(190), doc("e"))]]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(land)
        ingest.ingest_races(ingest.file_stream(spark, land, T.StructType.fromDDL(schema), "*.parquet"), table, check, delay="1 hour")
    read = read_batches(spark, table, T.StructType.fromDDL("race_id string, athlete_name string"))
    assert rows(read, "race_id", "athlete_name") == [("r1", "a"), ("r2", "b"), ("r3", "c"), ("r5", "e")]
    assert rows(ingest.late_landings(spark, table), "race_id", "path") == [("r4", "in/r4.xml")]


def test_a_lookup_reads_only_the_ledger_batches_that_may_hold_a_key(spark, tmp_path, rows):
    path = str(tmp_path / "keys")
    keys = lambda *part: spark.range(*part).select(F.concat(F.lit("k"), "id").alias("key"))
    for b in range(5):
        ledger.write_keys(keys(b * 1000, b * 1000 + 1000), path, b, "key")
    asked = keys(2500, 2600).union(keys(9000, 9100)).union(spark.createDataFrame([(None,), (None,), ("k2500",)], "key string"))
    fresh, seen = ledger.not_taken(asked, path, "key", 5)
    assert rows(fresh) == rows(keys(9000, 9100).union(spark.createDataFrame([(None,), (None,)], "key string")))
    assert seen.get["read"] == 1000  # one batch of five
    fresh, seen = ledger.not_taken(keys(9000, 9100), path, "key", 5)
    assert seen is None and fresh.count() == 100  # nothing passes: nothing is read
    fresh, seen = ledger.not_taken(keys(2500, 2600), path, "key", 2)
    assert seen is None and fresh.count() == 100  # later batches do not count
    assert rows(ledger.not_taken(asked, path, "key", 5)[0]) == rows(upsert.not_yet_known(asked, keys(0, 5000), "key"))
    ledger.write_keys(keys(0, 10), path, 0, "key")  # written again, a batch replaces itself
    assert ledger.not_taken(keys(500, 510), path, "key", 5)[0].count() == 10
    write_batch(keys(7000, 7010), path, 6)  # without a filter a batch is compared
    assert ledger.not_taken(keys(7000, 7020), path, "key", 7)[0].count() == 10


def test_an_upsert_in_place_leaves_other_partitions_alone(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    frame = lambda data: spark.createDataFrame(data, "day int, city string, v string, o int")
    put = lambda data: tables.upsert_partitions(frame(data), path, ["day", "city"], [F.col("o")], ["day"])
    files = lambda: {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    put([(1, "a", "x", 1), (1, "b", "x", 1), (2, "a", "x", 1), (None, "a", "x", 1), (2, "a", "old", 0)])
    before = files()
    put([(2, "a", "new", 0), (2, "c", "new", 0), (3, "a", "new", 0), (None, "b", "new", 0), (2, "c", "newer", 1)])
    after = files()
    same = {f for f in before if f.startswith("day=1")}
    assert same and all(after[f] == before[f] for f in same) and not {f for f in before if f.startswith("day=2")} & set(after)
    want = sorted([(1, "a", "x"), (1, "b", "x"), (2, "a", "new"), (2, "c", "newer"), (3, "a", "new"), (None, "a", "x"), (None, "b", "new")],
                  key=lambda t: tuple((v is None, str(v)) for v in t))
    assert rows(spark.read.parquet(path), "day", "city", "v") == want
    put([(2, "a", "new", 0), (2, "c", "new", 0), (3, "a", "new", 0), (None, "b", "new", 0), (2, "c", "newer", 1)])
    assert rows(spark.read.parquet(path), "day", "city", "v") == want
    put([])
    assert rows(spark.read.parquet(path), "day", "city", "v") == want
    with pytest.raises(ValueError):
        tables.upsert_partitions(frame([]), path, ["city"], [F.col("o")], ["day"])
    old = tables.read_table(spark, path)
    touched = spark.createDataFrame([(2,)], "day int")
    touched.write.parquet(str(tmp_path / "touched"))
    plan = old.join(spark.read.parquet(str(tmp_path / "touched")).where("day < 9"), ["day"], "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_a_very_fast_segment_gives_all_its_bins(spark):
    df = spark.createDataFrame([("r", 1, "Reaching", 8.0, 1e8, 3.5), ("r", 2, "Reaching", 8.0, 2.0, 2e7 + 0.5)], SEG)
    curve = distributions.vmc_curve(distributions.sailing_rows(df))
    got = curve.agg(F.count("*"), F.sum("n"), F.min("vmc_lo"), F.max("vmc_lo"), F.count_distinct(F.expr("vmc_lo div 1000000"))).first()
    assert tuple(got) == (10**8, 2, 0, 10**8 - 1, 100)
    plan = curve._jdf.queryExecution().executedPlan().toString()
    assert plan.count("explode(sequence") == 2


def test_bins_are_spread_in_two_levels(spark, rows):
    spans = spark.createDataFrame([("a", 0, 10), ("b", 5, 6), ("c", 3, 3), ("d", 7, 110)], "g string, lo long, hi long")
    got = distributions.spread_bins(spans, "lo", "hi", "x", ["g"])
    assert sorted((r.g, r.x) for r in got.collect()) == [("a", i) for i in range(10)] + [("b", 5)] + [("d", i) for i in range(7, 110)]
    assert got.rdd.getNumPartitions() > 1


def test_hours_inside_occupied_times_only(spark, rows):
    df = spark.sql("""SELECT * FROM VALUES
      (1D, 2D, timestamp_ntz'2024-01-01 10:50:00', timestamp_ntz'2024-01-01 11:10:00'),
      (1D, 2D, timestamp_ntz'2024-01-01 11:05:00', timestamp_ntz'2024-01-01 11:06:00'),
      (1D, 2D, timestamp_ntz'2024-01-01 19:59:00', timestamp_ntz'2024-01-02 08:01:00'),
      (1D, 2D, timestamp_ntz'2024-01-05 12:00:00', timestamp_ntz'2024-01-05 11:00:00'),
      (NULL, 2D, timestamp_ntz'2024-01-05 12:00:00', timestamp_ntz'2024-01-05 13:00:00')
      AS t(lat, lon, segment_start, segment_end)""")
    islands = weather.occupied_intervals(df)
    assert [(str(a), str(b)) for a, b in rows(islands, "first_time", "last_time")] == [
        ("2024-01-01 10:50:00", "2024-01-01 11:10:00"), ("2024-01-01 19:59:00", "2024-01-02 08:01:00"), ("2024-01-05 12:00:00", "2024-01-05 12:00:00")]
    assert [(str(d), h) for d, h in rows(weather.hour_islands(islands), "day", "hour")] == [
        ("2024-01-01", 10), ("2024-01-01", 11), ("2024-01-01", 19), ("2024-01-01", 20), ("2024-01-02", 8), ("2024-01-05", 12)]
    span = weather.hour_spine(weather.location_ranges(df.where("lat is not null"))).select("day", "hour")
    assert weather.hour_islands(islands).select("day", "hour").exceptAll(span).count() == 0


def test_steps_are_counted_by_the_run_itself(spark, tmp_path, rows):
    counts = StepCounts()
    df = counts.after(spark.range(100), "landed")
    df = counts.after(df.where("id % 2 = 0"), "even")
    df = counts.after(df.where("id < 50"), "low")
    assert tables.write_table(df, str(tmp_path / "t")) == 25
    assert rows(counts.table(spark)) == [(0, "landed", 100, 0), (1, "even", 50, 50), (2, "low", 25, 25)]
