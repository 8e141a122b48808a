"""Column functions: texts, clocks and measures."""

import math
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from windward.functions import metrics, text, times


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn(F.col("c"))).first()[0]


@pytest.mark.parametrize("raw, want", [
    ("  O'Brien \t", "O Brien"), ("'Ann'", " Ann "), ("a  b", "a  b"), (" x\x1c", "x"), (None, None), ("", ""),
])
def test_name_is_trimmed_before_apostrophes_go(spark, raw, want):
    assert one(spark, raw, text.clean_name) == want


@pytest.mark.parametrize("raw, sex, age, bare", [
    ("U 17 Women Race 1", "Women", "U17", "Race 1"),
    ("Under 19 men IQfoil  R2", "Men", "U19", "R2"),
    ("JUNIOR and YOUTH", None, "U19", "and"),
    ("tournament", "Men", None, "tournat"),
    ("Final", None, None, "Final"),
    (None, None, None, None),
])
def test_course_text(spark, raw, sex, age, bare):
    assert one(spark, raw, text.extract_sex) == sex
    assert one(spark, raw, text.age_class) == age
    assert one(spark, raw, text.clean_course) == bare


def test_sex_by_whole_words_only(spark):
    assert one(spark, "tournament", lambda c: text.extract_sex(c, whole_words=True)) is None
    assert one(spark, "the WOMEN final", lambda c: text.extract_sex(c, whole_words=True)) == "Women"


def test_decimal_comma_strict_and_lenient(spark):
    assert one(spark, "12,5", text.decimal_comma) == 12.5
    assert one(spark, "n/a", lambda c: text.decimal_comma(c, strict=False)) is None
    assert one(spark, "nan", lambda c: text.decimal_comma(c, strict=False)) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "n/a", text.decimal_comma)


@pytest.mark.parametrize("raw, lat, lon", [
    ("43.123456, 5.9", 43.1235, 5.9), ("N/A", None, None), ("43.1,5.9", None, None), ("x, 5", None, 5.0), (None, None, None),
])
def test_coordinates(spark, raw, lat, lon):
    assert one(spark, raw, lambda c: text.coordinate(c, 0)) == lat
    assert one(spark, raw, lambda c: text.coordinate(c, 1)) == lon


def test_links(spark):
    u = "https://h.example/(S(ab1))/View.aspx?idgara=7&token=&token=a%20b+c#frag"
    assert one(spark, u, text.query_string) == "idgara=7&token=&token=a%20b+c"
    assert one(spark, u, lambda c: text.query_param(c, "idgara")) == "7"
    assert one(spark, u, lambda c: text.query_param(c, "token")) == "a b c"
    assert one(spark, u, lambda c: text.query_param(c, "gara")) is None
    assert one(spark, "https://h.example/#?idgara=7", lambda c: text.query_param(c, "idgara")) is None
    built = one(spark, u, lambda c: text.stats_url(c, F.lit("7"), F.lit("t"), "h.example", "S.asmx"))
    assert built == "https://h.example/(S(ab1))/S.asmx/getStatistiche?idgara=7&token=t"


def test_wind_text(spark):
    assert one(spark, " Wind 215°", text.wind_text) == "215"


def test_epoch_clock(spark):
    assert one(spark, "3661.9", times.epoch_clock) == "01:01:01"
    assert one(spark, "3661", lambda c: times.epoch_clock(c, "Europe/Paris")) == "02:01:01"
    for bad in ("soon", "", None, "1e99", "nan"):
        assert one(spark, bad, times.epoch_clock) is None


def test_clock_arithmetic(spark):
    df = spark.createDataFrame(
        [("23:50:00", "00:10:30"), ("10:00:00", "10:00:00"), ("10:00:00", None), ("x", "10:00:00")], "a string, b string"
    )
    a, b = times.clock_micros(F.col("a")), times.clock_micros(F.col("b"))
    d = times.duration_us(a, b)
    got = df.select(d / 1e6, times.mid_seconds(a, d)).collect()
    assert got[0] == (1230.0, 85800 + 615.0)  # beyond midnight it is not wrapped
    assert got[1] == (0.0, 36000.0)
    assert got[2] == (None, None) and got[3] == (None, None)


def test_date_from_parts(spark):
    df = spark.createDataFrame([(2024, 2, 29), (2023, 2, 29), (2024, 13, 1), (None, 1, 1)], "y int, m int, d int")
    got = [r[0] for r in df.select(times.date_from_parts(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert got == [date(2024, 2, 29), None, None, None]


def test_at_clock(spark):
    df = spark.createDataFrame([(date(2024, 5, 1), "08:09:10.5"), (None, "08:00:00")], "d date, c string")
    got = [r[0] for r in df.select(times.at_clock(F.col("d"), times.clock_micros(F.col("c")))).collect()]
    assert got == [datetime(2024, 5, 1, 8, 9, 10, 500000), None]


def test_speed_is_null_for_zero_or_missing_time(spark):
    df = spark.createDataFrame([(100.0, 10.0), (100.0, 0.0), (100.0, None)], "d double, t double")
    got = [r[0] for r in df.select(metrics.knots(F.col("d"), F.col("t"))).collect()]
    assert got[0] == 100.0 / 10.0 * 1.94384 and got[1:] == [None, None]


@pytest.mark.parametrize("wind, heading, angle, label", [
    (0, 0, 0, "Vent debout"), (350, 10, 20, "Vent debout"), (10, 350, 20, "Vent debout"),
    (0, 45, 45, "Allures remontantes"), (0, 90, 90, "Reaching"), (0, 100, 100, "Allures portantes"),
    (0, 180, 180, "Vent arrière"), (90, 270, 180, "Vent arrière"), (359, 161, 162, "Vent arrière"),
])
def test_point_of_sail(spark, wind, heading, angle, label):
    df = spark.createDataFrame([(float(wind), float(heading))], "w double, h double")
    got = df.select(
        metrics.wind_angle(F.col("w"), F.col("h")), metrics.point_of_sail(F.col("w"), F.col("h"))
    ).first()
    assert got == (angle, label)


def test_efficiencies_run_in_opposite_directions(spark):
    df = spark.createDataFrame([(100.0, 125.0), (100.0, 0.0)], "p double, r double")
    p, r = F.col("p"), F.col("r")
    got = df.select(metrics.segment_efficiency(p, r), metrics.course_efficiency(p, r)).collect()
    assert got[0] == (80.0, 125.0) and got[1] == (None, 0.0)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-720, 720), min_size=1, max_size=30))
def test_circle(spark, angles):
    from windward.operators.features import circular_encode

    df = spark.createDataFrame([(a,) for a in angles], "a double")
    for s, c in circular_encode(df, "a").collect():
        assert math.isclose(s * s + c * c, 1.0, abs_tol=1e-12)
