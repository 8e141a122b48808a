"""Landed files: pages, race documents, weather payloads, tables."""

import json
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from windward.operators import columns, filters
from windward.schemas import PROCESSED_COLUMNS, STAT_TAGS, MissingColumns, require_columns
from windward.sources import race_pages, race_xml, tables, weather_json

LINK = "https://app.races.example/ViewRecordedRace2018.aspx?idgara=%d&amp;token=%s"


def test_saved_pages_by_name_pattern(spark, tmp_path, rows):
    (tmp_path / "Race web 1.html").write_text(f'<a href="{LINK % (2, "b")}">x</a>\n<a href="{LINK % (1, "a")}">', "utf-8")
    (tmp_path / "Race web 2.html").write_text(f"<p>{LINK % (1, 'a')}</p>", "utf-8")
    (tmp_path / "Race web 3.html").write_bytes(b"\xff\xfe no link")
    (tmp_path / "other.html").write_text(LINK % (9, "z"), "utf-8")
    links = race_pages.extract_links(race_pages.read_saved_pages(spark, str(tmp_path), "Race web*.html"))
    assert [r[0] for r in links.collect()] == [(LINK % (n, t)).replace("&amp;", "&") for n, t in ((1, "a"), (2, "b"))]
    asked = race_pages.race_requests(links).collect()
    assert [(r["race_id"], r["race_no"], r["token"], r["ok"]) for r in asked] == [
        ("idgara=1&token=a", "1", "a", True), ("idgara=2&token=b", "2", "b", True),
    ]


def test_requests_without_token_fail(spark):
    df = spark.createDataFrame([("https://h.example/x?idgara=1",)], "url string")
    assert race_pages.race_requests(df).first()["ok"] is False


@pytest.mark.parametrize("html, want", [
    ("<script>a()</script><script>dataLayer.push({'eventName':'E','race':'R1','raceDate':'2024-05-01'});</script>", ("E", "R1", "2024-05-01")),
    ("<script type='x'>\ndataLayer.push({\n'eventName': 'E'\n}); more</script>", ("E", "N/A", "N/A")),
    ("<script>dataLayer.push({eventName: });</script>", ("N/A", "N/A", "N/A")),
    ("<script>dataLayer.push(x)</script><script>dataLayer.push({'race':'R2'});</script>", ("N/A", "N/A", "N/A")),
    ("<p>none</p>", ("N/A", "N/A", "N/A")),
    (None, ("N/A", "N/A", "N/A")),
])
def test_page_script(spark, html, want):
    df = race_pages.page_info(spark.createDataFrame([(html,)], "html string"))
    assert tuple(df.select("event_name", "course", "race_date").first()) == want


DOC = """<?xml version="1.0" encoding="utf-8"?>
<string xmlns="http://a.example/"><ArrayOfDato xmlns="http://b.example/">
<StatisticheDato><Nome>A &amp; B</Nome><Seriale>1</Seriale><TotTempPerc></TotTempPerc><LungLato>77</LungLato>
 <List><Deep><cInfoRaceSegment><SegNum>1</SegNum><StartSeg>3600</StartSeg><LungLato>5</LungLato><Odd>1</Odd></cInfoRaceSegment></Deep>
 <cInfoRaceSegment><SegNum></SegNum><StartSeg>soon</StartSeg></cInfoRaceSegment><cInfoRaceSegment/></List></StatisticheDato>
<StatisticheDato><Seriale>2</Seriale></StatisticheDato>
<StatisticheDato><Nome/></StatisticheDato>
</ArrayOfDato></string>"""


def test_race_documents(spark, rows):
    races = spark.createDataFrame(
        [("r1", "E", DOC), ("r2", "E", "<a><StatisticheDato></a>"), ("r3", "F", None), ("r4", "F", "<a/>")],
        "race_id string, event_name string, xml string",
    )
    flat = race_xml.parse_races(races)
    assert flat.columns[:8] == [
        "race_id", "event_name", "event_location", "course", "race_date", "wind_dir_site", "athlete_name", "serial_no"
    ]
    assert set(STAT_TAGS.values()) <= set(flat.columns) and "Odd" not in flat.columns
    got = rows(flat, "race_id", "athlete_name", "serial_no", "total_time_s", "segment_no", "segment_length_m", "segment_start_clock")
    assert got == sorted([
        ("r1", "A & B", "1", None, "1", "5", "01:00:00"),   # segment wins over racer
        ("r1", "A & B", "1", None, None, "77", None),       # empty tag, epoch that is no number
        ("r1", "A & B", "1", None, None, "77", None),       # empty segment
        ("r1", "N/A", "2", None, None, None, None),         # no name, no segment
        ("r1", None, None, None, None, None, None),         # empty name
    ], key=lambda t: tuple((v is None, str(v)) for v in t))


def test_prefixes_comments_and_deep_names(spark, rows):
    doc = ('<p:a xmlns:p="x"><!-- <p:StatisticheDato><p:Nome>Ghost</p:Nome></p:StatisticheDato> --><p:StatisticheDato>'
           '<p:cInfoRaceSegment><p:SegNum>1</p:SegNum><p:Who><p:Nome>D&#233;a</p:Nome></p:Who></p:cInfoRaceSegment>'
           '<p:cInfoRaceSegment><p:SegNum>2</p:SegNum></p:cInfoRaceSegment></p:StatisticheDato></p:a>')
    races = spark.createDataFrame([("r1", doc), ("r2", "<a><b></a>"), ("r3", None), ("r4", "<a/>"), ("r5", "")], "race_id string, xml string")
    assert rows(race_xml.parse_races(races), "race_id", "athlete_name", "segment_no") == [("r1", "Déa", "1"), ("r1", "Déa", "2")]
    assert rows(race_xml.rejected_races(races)) == [("r2", "not well-formed"), ("r3", "null"), ("r4", "no racer"), ("r5", "not well-formed")]


R = "<StatisticheDato>%s</StatisticheDato>"
SEG = "<cInfoRaceSegment><SegNum>%s</SegNum></cInfoRaceSegment>"


@pytest.mark.parametrize("doc, want", [
    # CDATA and comments that look like markup.
    ("<a>" + R % "<Nome><![CDATA[x</StatisticheDato>&amp;]]></Nome><Seriale>7</Seriale>" + "</a>", [("x</StatisticheDato>&amp;", "7", None)]),
    ("<a><i><![CDATA[<!--]]></i><!-- real -->" + R % "<Nome>Z</Nome>" + "</a>", [("Z", None, None)]),
    ("<a>" + R % "<Nome>A<!-- c -->n<![CDATA[ & ]]>&#66;o</Nome>" + "</a>", [("An & Bo", None, None)]),
    # Namespaces: one counts, children in none count as fields.
    ("<p:a xmlns:p='u' xmlns:q='v'><q:StatisticheDato/><p:StatisticheDato><q:Nome>no</q:Nome><p:Nome>yes</p:Nome><q:Seriale>9</q:Seriale></p:StatisticheDato></p:a>",
     [("yes", None, None)]),
    ("<a xmlns='u'><StatisticheDato><Nome>in</Nome><Seriale xmlns=''>5</Seriale></StatisticheDato><StatisticheDato xmlns='v'/></a>", [("in", "5", None)]),
    ("<a xmlns='u'><b xmlns:p='u'><p:StatisticheDato ><p:Nome >N</p:Nome ><p:Seriale>3</p:Seriale></p:StatisticheDato ></b></a>", [("N", "3", None)]),
    # Racers in racers, segments in segments, names above and below.
    ("<a>" + R % ("<Nome>out</Nome>" + SEG % 1 + "<x>" + R % ("<Nome>inn</Nome>" + SEG % 2) + "</x>") + "</a>", [("inn", None, "2"), ("out", None, "1"), ("out", None, "2")]),
    ("<a>" + R % "<cInfoRaceSegment><SegNum>1</SegNum><x/><cInfoRaceSegment><SegNum>2</SegNum></cInfoRaceSegment></cInfoRaceSegment>" + "</a>",
     [("N/A", None, "1"), ("N/A", None, "2")]),
    (R % ("<Nome>root</Nome>" + R % "<w><v><Nome>deep</Nome></v></w><Seriale>1</Seriale>"), [("deep", "1", None)]),
    # Of several fields the last that says something; escapes, quotes, line ends.
    ("<a>" + R % '<Nome>  q&quot;\\ &lt;b&gt;\r\n</Nome><Seriale>1</Seriale><Seriale> 2 </Seriale><Seriale/><Seriale> </Seriale>' + "</a>", [('q"\\ <b>', "2", None)]),
    ("<a b='>' c = \"x > 'y'\"><?pi <x> ?>" + R % "<Nome d='1'>T</Nome><Seriale>&#38;lt;</Seriale>" + "</a>", [("T", "&lt;", None)]),
    ("<a>" + R % ("".join(f"<f{i}>{i}</f{i}>" for i in range(100)) + "<Nome>late</Nome><Seriale>4</Seriale>") + "</a>", [("late", "4", None)]),
    ("<a>" + R % "" + "<StatisticheDato/></a>", [("N/A", None, None), ("N/A", None, None)]),
])
def test_documents_are_read_by_structure(spark, rows, doc, want):
    races = spark.createDataFrame([("r", doc)], "race_id string, xml string")
    assert rows(race_xml.parse_races(races), "athlete_name", "serial_no", "segment_no") == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_rejects_are_what_an_xml_parser_rejects(spark):
    good, bad = R % "<Nome>n</Nome>", [
        "<a>&none;</a>", "<a>x & y</a>", "<a b='1' b='2'/>", "<a/><b/>", "<a>x</a><b>y</b>", "<a>", "x<a/>", "<a/>y", "<a>&#1;</a>", "<a>&#xD800;</a>", "<a><b></a></b>",
        "<a><!-- x -- y --></a>", "<a><!-- x ---></a>", "<a>]]></a>", "<a b=1/>", "<a b='<'/>", "<a b='&'/>", "<a><q:b>1</q:b></a>", "<a q:b='1'/>", "<a><q:b><c/></q:b></a>", "<a>\x01</a>",
        "<a><b xmlns:q='u'/><q:c/></a>", "<1/>", "<a><b>1</c></a>", "<a", "<a><![CDATA[x]]", "</a>", "", "  "]
    fine = ["<a/>", "<a >\n</a >", "<q:a xmlns:q='u' q:b='1'/>", "<a>&#233;&#x41;&lt;</a>", "<a xml:lang='x'/>", "<!DOCTYPE a><a/>", "<a><b xmlns:q='u'><q:c/></b></a>", "<!-- c --><a/><?p ?>", "<é/>"]
    for text in fine:
        assert ElementTree.fromstring(text) is not None
    for text in bad:
        with pytest.raises(ElementTree.ParseError):
            ElementTree.fromstring(text)
    docs = [*bad, *fine, f"<a>{good}</a>"]
    got = {r.race_id: r.reason for r in race_xml.scan_documents(spark.createDataFrame(list(enumerate(docs)), "race_id int, xml string")).collect()}
    assert [got[i] for i in range(len(docs))] == ["not well-formed"] * len(bad) + ["no racer"] * len(fine) + [None]


def test_a_namespace_can_be_named(spark, rows):
    doc = "<a xmlns='u'><StatisticheDato/><v:StatisticheDato xmlns:v='v'><v:Seriale>1</v:Seriale></v:StatisticheDato></a>"
    races = spark.createDataFrame([("r", doc)], "race_id string, xml string")
    assert [race_xml.parse_races(races, namespace=n).select("serial_no").collect() for n in (None, "u", "v", "")] == [[(None,)], [(None,)], [("1",)], []]


def test_each_document_is_read_once(spark):
    races = spark.createDataFrame([("r", DOC)], "race_id string, xml string")
    plan = race_xml.parse_races(races)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("<!--.*?-->") == 1 and "from_xml" not in plan and "Python" not in plan


def test_what_is_read_of_a_document_is_not_copied_again(spark, rows):
    """An element of a transformed array is copied with all it holds, so values that are computed once go another way."""
    plan = race_xml.parse_races(spark.createDataFrame([("r", DOC)], "race_id string, xml string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(array(" not in plan
    doc = "<a>" + R % "<Nome> É b\t c \n</Nome><Seriale>\n</Seriale><Sériale.é-1>x</Sériale.é-1><cInfoRaceSegment>\n<SegNum> 1  2 </SegNum>\n</cInfoRaceSegment>" + "</a>"
    races = spark.createDataFrame([("r", doc)], "race_id string, xml string")
    assert rows(race_xml.parse_races(races), "athlete_name", "serial_no", "segment_no") == [("É b\t c", None, "1  2")]


@pytest.mark.parametrize("raw, want", [
    ('<?xml version="1.0"?>\n<string xmlns="x"><a/></string>\n', "<a/>"),
    ("<a><string>inner</string>tail</a>", "<a>inner"),
    ("<a/>", "<a/>"),
    ("<string>x</string>y</string>z", "x</string>y"),
])
def test_envelope(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "x string").select(race_xml.strip_envelope(F.col("x"))).first()[0] == want


def payload(*hours, **extra):
    return json.dumps({"data": list(hours), **extra})


def test_weather_payloads(spark):
    full = {"temp": 20.126, "wind_speed": 5.0, "pressure": 1010, "humidity": 50, "wind_deg": 90.0, "rain": {"1h": 0.4}}
    cases = [
        (1, payload(full, {"temp": 1})), (2, payload()), (3, payload({"pressure": 1000})),
        (4, payload({**full, "temp": None, "rain": {}})), (5, '{"message":"no"}'), (6, "broken"),
    ]
    df = spark.createDataFrame(cases, "i int, payload string")
    got = {r["i"]: tuple(r)[1:] for r in weather_json.parse_payload(df).collect()}
    assert got == {
        1: (20.13, 9.72, 1010, 50, 90.0, 0.4),
        3: (0.0, 0.0, 1000, None, None, 0.0),
        4: (0.0, 9.72, 1010, 50, 90.0, 0.0),
    }
    kept = {r["i"]: tuple(r)[1:] for r in weather_json.parse_payload(df, absent_is_zero=False).collect()}
    assert kept[3] == (None, None, 1000, None, None, None)


def test_missing_table_and_missing_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"))
    with pytest.raises(MissingColumns, match="b"):
        require_columns(spark.createDataFrame([(1,)], "a int"), ["a", "b"])


def test_empty_result_is_not_written(spark, tmp_path):
    target = str(tmp_path / "t")
    tables.write_table(spark.createDataFrame([(1,)], "a int"), target)
    with pytest.raises(tables.EmptyResult):
        tables.write_table(spark.createDataFrame([], "a int"), target)
    assert tables.read_table(spark, target).count() == 1


def test_run_tables(spark, tmp_path):
    df = spark.createDataFrame([(1.5,)], "mae double")
    for _ in range(2):
        tables.write_run({"metrics": df}, str(tmp_path), "2024-01-01_00-00-00")
    back = spark.read.parquet(str(tmp_path / "metrics"))
    assert [tuple(r) for r in back.collect()] == [(1.5, "2024-01-01_00-00-00")]


def test_sheet_export_and_typing(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        'ID_course,Orientation vent site,Nom complet,Date de la course,Longueur du segment (m),Numéro de segment,Nom de l\'événement\n'
        'r1,"215,5",Ann,2024-05-01,"1234,5",2,Cup\nr2,N/A,Ben,01/06/2024,x,,Cup\n', "utf-8")
    got = tables.typed_segments(tables.read_sheet_export(spark, str(tmp_path / "s.csv"))).collect()
    assert [tuple(str(v) if v is not None else None for v in r) for r in got] == [
        ("r1", "215.5", "Ann", "2024-05-01", "1234.5", "2", "Cup"),
        ("r2", None, "Ben", "2024-06-01", None, None, "Cup"),
    ]


@pytest.mark.parametrize("day, want", [
    ("2024-05-01", "2024-05-01"), ("2024-05-01 10:00:00", "2024-05-01"), ("2024-05-01T10:00", "2024-05-01"), ("01/05/2024", "2024-05-01"),
    ("2024-05-011", None), ("01/05/2024x", None), ("2024-13-01", None), ("", None),
])
def test_a_day_is_the_whole_text(spark, day, want):
    df = spark.createDataFrame([(day,)], "race_date string")
    assert str(tables.typed_segments(df).first()[0]) == str(want)
    assert [r.value for r in tables.unreadable_days(df).collect()] == ([] if want else [day])


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, a_w int")
    assert columns.drop_suffixed(df, "_w").columns == ["a", "b"]
    assert columns.columns_first(df, ["z", "b"]).columns == ["z", "b", "a", "a_w"]
    with pytest.raises(ValueError):
        columns.rename_by_position(df, ["x"])
    wide = spark.createDataFrame([tuple(range(57))], ", ".join(f"c{i} int" for i in range(57)))
    assert columns.rename_by_position(wide, PROCESSED_COLUMNS).columns[-1] == "rank_segment_end"


def test_rules_look_at_the_course_and_keep_nulls_elsewhere(spark, rows):
    df = spark.createDataFrame(
        [("cup", "IQfoil R1"), ("cup", "R2"), ("cup", None), ("open", None), (None, "R3"), ("open", "General RECALL")],
        "event_name string, course string",
    )
    kept = filters.exclude_by_rule(filters.exclude_matching(df, "course"), {"cup": "iqfoil"})
    assert rows(kept) == [("cup", "IQfoil R1"), ("open", None), (None, "R3")]


def test_predicates_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(10).selectExpr("id", "id as w", "id as unused").write.parquet(path)
    df = filters.keep_at_least(tables.read_table(spark, path).select("id", "w"), "w", 6)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(w,6" in plan and "unused" not in plan.split("ReadSchema")[1]
