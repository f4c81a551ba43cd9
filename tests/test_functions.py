"""Truth tables of the column expressions."""


import pytest
from pyspark.sql import functions as F

from tidegate.functions import dates, geo, labels, text


def value(spark, schema, row, expression):
    return spark.createDataFrame([row], schema).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize("a,b,want", [("A", "A", True), ("A", "B", False), (None, None, True), ("A", None, False), (None, "A", False)])
def test_same_value(spark, a, b, want):
    assert value(spark, "a string, b string", (a, b), text.same_value("a", "b")) is want


@pytest.mark.parametrize(
    "v,l,want",
    [("A", "A;B;C", True), ("D", "A;B;C", False), (None, None, True), ("A", None, False), (None, "A", False), ("A", "AB;C", False), ("A", " A;B", False)],
)
def test_in_list(spark, v, l, want):
    assert value(spark, "v string, l string", (v, l), text.in_list("v", "l")) is want


@pytest.mark.parametrize(
    "code,taxon,key,label",
    [
        (None, "Species Name", "species name", "Species Name"),
        ("PARAM1", None, "param1", "PARAM1"),
        (None, None, None, "nan / nan"),
        ("P", "T", None, "P / T"),
    ],
)
def test_parameter(spark, code, taxon, key, label):
    row = (code, taxon)
    schema = "parameter_code string, biotaxon_naam string"
    assert value(spark, schema, row, text.parameter_key()) == key
    assert value(spark, schema, row, text.parameter_label()) == label


def test_strip_prefix_everywhere(spark):
    assert value(spark, "a string", ("NL80_xNL80_y",), text.strip_prefix("a")) == "xy"
    assert value(spark, "a int", (12,), text.strip_prefix("a")) == "12"


@pytest.mark.parametrize(
    "code,base",
    [("RWS_2023_05+vervuiling+vis", "RWS_2023_05"), ("RWS_2021_10 zwerfvuil op strand", "RWS_2021_10"), ("X", "X"), ("A B+c", "A B")],
)
def test_base_code(spark, code, base):
    assert value(spark, "a string", (code,), text.base_code("a")) == base


def test_bundle_names(spark):
    assert value(spark, "p string", ("/landing/input/LAB_1+Noord+x.zip",), text.bundle_from_path("p")) == "LAB_1+Noord+x"
    assert value(spark, "p string", ("input/LAB_1+Noord%2Bx.zip",), text.bundle_from_event_key("p")) == "LAB_1 Noord+x"
    assert value(spark, "p string", ("a+b",), text.clean_bundle("p")) == "a b"
    want = "validatielijst_per_locatie_met_aantal_R 1 a.csv"
    assert value(spark, "p string", ("R+1+a",), labels.count_report_name("p")) == want
    assert value(spark, "p string", ("",), labels.count_report_name("p")) is None


@pytest.mark.parametrize(
    "t,month_first,day_first",
    [
        ("03-04-2018", "2018-03-04", "2018-04-03"),
        ("23-1-2018", "2018-01-23", "2018-01-23"),
        ("1/2/2018", "2018-01-02", "2018-02-01"),
        ("2018-01-05", "2018-01-05", "2018-01-05"),
        ("2018/1/5", "2018-01-05", "2018-01-05"),
        ("geen datum", None, None),
        ("31-2-2018", None, None),
        ("12:30", None, None),
        (None, None, None),
    ],
)
def test_record_date(spark, t, month_first, day_first):
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    assert value(spark, "t string", (t,), day(dates.record_date("t"))) == month_first
    assert value(spark, "t string", (t,), day(dates.record_date("t", True))) == day_first


def test_record_date_keeps_time(spark):
    shown = F.date_format(dates.record_date("t"), "yyyy-MM-dd HH:mm")
    assert value(spark, "t string", ("23-1-2018 15:17",), shown) == "2018-01-23 15:17"


def test_strict_rule_dates(spark):
    assert value(spark, "t string", ("2018-01-05",), dates.rule_date("t", strict=True)) is None
    assert value(spark, "t string", ("5-1-2018",), dates.rule_date("t", strict=True)) is not None


@pytest.mark.parametrize(
    "t,year", [("15-9-2022", 2022), ("2022-09-15", 2022), ("medio 2024", 2024), ("onbekend", None), (None, None), ("1-2-2023-x", 2023)]
)
def test_delivery_year(spark, t, year):
    assert value(spark, "t string", (t,), dates.delivery_year("t")) == year


def test_display_dates(spark):
    assert value(spark, "t string", ("2025-03-04 08:43:10",), dates.display_date("t")) == "04/03/2025, 08:43"
    assert value(spark, "t string", (None,), dates.display_date("t")) == "Geen datum"
    assert value(spark, "t string", ("15-9-2022",), dates.display_delivery("t")) == "15/09/2022"
    assert value(spark, "t string", ("",), dates.display_delivery("t")) == "Geen leverdatum"


def test_deadline(spark):
    assert value(spark, "a int", (1,), dates.deadline("2025-06-01", 35)) == "2025-07-06"


@pytest.mark.parametrize("word,flag", [("TRUE", True), ("1", True), ("yes", True), ("no", False), (None, False)])
def test_flags(spark, word, flag):
    assert value(spark, "a string", (word,), text.flag_from_text("a")) is flag


def test_status_flags(spark):
    s = "Databundel validatie is: false en akkoord file is: TRUE"
    assert value(spark, "s string", (s,), text.flag_from_status("s", "validatie")) is False
    assert value(spark, "s string", (s,), text.flag_from_status("s", "akkoord file")) is True
    assert value(spark, "s string", ("x",), text.flag_from_status("s", "validatie")) is False


@pytest.mark.parametrize(
    "valid,approved,delivered,want",
    [
        (True, True, False, labels.NOT_AVAILABLE),
        (True, True, True, labels.COMPLIES),
        (False, True, True, labels.DEVIATES),
        (True, False, True, labels.COMPLIES),
        (False, False, True, labels.NOT_YET),
    ],
)
def test_combined_status(spark, valid, approved, delivered, want):
    got = value(spark, "v boolean, a boolean, d boolean", (valid, approved, delivered), labels.combined_status("v", "a", "d"))
    assert got == want


@pytest.mark.parametrize(
    "reason,want",
    [
        ("waarde ontbreekt", "High"),
        ("aantal monsters ongelijk aan verwachting", "Medium"),
        ("aantal monsters groter dan verwacht", "Low"),  # 'verwacht' is not 'verwachting'
        (None, "Low"),
    ],
)
def test_severity(spark, reason, want):
    assert value(spark, "r string", (reason,), labels.severity("r")) == want


def test_rule_record(spark):
    got = value(spark, "r string", ("{'criteria': 'D1', 'aantal': nan}",), labels.rule_record("r"))
    assert got == {"criteria": "D1", "aantal": None}
    assert value(spark, "r string", ("no json",), labels.rule_record("r")) is None


def test_criteria_list(spark):
    assert value(spark, "c string", ("ANSNL-D1; ANSN-D2;;ANSL-D3",), text.criteria_list("c")) == ["D1", "D2", "ANSL-D3"]


def test_utm_meridian_and_round_trip(spark):
    df = spark.createDataFrame([(3.0, 0.0), (3.0, 52.5), (6.2, 53.4), (-1.0, 51.0)], "lon double, lat double")
    e, n = geo.to_utm31("lon", "lat")
    df = df.withColumns({"e": e, "n": n})
    lon, lat = geo.from_utm31("e", "n")
    got = df.select("lon", "lat", "e", "n", lon.alias("lon2"), lat.alias("lat2")).collect()
    assert got[0]["e"] == 500000.0 and got[0]["n"] == 0.0
    assert abs(got[1]["n"] - 5816652.006) < 0.001 and abs(got[1]["e"] - 500000) < 1e-6
    for r in got:
        assert abs(r["lon"] - r["lon2"]) < 1e-10 and abs(r["lat"] - r["lat2"]) < 1e-10


def test_projection_meets_known_points(spark):
    # on the central meridian the north coordinate is the scaled arc: the quadrant of GRS80 is 10 001 965.729 m
    df = spark.createDataFrame([(3.0, 0.0), (3.0, 90.0)], "lon double, lat double")
    east, north = geo.to_utm31("lon", "lat")
    got = [tuple(r) for r in df.select(east, north).collect()]
    assert got[0] == pytest.approx((500000.0, 0.0), abs=1e-6)
    assert got[1] == pytest.approx((500000.0, 0.9996 * 10001965.729), abs=0.01)


def test_a_number_that_is_no_month_is_not_cast_as_one(spark):
    """The cast finds a month above 12 by an exception, which took a third of the time of all checks of a record."""
    texts = ["23-1-2018", "1-23-2018", "00-5-2018", "5-00-2018", "12/12/2018", "13.13.2018", "2-30-2018", "1-2-20185", "1-0-20185"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    turned = lambda pattern: F.regexp_replace("t", pattern, "read")
    got = df.select("t", turned(dates._MONTH_FIRST).alias("m"), turned(dates._DAY_FIRST).alias("d")).collect()
    assert {r.t for r in got if r.m == r.t} == {"23-1-2018", "00-5-2018", "13.13.2018"}
    assert {r.t for r in got if r.d == r.t} == {"1-23-2018", "5-00-2018", "13.13.2018", "2-30-2018", "1-0-20185"}
    read = {r.t: str(r.x)[:10] for r in df.select("t", dates.record_date("t").alias("x")).collect()}
    assert read == {
        "23-1-2018": "2018-01-23", "1-23-2018": "2018-01-23", "00-5-2018": "None", "5-00-2018": "None", "12/12/2018": "2018-12-12",
        "13.13.2018": "None", "2-30-2018": "None", "1-2-20185": "2018-01-25", "1-0-20185": "2018-01-05",
    }
