import pytest
from pyspark.sql import functions as F

from assayline import functions as fn
from assayline.functions import vocab


@pytest.mark.parametrize(
    "text, number",
    [
        ("<0,01", 0.01), (">100", 100.0), ("0,5", 0.5), (" <0,01", 0.01), ("< 0,01", None),
        ("<=0,1", None), ("≤3", 3.0), ("≥2,5", 2.5), ("~7", 7.0), ("1e-3", None), ("+5", None),
        (".5", None), ("5.", None), ("1 000", None), ("1,2,3", None), ("ND", None),
        (" nd ", None), ("NR", None), ("NA", None), ("", None), ("N/A", None), ("-3,5", -3.5),
        ("5\n", 5.0), ("<ND", None), (None, None), ("--1", None), ("١", None),
    ],
)
def test_qualified_number(one, text, number):
    assert one(fn.parse_qualified_number, text) == number


@pytest.mark.parametrize(
    "text, below, above",
    [("<0,01", True, False), (" <0,01", False, False), ("< 1", True, False),
     (">9", False, True), ("", False, False), (None, None, None)],
)
def test_threshold_flags(one, text, below, above):
    assert one(lambda c: fn.threshold_flag(c, "<"), text) is below
    assert one(lambda c: fn.threshold_flag(c, ">"), text) is above


def test_qualified_result_prefers_the_number(spark):
    df = spark.createDataFrame([(0.0, "<9"), (None, "<9"), (None, "ND")], "n double, t string")
    got = [r[0] for r in df.select(fn.qualified_result(F.col("n"), F.col("t"))).collect()]
    assert got == [0.0, 9.0, None]


@pytest.mark.parametrize(
    "text, unit",
    [("ug/l", "ug/L"), (" mg/l ", "mg/L"), ("MG/L", "mg/L"), ("us/cm", "uS/cm"), ("ntu", "NTU"),
     ("NFU", "NTU"), ("µg/l", "µg/l"), (" Bq/L", "Bq/L"), ("Mg/l", "Mg/l"), ("", ""), (None, None)],
)
def test_units(one, text, unit):
    assert one(lambda c: fn.map_codes(c, vocab.UNITS), text) == unit


@pytest.mark.parametrize(
    "text, status",
    [("c", "C"), (" n ", "N"), ("S", "S"), ("x", "X"), ("conforme", "CONFORME"), (None, None)],
)
def test_statuses(one, text, status):
    assert one(lambda c: fn.map_codes(c, vocab.STATUSES, fallback=F.upper), text) == status


@pytest.mark.parametrize(
    "label, category",
    [
        ("Tritium (activité)", "RADIOACTIVITE"), ("ALPHA GLOBAL NITRATES", "RADIOACTIVITE"),
        ("ESCHERICHIA COLI", "MICROBIOLOGIE"), ("COLIFORMES ET NITRATES", "MICROBIOLOGIE"),
        ("nitrates (en no3)", "CHIMIE"), ("PHOSPHORE", "CHIMIE"), ("CHLORE LIBRE", "CHIMIE"),
        ("SAVEUR", "AUTRE"), ("", "AUTRE"), (None, "AUTRE"),
    ],
)
def test_category(one, label, category):
    rule = lambda c: fn.keyword_category(c, vocab.CATEGORY_RULES, vocab.CATEGORY_DEFAULT)
    assert one(rule, label) == category


def test_every_keyword_decides(spark):
    words = [(w, name) for name, listed in vocab.CATEGORY_RULES for w in listed]
    df = spark.createDataFrame(words, "w string, name string")
    for name, listed in vocab.CATEGORY_RULES:
        hit = df.filter(F.col("name") == name).filter(~fn.contains_any(F.col("w"), listed))
        assert hit.count() == 0


@pytest.mark.parametrize(
    "statuses, worst",
    [("C C C C", "C"), ("N C C C", "N"), ("S C - C", "S"), ("N - - -", "N"), ("- - - -", "S"),
     ("C C C -", "S"), ("c C C C", "S")],
)
def test_worst_of_status(spark, statuses, worst):
    row = tuple(None if s == "-" else s for s in statuses.split())
    df = spark.createDataFrame([row], "a string, b string, c string, d string")
    assert df.select(fn.worst_of_status([F.col(c) for c in "abcd"])).first()[0] == worst


@pytest.mark.parametrize(
    "lon, lat, inside",
    [(-5.5, 41.0, True), (9.6, 51.2, True), (-5.5, 51.2, True), (9.6, 41.0, True),
     (-5.51, 45.0, False), (2.0, 51.21, False), (None, 45.0, None), (2.0, None, None)],
)
def test_bounding_box(spark, lon, lat, inside):
    df = spark.createDataFrame([(lon, lat)], "x double, y double")
    assert df.select(fn.in_bbox(F.col("x"), F.col("y"))).first()[0] is inside


@pytest.mark.parametrize(
    "text, expected",
    [("2025-01-02T03:04:05Z", "2025-01-02 03:04:05"), ("2025-13-01T00:00:00Z", None),
     ("2025-01-02", None), ("", None), (None, None)],
)
def test_instants(one, text, expected):
    assert one(lambda c: fn.parse_instant(c).cast("string"), text) == expected


def test_days(one):
    assert one(lambda c: fn.parse_day(c).cast("string"), "2010-10-16") == "2010-10-16"
    assert one(fn.parse_day, "16/10/2010") is None
    assert one(fn.parse_day, None) is None


def test_small_expressions(spark):
    df = spark.createDataFrame(
        [(1, 3, 100, 2025, 3, "a", None)], "p int, w int, n int, y int, m int, k string, z string"
    )
    row = df.select(
        fn.pct(F.col("p"), F.col("w")).alias("pct"),
        fn.pct(F.col("p"), F.lit(0)).alias("none"),
        fn.marker_size(F.col("n")).alias("mid"),
        fn.marker_size(F.lit(0)).alias("low"),
        fn.marker_size(F.lit(10_000)).alias("high"),
        fn.period_label(F.col("y"), F.col("m")).alias("period"),
        fn.period_label(F.col("y"), F.lit(None).cast("int")).alias("no_period"),
        fn.surrogate_key([F.col("k"), F.col("z"), F.col("p")]).alias("key"),
        fn.load_ts("2025-01-01 00:00:00").cast("string").alias("ts"),
    ).first()
    assert row.pct == 33.33 and row.none is None
    assert (row.mid, row.low, row.high) == (16, 12, 38)
    assert row.period == "2025-03" and row.no_period is None
    assert row.key == "a||||1"
    assert row.ts == "2025-01-01 00:00:00"
