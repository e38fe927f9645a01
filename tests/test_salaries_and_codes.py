import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from emploiscope.functions import codes, salaries

PRICES = [
    # low, high, period, annual low, annual high
    (15000.0, None, "annuel", 15000.0, 15000.0),
    (250000.0, None, "annuel", 250000.0, 250000.0),
    (1000.0, None, "mensuel", 12000.0, 12000.0),
    (14999.0, None, "mensuel", 179988.0, 179988.0),
    (14999.5, None, None, None, None),
    (999.99, None, None, None, None),
    (250000.01, None, None, None, None),
    (None, 40000.0, "annuel", None, 40000.0),
    (2000.0, 40000.0, "mensuel", 24000.0, 480000.0),
    (0.0, 50000.0, None, None, None),
    (45000.0, 55000.0, "annuel", 45000.0, 55000.0),
    (None, None, None, None, None),
]


def test_salary_period_and_annual_bounds(spark):
    df = spark.createDataFrame([(low, high) for low, high, *_ in PRICES], "low double, high double").coalesce(1)
    low, high = F.col("low"), F.col("high")
    priced = df.withColumn("p", salaries.salary_period(low, high))
    got = priced.select(
        "p", salaries.annual_low(F.col("p"), low), salaries.annual_high(F.col("p"), low, high)
    ).collect()
    assert [tuple(r) for r in got] == [tuple(p[2:]) for p in PRICES]


def test_salary_source(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (None, None)], "a double, b double").coalesce(1)
    got = [r[0] for r in df.select(salaries.salary_source(F.col("a"), F.col("b"))).collect()]
    assert got == ["declare", "declare", None]


SENTENCES = [
    # sentence, period, low, high, months
    ("Annuel de 35000.0 Euros à 45000.0 Euros sur 12.0 mois", "annuel", 35000.0, 45000.0, 12.0),
    ("Mensuel de 2500.0 Euros sur 13.0 mois", "mensuel", 2500.0, None, 13.0),
    ("Horaire de 12,5 Euros", "horaire", 12.5, None, 12.0),
    ("Annuel de 40000 Euros", "annuel", 40000.0, None, 12.0),
    ("A négocier", None, None, None, 12.0),
    ("", None, None, None, 12.0),
    (None, None, None, None, 12.0),
]


def test_salary_sentences(spark):
    df = spark.createDataFrame([(s,) for s, *_ in SENTENCES], "s string").coalesce(1)
    s = F.col("s")
    got = df.select(
        salaries.sentence_period(s), salaries.sentence_low(s), salaries.sentence_high(s), salaries.sentence_months(s)
    ).collect()
    assert [tuple(r) for r in got] == [tuple(x[1:]) for x in SENTENCES]


def test_sentence_annual_amounts(spark):
    df = spark.createDataFrame([("annuel",), ("mensuel",), ("horaire",), (None,)], "p string").coalesce(1)
    got = [r[0] for r in df.select(salaries.sentence_annual(F.col("p"), F.lit(10.0), F.lit(13.0))).collect()]
    assert got == [10.0, 130.0, 18200.0, None]


def test_masked_number(spark):
    df = spark.createDataFrame([("*",), ("12",), (None,), ("0",)], "n string").coalesce(1)
    assert [r[0] for r in df.select(codes.masked_number(F.col("n"))).collect()] == [None, 12, None, 0]


@pytest.mark.parametrize("text", ["12.7", "abc", ""])
def test_masked_number_rejects_other_text(spark, text):
    with pytest.raises(PySparkException):
        spark.createDataFrame([(text,)], "n string").select(codes.masked_number(F.col("n"))).collect()


def test_city_commune(spark):
    texts = ["75101", "75120", "75100", "75121", "7511", "75056", "69001", None]
    df = spark.createDataFrame([(t,) for t in texts], "c string").coalesce(1)
    got = [r[0] for r in df.select(codes.city_commune(F.col("c"))).collect()]
    assert got == ["75056", "75056", "75100", "75121", "7511", "75056", "69001", None]


def test_code_and_label(spark):
    text = "62 Programmation, conseil et autres activités informatiques"
    row = spark.createDataFrame([(text,)], "s string").select(codes.leading_code(F.col("s")), codes.label_after_code(F.col("s")))
    assert tuple(row.first()) == (62, "Programmation, conseil et autres activités informatiques")


def test_name_key(spark):
    names = ["Côte-d’Or", "cote d'or", "  Val--d'Oise ", "ÎLE-DE-FRANCE", None]
    df = spark.createDataFrame([(n,) for n in names], "n string").coalesce(1)
    got = [r[0] for r in df.select(codes.name_key(F.col("n"))).collect()]
    assert got == ["cote d or", "cote d or", "val d oise", "ile de france", None]


def test_utc_timestamp_and_month(spark):
    texts = ["2026-03-20T07:53:25Z", "2026-03-01T00:30:00+02:00", "2026-03-20T07:53:25", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(codes.utc_timestamp(F.col("t")).alias("u"))
    got = df.select(F.date_format("u", "yyyy-MM-dd HH:mm:ss"), codes.month_tag(F.col("u"))).collect()
    assert [tuple(r) for r in got] == [
        ("2026-03-20 07:53:25", "2026-03"),
        ("2026-02-28 22:30:00", "2026-02"),
        ("2026-03-20 07:53:25", "2026-03"),
        (None, None),
    ]


def test_utc_timestamp_rejects_other_text(spark):
    with pytest.raises(PySparkException):
        spark.createDataFrame([("soon",)], "t string").select(codes.utc_timestamp(F.col("t"))).collect()


def test_rounded_percentage(spark):
    rows = [(1158, 2824, 41.0), (371, 526, 70.5), (90, 180, 50.0), (0, 0, None), (None, 3, None), (3, None, None), (1, 3, 33.3)]
    df = spark.createDataFrame([r[:2] for r in rows], "part bigint, total bigint").coalesce(1)
    result = df.select(codes.rounded_percentage(F.col("part"), F.col("total")).alias("p"))
    assert result.dtypes == [("p", "double")]
    assert [r[0] for r in result.collect()] == [r[2] for r in rows]


def test_stamp_uses_the_given_date(spark):
    from emploiscope.sources.sink import stamp

    row = stamp(spark.range(1), datetime.date(2026, 3, 20)).first()
    assert row["_ingestion_date"] == datetime.date(2026, 3, 20)


def test_iso_texts_with_every_offset(spark):
    texts = {
        "2026-03-20": "2026-03-20 00:00:00",
        "2026-03-20T10:00:00": "2026-03-20 10:00:00",
        "2026-03-20T10:00:00Z": "2026-03-20 10:00:00",
        "2026-03-20T10:00:00+02": "2026-03-20 08:00:00",
        "2026-03-20T10:00:00-0330": "2026-03-20 13:30:00",
        "2026-03-20 10:00:00.5+02:00": "2026-03-20 08:00:00",
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r[0]: r[1] for r in df.select("t", F.date_format(codes.utc_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss")).collect()}
    assert got == texts


def test_salary_sentences_with_digit_groups(spark):
    cases = {
        "Mensuel de 2 500,00 Euros à 3 000,00 Euros": (2500.0, 3000.0),
        "Annuel de 35 000 Euros": (35000.0, None),
        "Annuel de 35\u202f000 Euros à 1\u00a0035\u00a0000,5 €": (35000.0, 1035000.5),
        "Annuel de 35000.0 à 45000.0 Euros": (35000.0, 45000.0),
        "Annuel selon profil, 13 mois": (None, None),
        "Horaire de 12,5 Euros sur 12 mois": (12.5, None),
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r[0]: (r[1], r[2]) for r in df.select("t", salaries.sentence_low(F.col("t")), salaries.sentence_high(F.col("t"))).collect()}
    assert got == cases
