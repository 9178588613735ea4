import datetime
import decimal
import itertools
import re

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F

from ordermill.functions import blank_to_null, day_bucket, line_amount, parse_date, parse_number, surrogate_key, utc_date

D = decimal.Decimal

DATES = {
    "2023-01-05": "2023-01-05", " 2023-1-5 ": "2023-01-05", "2023/01/05": "2023-01-05", "2023/1/5": "2023-01-05",
    "2023-01-05xyz": "2023-01-05", "2023-01-05T10:00": "2023-01-05", "2023-02-30": None, "2023-13-01": None,
    "01/02/2023": None, "12345-01-01": None, "2023-01-001": None, "2023-01/05": None, "23-1-5": "0023-01-05",
    "2023": None, "2023-01": None, "": None, "  ": None, "never": None, None: None, "2024-02-29": "2024-02-29",
    "2023-02-29": None, "-2023-01-01": None,
}
NUMBERS = {
    "2,00": (2, D("2.00")), " 2 ": (2, D("2.00")), "2.5": (3, D("2.50")), "-2.5": (-3, D("-2.50")), "1 000": (1000, D("1000.00")),
    "1,234.50": (None, None), "": (None, None), "   ": (None, None), "\t": (None, None), "abc": (None, None), None: (None, None),
    "10,999": (11, D("11.00")), "99999999999": (None, None), "123456789.99": (123456790, None), "1e2": (100, D("100.00")),
    "NaN": (None, None), "Infinity": (None, None), "+3": (3, D("3.00")), "\t7\t": (7, D("7.00")),
}
SESSIONS = list(itertools.product(("true", "false"), ("LEGACY", "CORRECTED", "EXCEPTION"), ("UTC", "America/New_York")))


@pytest.mark.parametrize("ansi,policy,zone", SESSIONS)
def test_parsing_ignores_session_settings(spark, settings, ansi, policy, zone):
    settings(spark__sql__ansi__enabled=ansi, spark__sql__legacy__timeParserPolicy=policy, spark__sql__session__timeZone=zone)
    dates = spark.createDataFrame([(t,) for t in DATES], "t string").select("t", parse_date("t").cast("string")).collect()
    assert {t: d for t, d in dates} == DATES
    numbers = spark.createDataFrame([(t,) for t in NUMBERS], "t string").select(
        "t", parse_number("t", "int"), parse_number("t", "decimal(10,2)")
    ).collect()
    assert {t: (i, d) for t, i, d in numbers} == NUMBERS


def test_date_forms(spark):
    df = spark.createDataFrame([("2023-01-05",), ("2023/01/05",), ("05/01/2023",), ("2023-01-05x",)], "t string")
    got = df.select(
        parse_date("t", ("-",)), parse_date("t", ("-", "/", "dd/MM/yyyy")), parse_date("t", strict=True)
    ).collect()
    day = datetime.date(2023, 1, 5)
    assert [tuple(r) for r in got] == [(day, day, day), (None, day, day), (None, day, None), (day, day, None)]
    with pytest.raises(ValueError):
        parse_date("t", ("MM-yy",))
    with pytest.raises(ValueError):
        parse_date("t", ())


@hypothesis_settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789-/ xT", max_size=12), min_size=20, max_size=60))
def test_dates_agree_with_python(spark, texts):
    def expected(text):
        text = text.strip(" ")
        for mark in "-/":
            found = re.match(rf"(\d{{1,4}}){mark}(\d{{1,2}}){mark}(\d{{1,2}})(\D|$)", text)
            if found:
                try:
                    return datetime.date(*(int(part) for part in found.groups()[:3]))
                except ValueError:
                    return None
        return None

    # Python has no year 0.
    texts = [t for t in texts if not re.match(r" *0+[-/]", t)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_date("t")).collect()
    assert [(t, d) for t, d in got] == [(t, expected(t)) for t in texts]


@hypothesis_settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789., -", max_size=9), min_size=20, max_size=60))
def test_numbers_agree_with_python(spark, texts):
    def expected(text):
        try:
            value = D(re.sub(r"\s", "", text).replace(",", "."))
        except decimal.InvalidOperation:
            return None
        value = value.quantize(D("0.01"), decimal.ROUND_HALF_UP)
        return value if abs(value) < 10**8 else None

    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_number("t", "decimal(10,2)")).collect()
    assert [(t, v) for t, v in got] == [(t, expected(t)) for t in texts]


def test_blank_to_null(spark):
    df = spark.createDataFrame([("",), ("  ",), (" a ",), (None,)], "t string")
    assert [r[0] for r in df.select(blank_to_null("t")).collect()] == [None, None, " a ", None]


def test_line_amount_is_exact_and_never_raises(spark):
    df = spark.sql("SELECT * FROM VALUES (3, 0.10BD), (2147483647, 99999999.99BD), (null, 1.00BD) AS t(quantity, price)")
    out = df.select(line_amount("quantity", F.col("price").cast("decimal(10,2)")).alias("a"),
                    line_amount("quantity", F.col("price").cast("decimal(10,2)"), "decimal(12,2)").alias("b"))
    assert out.dtypes == [("a", "decimal(18,2)"), ("b", "decimal(12,2)")]
    assert [tuple(r) for r in out.collect()] == [(D("0.30"), D("0.30")), (None, None), (None, None)]


def test_surrogate_key(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', null), (null, 'a'), ('a', 'b') AS t(x, y)")
    plain = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    marked = [r[0] for r in df.select(surrogate_key("x", "y", null_marker="\u0000")).collect()]
    assert plain[0] == plain[1] and len(set(marked)) == 3 and len(plain[0]) == 64
    assert len(df.select(surrogate_key("x", bits=128)).first()[0]) == 32


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_days_ignore_the_time_zone(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    df = spark.sql("SELECT TIMESTAMP '2025-03-21T23:30:00Z' AS ts, TIMESTAMP_NTZ '2025-03-21 23:30:00' AS wall, "
                   "TIMESTAMP '1969-12-31T23:00:00Z' AS old")
    row = df.select(utc_date("ts").cast("string"), day_bucket("wall").cast("string"), utc_date("old").cast("string")).first()
    assert tuple(row) == ("2025-03-21", "2025-03-21 00:00:00", "1969-12-31")
