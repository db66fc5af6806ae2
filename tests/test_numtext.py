"""Number text: strict parsing and shortest decimal printing."""

import math
from decimal import Decimal

import pytest

from tallyfold.functions.numtext import format_fixed6, format_int, format_shortest, indexed_name, parse_counter, parse_gauge


def go_shortest(v: float) -> str:
    """Shortest round-trip digits, no exponent (the reference's text form)."""
    if math.isnan(v):
        return "NaN"
    if math.isinf(v):
        return "+Inf" if v > 0 else "-Inf"
    d = Decimal(repr(v))
    s = format(d, "f")
    if "." in s:
        s = s.rstrip("0").rstrip(".")
    return "0" if s in ("-0", "") else s if s != "-0" else "-0"


VALUES = [0.0, 5.0, 42.5, 12.0, 6.55, 0.001, 0.0015, 1e-5, -1.5e-4, 1e7, 1.0000001e7, 1234567.0,
          123456789.123, 1e10, 1.2345678901234568e20, 1e21, 3.14, 2.718, 99.9, 1e-300, -0.25,
          float("nan"), float("inf"), float("-inf")]


def test_format_shortest(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v double")
    got = [r.s for r in df.select(format_shortest("v").alias("s")).collect()]
    assert got == [go_shortest(v) for v in VALUES]


def test_format_fixed_and_int(spark):
    df = spark.createDataFrame([(1.23, 99), (float("nan"), -5), (float("-inf"), 0)], "v double, n long")
    out = df.select(format_fixed6("v").alias("f"), format_int("n").alias("d")).collect()
    assert [(r.f, r.d) for r in out] == [("1.230000", "99"), ("NaN", "-5"), ("-Inf", "0")]


@pytest.mark.parametrize("text,expected", [
    ("5", 5), ("-5", -5), ("+7", 7), (" 5", None), ("5 ", None), ("5.0", None), ("", None), (None, None),
    ("9223372036854775807", 9223372036854775807), ("9223372036854775808", None), ("0x10", None),
])
def test_parse_counter(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_counter("t").alias("x")).first().x == expected


@pytest.mark.parametrize("text,expected", [
    ("42.5", 42.5), ("-1e3", -1000.0), (".5", 0.5), ("5.", 5.0), ("1E-2", 0.01), ("inf", math.inf),
    ("-Infinity", -math.inf), ("1e400", None), ("1.0d", None), ("1f", None), (" 1", None), ("abc", None),
    ("", None), ("0x1p-2", 0.25), ("0x18", None), ("1.5\n", None),
])
def test_parse_gauge(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_gauge("t").alias("x")).first().x == expected


def test_parse_gauge_nan(spark):
    df = spark.createDataFrame([("NaN",), ("nan",)], "t string")
    assert all(math.isnan(r.x) for r in df.select(parse_gauge("t").alias("x")).collect())


def test_indexed_name(spark):
    df = spark.createDataFrame([(0,), (3,)], "p int")
    assert [r.n for r in df.select(indexed_name("CPUutilization", "p").alias("n")).collect()] == [
        "CPUutilization1", "CPUutilization4"]


def test_zone_free_time_conversions(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from tallyfold.functions.timeutil import epoch_seconds, utc_instant, utc_wall

    vals = [dt.datetime(2024, 3, 10, 2, 30, 0, 123456), dt.datetime(2024, 11, 3, 1, 30),
            dt.datetime(1969, 12, 31, 23, 59, 59, 500000), dt.datetime(2024, 1, 1)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ["UTC", "America/New_York", "Asia/Kolkata"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.createDataFrame([(v,) for v in vals], "t timestamp_ntz")
            out = df.select("t", F.unix_micros(utc_instant(F.col("t"))).alias("um"),
                            utc_wall(utc_instant(F.col("t"))).alias("back"), epoch_seconds(F.col("t")).alias("s")).collect()
            for r in out:
                exact = (r.t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
                assert r.um == exact and r.back == r.t and r.s == exact // 1_000_000, (tz, r)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_fixed6_rounds_exact_binary_value(spark):
    # Shortest text ends in a 5 at the 7th decimal; the exact binary value
    # decides the rounding (Java's formatter would round these up).
    vals = [5e-7, 1234.5678905, 1.0000005, 2.5e-7, -7.1234565, 9.9999995, 2.0**60]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert [r.f for r in df.select(format_fixed6("v").alias("f")).collect()] == ["%f" % v for v in vals]


def test_fixed6_of_any_magnitude(spark):
    vals = [1e30, 1.5e30, -2.0**100, 1e31, 2.0**120, 3.3e44, 1.7976931348623157e308, 2.0**1023, 9.007199254740993e35, 1e100]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert [r.f for r in df.select(format_fixed6("v").alias("f")).collect()] == ["%f" % v for v in vals]


def test_shortest_text_where_java_prints_extra_digits(spark):
    vals = [2e23, 1e23, 5e-324, -5.703712459035042e16, 5.410487932934154e18]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r.s for r in df.select(format_shortest("v").alias("s")).collect()]
    assert got == [go_shortest(v) for v in vals]
    assert got[2] == "0." + "0" * 323 + "5"
