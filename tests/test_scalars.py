"""Scalar expressions: spike flag, categories, flags, parsing, casts."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotelake.functions import scalars


def _eval(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


@pytest.mark.parametrize("volume,avg,expected", [
    (7.0, 7.5, False), (7.5, 7.5, False), (7.500001, 7.5, True),
    (None, 7.5, False), (-1.0, -2.0, True), (8.0, None, False),
])
def test_spike_flag_cases(spark, volume, avg, expected):
    got = _eval(spark, [(volume, avg)], "v double, a double", scalars.spike_flag("v", "a"))
    assert got == [expected]


def test_spike_flag_factor(spark):
    got = _eval(spark, [(250.0, 200.0), (450.0, 200.0)], "v double, a double",
                scalars.spike_flag("v", "a", factor=2.0))
    assert got == [False, True]


@pytest.mark.parametrize("price,expected", [
    (1000.01, "high"), (1000.0, "medium"), (100.0, "low"), (None, "low"), (100.5, "medium"),
])
def test_price_category(spark, price, expected):
    assert _eval(spark, [(price,)], "p double", scalars.price_category("p")) == [expected]


def test_flags_null_as_false(spark):
    df = spark.createDataFrame([(None, None), (1.5, 2000.0), (-1.0, 10.0)], "pct double, vol double")
    got = df.select(scalars.is_price_positive("pct"), scalars.volatility_flag("vol")).collect()
    assert [tuple(r) for r in got] == [(False, False), (True, True), (False, False)]


def test_price_range(spark):
    assert _eval(spark, [(12.0, 10.5)], "h double, l double", scalars.price_range_24h("h", "l")) == [1.5]


def test_parse_iso_ts_keeps_millis_and_nulls_bad_text(spark):
    got = _eval(spark, [("2024-03-01T12:34:56.789Z",), ("2024-03-01T12:34:56Z",), ("garbage",), (None,)],
                "t string", scalars.parse_iso_ts("t"))
    assert got[0] == dt.datetime(2024, 3, 1, 12, 34, 56, 789000)
    assert got[1] == dt.datetime(2024, 3, 1, 12, 34, 56)
    assert got[2] is None and got[3] is None


def test_try_casts(spark):
    df = spark.createDataFrame([("12.5", "7", "abc")], "a string, b string, c string")
    r = df.select(scalars.to_double("a"), scalars.to_long("b"), scalars.to_double("c"),
                  scalars.to_long("a")).first()
    assert r[0] == 12.5 and r[1] == 7 and r[2] is None


def test_decimal_overflow_is_null(spark):
    got = _eval(spark, [(123.456789,), (1.5e6,)], "v double", scalars.to_decimal("v", 10, 4))
    assert str(got[0]) == "123.4568" and got[1] is None


def test_bucket(spark):
    expr = scalars.bucket("v", [(10.0, "hi"), (5.0, "mid")], "lo")
    assert _eval(spark, [(11.0,), (10.0,), (5.0,), (None,)], "v double", expr) == ["hi", "mid", "lo", "lo"]


def test_bucket_without_edges_is_constant(spark):
    assert _eval(spark, [(1.0,), (None,)], "v double", scalars.bucket("v", [], "low")) == ["low", "low"]


def test_duration_micros():
    assert scalars.duration_micros("5 minutes") == 300_000_000
    assert scalars.duration_micros("1 day") == 86_400_000_000
    import pytest
    with pytest.raises(ValueError):
        scalars.duration_micros("1 month")
