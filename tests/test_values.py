"""Typed extraction (X1-X9): cases of the reference's type-conversion tests."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riverbed.functions import values as V


def one(spark, payload, expr):
    df = spark.createDataFrame([(payload,)], "j string").select(V.parse("j").alias("m"))
    return df.select(expr(F.col("m")).alias("x")).collect()[0]["x"]


def test_boolean(spark):
    assert one(spark, '{"a":true}', lambda m: V.to_boolean(m, "a")) is True
    assert one(spark, '{"a":false}', lambda m: V.to_boolean(m, "a")) is False
    assert one(spark, '{"a":null}', lambda m: V.to_boolean(m, "a")) is None
    assert one(spark, '{}', lambda m: V.to_boolean(m, "a")) is None
    assert one(spark, '{"a":"yes"}', lambda m: V.to_boolean(m, "a")) is False


def test_long(spark):
    assert one(spark, '{"a":"123456789"}', lambda m: V.to_long(m, "a")) == 123456789
    assert one(spark, '{"a":-123456789}', lambda m: V.to_long(m, "a")) == -123456789
    assert one(spark, '{"a":null}', lambda m: V.to_long(m, "a")) is None
    assert one(spark, '{"a":"abc"}', lambda m: V.to_long(m, "a")) == 0


def test_double(spark):
    assert one(spark, '{"a":123456.789}', lambda m: V.to_double(m, "a")) == pytest.approx(123456.789)
    assert one(spark, '{"a":-123456.789}', lambda m: V.to_double(m, "a")) == pytest.approx(-123456.789)
    assert one(spark, '{"a":12}', lambda m: V.to_double(m, "a")) == 12.0
    assert one(spark, '{"a":null}', lambda m: V.to_double(m, "a")) is None


def test_string_keeps_digits(spark):
    big = "1234567890123456789012345678901234567890"
    assert one(spark, '{"a":"abc"}', lambda m: V.to_string(m, "a")) == "abc"
    assert one(spark, '{"a":""}', lambda m: V.to_string(m, "a")) == ""
    assert one(spark, '{"a":%s}' % big, lambda m: V.to_string(m, "a")) == big
    assert one(spark, '{"a":"%s"}' % big, lambda m: V.to_string(m, "a")) == big
    assert one(spark, '{"a":true}', lambda m: V.to_string(m, "a")) == "true"


def test_numeric(spark):
    assert one(spark, '{"a":"123456789.0123456789"}', lambda m: V.to_numeric(m, "a")) == Decimal("123456789.012345679")
    assert one(spark, '{"a":"9223372036854775807"}', lambda m: V.to_numeric(m, "a")) == Decimal(
        "9223372036854775807.000000000")
    assert one(spark, '{"a":"1.2334567890345654542E10"}', lambda m: V.to_numeric(m, "a")) == Decimal(
        "12334567890.345654542")
    assert one(spark, '{"a":null}', lambda m: V.to_numeric(m, "a")) is None


def test_numeric_text_of_any_width(spark):
    """Against Python's decimals, at the widths of both paths."""
    from decimal import ROUND_HALF_UP, localcontext

    def plain(t):
        with localcontext() as ctx:
            ctx.prec = 400
            d = Decimal(t).quantize(Decimal("1E-9"), rounding=ROUND_HALF_UP)
            return format(abs(d) if d == 0 else d, "f")

    texts = ["0", "-0", "0.0000000004", "-0.0000000005", "0.0000000005", "9.9999999995", "1", "+1.5", ".5", "5.", "007.25", "1e3", "1E-3", "-12.5e-12", "1e40",
             "4e-10", "5e-10", "9" * 67, "-" + "9" * 67 + ".9999999995", "1" * 29 + ".1", "1" * 30 + ".1", "0" * 60 + "3.25", "1." + "0" * 70 + "5", "1.23456789" + "0" * 40 + "E45",
             "123456789012345678901234567890123456789012345678901234567890.1234567885", "9" * 29 + ".9999999999", "7e-400"]
    bad = ["", "abc", "1.2.3", "--1", "e5", ".", "1e", "1e200000", "1e99999999999", "NaN", "Infinity", "0x10"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + bad)] + [(-1, None)], "i int, t string")
    got = {r["i"]: r for r in df.select("i", V.numeric_text(F.col("t")).alias("wide"),
                                        V.to_numeric_text(F.create_map(F.lit("a"), F.col("t")), "a").alias("n")).collect()}
    for i, t in enumerate(texts):
        assert got[i]["wide"] == got[i]["n"] == plain(t), t
    assert all(r["wide"] is None and r["n"] is None for i, r in got.items() if i >= len(texts) or i < 0)
    assert V.to_numeric_text and one(spark, '{"a":%s}' % ("8" * 67), lambda m: V.to_numeric(m, "a")) is None
    with pytest.raises(Exception):
        one(spark, '{"a":"x"}', lambda m: V.to_numeric_text(m, "a", required=True))


def test_bytes(spark):
    assert one(spark, '{"a":"YWJj"}', lambda m: V.to_bytes(m, "a")) == bytearray(b"abc")


def test_timestamp(spark):
    for text, micros in [("2020-12-30T12:12:12Z", 0), ("2020-12-30T12:12:12.1Z", 100000),
                         ("2020-12-30T12:12:12.123Z", 123000), ("2020-12-30T12:12:12", 0)]:
        v = one(spark, '{"a":"%s"}' % text, lambda m: V.to_timestamp(m, "a"))
        assert v is not None and v.microsecond == micros
    assert one(spark, '{"a":"2020-12-30"}', lambda m: V.to_timestamp(m, "a")) is None
    assert one(spark, '{"a":12345}', lambda m: V.to_timestamp(m, "a")) is None
    assert one(spark, '{"a":true}', lambda m: V.to_timestamp(m, "a")) is None
    with pytest.raises(Exception):
        one(spark, '{"a":"2020-12-30"}', lambda m: V.to_timestamp(m, "a", required=True))
    assert one(spark, '{"a":"2023-05-18T12:01:13.088397258Z"}', lambda m: V.timestamp_nanos(m, "a")) == 88397258


def test_date(spark):
    assert str(one(spark, '{"a":"2020-12-30"}', lambda m: V.to_date(m, "a"))) == "2020-12-30"
    # documented difference: an impossible date is NULL here
    assert one(spark, '{"a":"2020-02-30"}', lambda m: V.to_date(m, "a")) is None
    assert one(spark, '{"a":12345}', lambda m: V.to_date(m, "a")) is None
    with pytest.raises(Exception):
        one(spark, '{"a":true}', lambda m: V.to_date(m, "a", required=True))


def test_required_missing_raises(spark):
    with pytest.raises(Exception):
        one(spark, '{"a":null}', lambda m: V.to_long(m, "a", required=True))
    with pytest.raises(Exception):
        one(spark, '{}', lambda m: V.to_string(m, "a", required=True))


def test_presence_three_states(spark):
    assert one(spark, '{"a":null}', lambda m: V.has(m, "a")) is True
    assert one(spark, '{"a":null}', lambda m: V.is_json_null(m, "a")) is True
    assert one(spark, '{}', lambda m: V.has(m, "a")) is False
    assert one(spark, '{"a":1}', lambda m: V.is_json_null(m, "a")) is False


def test_extract_dispatch(spark):
    assert one(spark, '{"a":"12"}', lambda m: V.extract(m, "a", "PG_INT8")) == 12
    with pytest.raises(ValueError):
        V.extract(F.col("m"), "a", "GEOGRAPHY")


def test_numbers_keep_written_digits(spark):
    def both(j, key="a"):
        df = spark.createDataFrame([(j,)], "j string")
        r = df.select(V.to_string(V.parse("j"), key, exact_m=V.exact("j")).alias("s"),
                      V.to_numeric(V.parse("j"), key, exact_m=V.exact("j")).alias("n")).collect()[0]
        return r["s"], r["n"]
    assert both('{"a":123456789.0123456789}') == ("123456789.0123456789", Decimal("123456789.012345679"))
    assert both('{"a":1.2334567890345654542E10}')[1] == Decimal("12334567890.345654542")
    assert both('{"a":123345.67890345654542}')[1] == Decimal("123345.678903457")
    assert both('{"b":{"a":1},"a":12.0}')[0] == "12.0"
    s, _ = both('{"x":"\\"a\\":1.23456789012345678","a":0.5}')
    assert s == "0.5"
