"""The drop flavour's number parsing against Java's Double.parseDouble
(after String.trim), called through the session's JVM."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from numprof.functions.columns import parse_double

TOKENS = ["0", "1", "7", "42", ".", "e", "E", "-", "+", "inf", "Inf", "Infinity", "infinity",
          "NaN", "nan", "d", "f", "D", "F", "x", "0x1p3", "p", "_", " ", "\t", "\r", "\x0b", "\x01",
          "1e400", "abc"]


JAVA_TRIM = "".join(chr(c) for c in range(0x21))   # String.trim strips chars <= U+0020


def java_parse(spark, s):
    try:
        return spark._jvm.java.lang.Double.parseDouble(s.strip(JAVA_TRIM))
    except Exception:  # noqa: BLE001 - NumberFormatException
        return None


def same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return a == b


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(TOKENS), min_size=1, max_size=5).map("".join),
                min_size=20, max_size=20))
def test_strict_parse_matches_java(spark, lines):
    df = spark.createDataFrame([(s,) for s in lines], "s string")
    got = [r[0] for r in df.select(parse_double("s", strict=True)).collect()]
    for s, g in zip(lines, got):
        assert same(g, java_parse(spark, s)), repr(s)


def test_known_spellings(spark):
    lines = ["1.5", " 2 ", "Infinity", "-Infinity", "NaN", "inf", "nan", "1d", "0x1p3", "1_000", "",
             "inf\t", "\tNaN ", "Infinity\t", " +Infinity", "-nan", "1.0\r", "\x01 2.5", "NaN\r"]
    df = spark.createDataFrame([(s,) for s in lines], "s string")
    got = [r[0] for r in df.select(parse_double("s", strict=True)).collect()]
    for s, g in zip(lines, got):
        assert same(g, java_parse(spark, s)), repr(s)
