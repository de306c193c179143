from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierflow.functions import (
    date_stamp,
    file_stem,
    market_codes,
    numeric_text,
    safe_numeric,
    safe_numeric_sql,
    split_literal,
    uri_text,
)


def one(spark, column, **cells):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cells.items()])
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "path,stem",
    [
        ("gs://bucket/dir/a.csv", "a"),
        ("/x/a.v2.csv", "a"),
        ("a", "a"),
        ("/x/.hidden", ""),
        ("/x/dir.d/", ""),
        (None, None),
    ],
)
def test_file_stem(spark, path, stem):
    assert one(spark, file_stem("p"), p=path) == stem


def test_split_is_literal(spark):
    assert one(spark, split_literal("s", "."), s="a.b.c") == ["a", "b", "c"]
    assert one(spark, split_literal("s", "|"), s="a|b") == ["a", "b"]


def test_uri_text_keeps_plus_and_decodes_blank(spark):
    assert one(spark, uri_text("u"), u="file:/a%20b+c.csv") == "file:/a b+c.csv"


@pytest.mark.parametrize(
    "text,number",
    [
        ("12", "12"), ("19.4", "19.4"), (" 7 ", "7"), ("1e3", "1000"), ("+5", "5"),
        (".5", "0.5"), ("5.", "5"), ("-3", "-3"), ("0.1234567895", "0.123456790"),
        ("", None), ("abc", None), ("1,000", None), ("NaN", None), (None, None),
        ("123456789012345678901234567890", None),
    ],
)
def test_safe_numeric(spark, text, number):
    got = one(spark, safe_numeric("t"), t=text)
    assert got == (None if number is None else Decimal(number))


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "number,text",
    [
        ("100", "100"), ("19.4", "19.4"), ("0", "0"), ("0.05", "0.05"), ("-2.50", "-2.5"),
        ("0.000000001", "0.000000001"), ("1000", "1000"), ("-7", "-7"),
        ("-0.0000005", "-0.0000005"), ("12345678901234567890123456789", "12345678901234567890123456789"),
        ("-12345678901234567890.5", "-12345678901234567890.5"), (None, None),
    ],
)
def test_numeric_text(spark, number, text, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert one(spark, numeric_text(safe_numeric_sql("n")), n=number) == text
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize(
    "code,expected",
    [
        ("in", ("in", None)), ("AUS", (None, "AUS")), (" NZ ", ("NZ", None)),
        ("WI-A", (None, None)), ("", (None, None)), (None, (None, None)),
    ],
)
def test_market_codes(spark, code, expected):
    two, three = market_codes("c")
    assert one(spark, F.struct(two.alias("a"), three.alias("b")), c=code) == expected


def test_date_stamps(spark):
    ts = F.lit("2024-03-05 06:07:08").cast("timestamp")
    df = spark.range(1).select(ts.alias("t"))
    got = df.select(*[date_stamp("t", k).alias(k) for k in ("day", "second", "folder")]).first()
    assert tuple(got) == ("20240305", "20240305_060708", "2024-03-05")
