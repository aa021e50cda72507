import pytest
from pyspark.sql import functions as F

from fieldmill.functions.dates import from_epoch, parsed_dates
from fieldmill.functions.numbers import five_digits, money, ratios, safe_log
from fieldmill.functions.text import (
    cleaned,
    header_fields,
    kept_tokens,
    text_measures,
    tokens,
)

CASES = {
    "quoted": ('From: "MR. X" <x@y.com>\nSubject: Hi there\nStatus: RO\nbody',
               "x@y.com", "MR. X", "Hi there", "\nbody"),
    "bare": ("From: x@y.com\nSubject:\nStatus: O\nb", "x@y.com", None, "Status: O", "\nb"),
    "nothing": ("no header", None, None, None, None),
    "two marks": ("Status: RO\none Status: RO two", None, None, None, "\none Status: RO two"),
    "both marks": ("Status: O\none Status: RO two", None, None, None, "\none "),
    "empty body": ("Status: O", None, None, None, ""),
}


@pytest.mark.parametrize("name", CASES)
def test_header_fields(spark, name):
    text, email, sender, subject, body = CASES[name]
    row = spark.createDataFrame([(text,)], "emails string").select(
        *(c.alias(n) for n, c in header_fields("emails").items())
    ).first()
    assert (row["sender_email"], row["email_text"]) == (email, body)
    assert row["subject"] == subject
    assert (row["sender_name"] or "").strip() == (sender or "")


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("x")).first()["x"]


def test_cleaning(spark):
    assert one(spark, "A <b>bold</b>, 2\n\nLINES!", cleaned("t")) == "a bold lines "
    # a tag does not reach over a line end
    assert one(spark, "a <b\nc> d", cleaned("t")) == "a b c d"
    assert one(spark, "", cleaned("t")) == ""
    assert one(spark, None, cleaned("t")) is None


def test_tokens(spark):
    assert one(spark, "a  b", tokens("t")) == ["a", "", "b"]
    assert one(spark, "x|y|z", tokens("t", "|")) == ["x", "y", "z"]
    assert one(spark, "a.b", tokens("t", ".")) == ["a", "b"]
    df = spark.createDataFrame([(["the", "big", "of", "dog", "an"],)], "w array<string>")
    got = df.select(kept_tokens("w", {"the", "of"}).alias("w")).first()["w"]
    assert got == ["big", "dog"]


def test_measures(spark):
    df = spark.createDataFrame([("Ab 1é!",), ("",), (None,)], "t string")
    got = [tuple(r) for r in df.select(*text_measures("t").values()).collect()]
    assert got[0] == pytest.approx((6, 1 / 6, 3 / 6))
    assert got[1] == (0, None, None) and got[2] == (None, None, None)


def test_numbers(spark):
    assert one(spark, "$60,000.00 ", money("t")) == 6_000_000.0
    assert one(spark, "n/a", money("t")) is None
    assert one(spark, "501", five_digits("t")) == "00501"
    df = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0)], "a double, b double")
    got = df.select(*ratios({"r": ("a", "b")}).values(), safe_log("b")).collect()
    assert [r[0] for r in got] == [None, 2.0] and got[0][1] is None


def test_dates(spark):
    df = spark.createDataFrame([("17.14.11", "2017-11-14T10:00:00.000Z"), ("70.01.02", "odd")],
                               "a string, b string")
    out = df.select(
        *(c.alias(n) for n, c in parsed_dates(
            {"a": "yy.dd.MM", "b": "yyyy-MM-dd'T'HH:mm:ss[.SSS]X"}).items())
    ).collect()
    assert [str(r["a"]) for r in out] == ["2017-11-14", "1970-02-01"]
    assert [str(r["b"]) for r in out] == ["2017-11-14", "None"]
    stamp = spark.createDataFrame([("1.9",)], "ts string").select(
        F.unix_micros(from_epoch("ts")), F.unix_micros(from_epoch("ts", keep_fraction=True))
    ).first()
    assert tuple(stamp) == (1_000_000, 1_900_000)
