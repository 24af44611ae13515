"""Cleaning rules on hand-written edge cases."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quorate import functions as fn
from quorate.operators.standardize import Rule, standardize


def apply(spark, column, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("v"))).collect()]


def test_names(spark):
    got = apply(spark, fn.clean_name, ["  aCME   bio-tech ", "a \tb\x1cc", "", None, "o'NEIL (usa)", "ßa x"])
    assert got == ["Acme Bio-tech", "A B C", "", "", "O'neil (usa)", "Ssa X"]


def test_strip_keeps_inner_space(spark):
    assert apply(spark, fn.strip, ["  a  b\n", "\x1f", None]) == ["a  b", "", None]


def test_urls(spark):
    got = apply(spark, fn.clean_url, ["example.org", " http://a.b ", "", "  ", None, "HTTP://x"])
    assert got == ["https://example.org", "http://a.b", "", "", "", "https://HTTP://x"]
    got = apply(spark, fn.is_web_url, ["http://a", "HTTPS://a/b", "ftp://a", "http:///x", "", None, "a.b"])
    assert got == [True, True, False, False, False, False, False]


def test_dates(spark):
    texts = ["Aug 7, 2025", "August 7, 2025", "2025-8-7", " aug  07, 2025", "2025-02-30", "7/8/25", "", None, "May 1, 2020", "Sept 1, 2020", "0000-01-01", "12025-01-01"]
    day = date(2025, 8, 7)
    assert apply(spark, fn.parse_date, texts) == [day, day, day, day, None, None, None, None, date(2020, 5, 1), None, None, None]


def test_record_dates(spark):
    texts = ["2025-08-07", "07/08/2025", "12/25/2020", "13/25/2020", "2025-8-7 1:2:3", "2025-08-07 24:00:00", " 2025-08-07"]
    assert apply(spark, fn.parse_record_date, texts) == [
        date(2025, 8, 7), date(2025, 8, 7), date(2020, 12, 25), None, date(2025, 8, 7), None, None,
    ]


def test_feed_dates(spark):
    got = apply(spark, fn.parse_mail_date, ["Fri, 31 Jan 2025 07:00:00 GMT", "Fri, 31 Feb 2025 07:00:00 GMT", "31 Jan 2025", None])
    assert got == [date(2025, 1, 31), None, None, None]
    got = apply(spark, fn.parse_instant_date, ["2025-01-31T00:00:00Z", "2025-01-31", "x"])
    assert got == [date(2025, 1, 31), None, None]


def test_amounts(spark):
    cases = {
        "₹10.5 Cr": 105000000, "5 Lakh": 500000, "15 million": 15000000, "2.3B": 2300000000, "1,00,000": 100000,
        "10000000": 10000000, "Rs. 5": 5, "abc": None, "1.2.3": None, "5K": None, "": None, "1.0E7": 10000000,
        "12 crores": 120000000, "99999999999999999999": None,
    }
    got = apply(spark, fn.parse_amount, list(cases))
    assert got == [None if v is None else Decimal(v).quantize(Decimal("0.01")) for v in cases.values()]


def test_registration_numbers(spark):
    good = "U12345MH2020PTC000001"
    got = apply(spark, fn.clean_number, [f" {good.lower()} ", good[:-1], "Z" + good[1:], None])
    assert got == [good, None, None, None]


def test_truncation(spark):
    short = lambda c: fn.truncate_words(c, 10)
    assert apply(spark, short, ["one two three", "abcdefghijklmno", " a  b ", "", None, "0123456789"]) == [
        "one two...", "abcdefghij...", "a b", "", "", "0123456789",
    ]


def test_lists(spark):
    rows = spark.createDataFrame([(1, [" ", "a ", "b"]), (2, ["", None]), (3, [])], "i INT, v ARRAY<STRING>")
    clean, counts = standardize(rows, [Rule("v", "location", "place"), Rule("v", "url", "url")])
    got = [tuple(r) for r in clean.orderBy("i").select("place", "url").collect()]
    assert got == [("a", ""), ("", ""), ("", "")]
    assert [r["rejected"] for r in counts.collect()] == [0, 1]


@pytest.mark.parametrize("kind", ["name", "url", "location", "text"])
def test_cleaning_twice_changes_nothing(spark, data, kind):
    rows = spark.read.parquet(f"{data}/documents.parquet").select(F.substring("text", 1, 80).alias("v"))
    once, _ = standardize(rows, [Rule("v", kind)])
    twice, _ = standardize(once, [Rule("v", kind, "again")])
    assert twice.where(~F.col("v").eqNullSafe(F.col("again"))).isEmpty()


def test_unknown_rule_is_refused(spark):
    with pytest.raises(ValueError):
        standardize(spark.range(1), [Rule("id", "nothing")])
