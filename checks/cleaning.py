"""Queries of the cleaning rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from quorate import functions as fn
from quorate.operators.standardize import Rule, normalise_text_fields, parse_founders, rejected_values, standardize, standardize_stored
from quorate.sources import new_folder

DAY = "yyyy-MM-dd"


@query(
    "c1_clean_name",
    f"SELECT p_partkey, CASE WHEN p_partkey % 5 = 4 THEN '' ELSE {fx.SQL_CAPITALISED} END AS name FROM part",
)
def c1(spark, folder):
    clean, _ = standardize(fx.dirty_names(spark, folder), [Rule("dirty", "name", "name")])
    return clean.select("p_partkey", "name")


_SQL_URL = """CASE WHEN page_id % 7 = 0 THEN CASE WHEN page_id % 3 = 2 THEN 'not a url' ELSE '' END
  WHEN page_id % 3 = 0 THEN regexp_replace(url, '^https?://', '') ELSE url END"""


@query(
    "c2_clean_url",
    f"""SELECT page_id, CASE WHEN t = '' THEN '' WHEN t LIKE 'http%://%' THEN t ELSE 'https://' || t END AS url
        FROM (SELECT page_id, {_SQL_URL} AS t FROM pages)""",
)
def c2(spark, folder):
    clean, _ = standardize(fx.urls(spark, folder), [Rule("url_text", "url", "url")])
    return clean.select("page_id", "url")


@query(
    "c3_parse_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def c3(spark, folder):
    clean, _ = standardize(fx.dates(spark, folder), [Rule("date_text", "date", "day")])
    return clean.select("o_orderkey", F.date_format("day", DAY).alias("day"))


@query(
    "c4_parse_date_as",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def c4(spark, folder):
    rule = Rule("date_text", "date_as", "day", {"fmt": "dd/MM/yyyy"})
    clean, _ = standardize(fx.dates(spark, folder), [rule])
    return clean.select("o_orderkey", F.date_format("day", DAY).alias("day"))


@query(
    "c5_location",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 THEN '' ELSE 'Nation ' || c_nationkey END AS place FROM customer""",
)
def c5(spark, folder):
    clean, _ = standardize(fx.registrations(spark, folder), [Rule("places", "location", "place")])
    return clean.select("c_custkey", "place")


@query(
    "c6_registration",
    f"SELECT c_custkey, CASE WHEN c_custkey % 4 < 2 THEN {fx.SQL_NUMBER} END AS number FROM customer",
)
def c6(spark, folder):
    clean, _ = standardize(fx.registrations(spark, folder), [Rule("number_text", "registration", "number")])
    return clean.select("c_custkey", "number")


@query("c7_amount", f"SELECT o_orderkey, ({fx.SQL_AMOUNT})::DOUBLE AS amount_inr FROM orders")
def c7(spark, folder):
    clean, _ = standardize(fx.amounts(spark, folder), [Rule("amount", "amount", "amount_inr")])
    return clean.select("o_orderkey", F.col("amount_inr").cast("double").alias("amount_inr"))


@query(
    "c8_normalise_fields",
    f"""SELECT p_partkey, CASE WHEN p_partkey % 5 = 4 THEN '' ELSE {fx.SQL_CAPITALISED} END AS dirty,
          upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS p_type, p_size FROM part""",
)
def c8(spark, folder):
    rows = fx.dirty_names(spark, folder, "p_type", "p_size")
    return normalise_text_fields(rows, ["dirty", "p_type", "p_size", "absent"])


@query(
    "c9_truncate_text",
    r"""WITH t AS (SELECT doc_id, trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS f FROM documents)
        SELECT doc_id, CASE WHEN length(f) <= 200 THEN f
          WHEN strpos(left(f, 200), ' ') = 0 THEN left(f, 200) || '...'
          ELSE left(left(f, 200), 200 - strpos(reverse(left(f, 200)), ' ')) || '...' END AS short FROM t""",
)
def c9(spark, folder):
    rule = Rule("text", "text", "short", {"max_length": 200})
    clean, _ = standardize(fx.spread_table(spark, folder, "documents"), [rule])
    return clean.select("doc_id", "short")


@query(
    "c10_web_url",
    """SELECT page_id, url FROM pages WHERE page_id % 7 <> 0 AND page_id % 3 <> 0""",
)
def c10(spark, folder):
    rows = fx.urls(spark, folder).where(fn.is_web_url(F.col("url_text")))
    return rows.select("page_id", F.col("url_text").alias("url"))


@query(
    "c11_founder_names",
    f"""SELECT p_partkey, ordinal, CASE ordinal WHEN 0 THEN {fx.SQL_CAPITALISED} ELSE upper(left(p_type, 1)) || lower(substr(p_type, 2)) END AS full_name,
          'Founder' AS role_type FROM part, (VALUES (0), (2)) v(ordinal) WHERE ordinal = 2 OR p_partkey % 5 <> 4""",
)
def c11(spark, folder):
    names = fx.dirty_names(spark, folder, "p_type")
    lists = names.select("p_partkey", F.array("dirty", F.lit("  "), "p_type").alias("names"))
    return parse_founders(lists, "names", ["p_partkey"])


@query(
    "c12_first_nonblank",
    """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Nation  ' || c_nationkey || ' ' WHEN 1 THEN 'Nation ' || c_nationkey END AS first_text,
         CASE c_custkey % 3 WHEN 0 THEN ' ' WHEN 1 THEN 'Nation ' || c_nationkey ELSE '' END AS first_any FROM customer""",
)
def c12(spark, folder):
    rows = fx.registrations(spark, folder)
    return rows.select(
        "c_custkey", fn.first_nonblank(F.col("places")).alias("first_text"), fn.first_item(F.col("places")).alias("first_any")
    )


@query(
    "c_standardize_reject_counts",
    f"""SELECT 'amount' AS column_name, 'amount' AS rule, count(*) FILTER (o_orderkey % 7 = 6) AS rejected FROM orders
        UNION ALL SELECT 'date_text', 'date', count(*) FILTER (o_orderkey % 6 >= 3) FROM orders""",
)
def c_counts(spark, folder):
    """Reject counts of two rules in one pass over a table."""
    rows = fx.amounts(spark, folder).join(fx.dates(spark, folder), "o_orderkey")
    _, counts = standardize(rows, [Rule("amount", "amount"), Rule("date_text", "date")])
    return counts


@query(
    "c_standardize_stored",
    """SELECT 'amount' AS column_name, 'amount' AS rule, count(*) FILTER (o_orderkey % 7 = 6) AS rejected, count(*) AS rows,
         count(*) FILTER (o_orderkey % 7 <> 6) AS filled FROM orders""",
)
def c_stored(spark, folder):
    """Cleaned rows and counts from one scan."""
    clean, counts = standardize_stored(fx.amounts(spark, folder), [Rule("amount", "amount", "amount_inr")], new_folder(spark, "clean"))
    filled = clean.agg(F.count("amount_inr").alias("filled"))
    none = F.lit(None).cast("bigint")
    # Put together by a union: a join on a column that is one value has no keys.
    both = counts.withColumn("filled", none).unionByName(filled.select(F.lit("amount").alias("column_name"), "filled"), allowMissingColumns=True)
    return both.groupBy("column_name").agg(*[F.max(c).alias(c) for c in ("rule", "rejected", "rows", "filled")])


@query(
    "c_rejected_values",
    """SELECT o_orderkey, 'amount' AS column_name, 'amount' AS rule, list_value('abc', '1.2.3', '5K')[o_orderkey % 3 + 1] AS raw
       FROM orders WHERE o_orderkey % 7 = 6""",
)
def c_rejected(spark, folder):
    return rejected_values(fx.amounts(spark, folder), [Rule("amount", "amount")], ["o_orderkey"])
