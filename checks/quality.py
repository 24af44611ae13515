"""Queries of validation, reports and the gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.consolidation import _companies
from checks.registry import query
from quorate.operators.report import (
    count_results,
    gated,
    profile_report,
    quality_scores,
    report_from_counts,
    should_reject,
)
from quorate.operators.rules import RULE_SETS, FieldRule, rule_set, type_error
from quorate.operators.validate import apply_suggestions, judge, row_counts, row_validity, validate, with_counts
from quorate.plans.loads import load
from quorate.schemas import TableSpec
from quorate.sources import new_folder, stage
from quorate.store import Table

ROW = ("row_id",)


def _company_rows(spark, folder) -> DataFrame:
    """Companies as untyped text, with every kind of fault somewhere."""
    return (
        fx.registrations(spark, folder)
        .join(fx.entities(spark, folder).withColumnRenamed("ordinal", "c_custkey"), "c_custkey")
        .selectExpr(
            "c_custkey AS row_id",
            "CASE WHEN c_custkey % 19 = 0 THEN '' ELSE entity_id END AS big_award_id",
            "CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 23 = 1 THEN repeat('x', 300) ELSE trim(entity_name) END AS registered_name",
            "CAST(NULL AS STRING) AS original_awardee",
            "grant_year AS big_award_year",
            "element_at(array('https://example.org/a', 'example.org', 'http://x.technology/', 'no url', '', 'http://1.2.3.4:80/p?q'), cast(c_custkey % 6 AS INT) + 1) AS website_url",
            "number_text AS cin",
            "element_at(array('2020-01-05', '05/01/2020', '13/25/2020', '01/15/2020', '2020-1-5 10:20:30', ''), cast(c_custkey % 6 AS INT) + 1) AS incorporation_date",
            "repeat('town ', 60) AS location",
            "'Active' AS mca_status",
            "0.5D AS data_quality_score",
            "timestamp'2025-01-01 00:00:00' AS created_at",
            "CAST(NULL AS TIMESTAMP) AS updated_at",
        )
    )


_WEB = "list_value('https://example.org/a', 'example.org', 'http://x.technology/', 'no url', '', 'http://1.2.3.4:80/p?q')[c_custkey % 6 + 1]"
_DAY = "list_value('2020-01-05', '05/01/2020', '13/25/2020', '01/15/2020', '2020-1-5 10:20:30', '')[c_custkey % 6 + 1]"
_CIN = f"CASE c_custkey % 4 WHEN 0 THEN {fx.SQL_NUMBER} WHEN 1 THEN ' ' || lower({fx.SQL_NUMBER}) WHEN 2 THEN left({fx.SQL_NUMBER}, 20) ELSE 'Z' || substr({fx.SQL_NUMBER}, 2) END"
_NAME = f"""CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 23 = 1 THEN repeat('x', 300)
  WHEN c_custkey % 3 = 0 THEN upper(c_name) || '   ' || c_mktsegment WHEN c_custkey % 3 = 1 THEN lower(c_name) || chr(9) || lower(c_mktsegment)
  ELSE c_name || chr(160) || c_mktsegment || chr(10) END"""
_YEAR = "CASE WHEN c_custkey % 17 = 0 THEN 'n/a' ELSE (2000 + c_custkey % 25)::VARCHAR END"
_ID = "CASE WHEN c_custkey % 19 = 0 THEN '' ELSE 'C/' || c_custkey END"
_EMPTY = "true AS is_valid, 'info' AS severity, 'Optional field is empty' AS message, NULL::VARCHAR AS suggested_value"

# The long results of the company rules in the older style, field by field.
SQL_COMPANY_RESULTS = f"""
res AS (
  SELECT c_custkey AS row_id, 'big_award_id' AS field, {_ID} AS value, c_custkey % 19 <> 0 AS is_valid,
    CASE WHEN c_custkey % 19 = 0 THEN 'error' ELSE 'info' END AS severity,
    CASE WHEN c_custkey % 19 = 0 THEN 'Required field big_award_id is missing' ELSE 'Valid string' END AS message, NULL::VARCHAR AS suggested_value FROM customer
  UNION ALL SELECT c_custkey, 'registered_name', {_NAME}, c_custkey % 23 > 1, CASE WHEN c_custkey % 23 < 2 THEN 'error' ELSE 'info' END,
    CASE c_custkey % 23 WHEN 0 THEN 'Required field registered_name is missing' WHEN 1 THEN 'String too long (max: 255, got: 300)' ELSE 'Valid string' END,
    CASE WHEN c_custkey % 23 = 1 THEN repeat('x', 255) END FROM customer
  UNION ALL SELECT c_custkey, 'original_awardee', NULL, {_EMPTY} FROM customer
  UNION ALL SELECT c_custkey, 'big_award_year', {_YEAR}, c_custkey % 17 <> 0, CASE WHEN c_custkey % 17 = 0 THEN 'error' ELSE 'info' END,
    CASE WHEN c_custkey % 17 = 0 THEN 'String doesn''t match required pattern' ELSE 'Valid string' END, NULL FROM customer
  UNION ALL SELECT c_custkey, 'website_url', {_WEB}, c_custkey % 6 IN (0, 4, 5), list_value('info', 'warning', 'error', 'error', 'info', 'info')[c_custkey % 6 + 1],
    list_value('Valid URL', 'URL missing protocol', 'Invalid URL format', 'Invalid URL format', 'Optional field is empty', 'Valid URL')[c_custkey % 6 + 1],
    CASE WHEN c_custkey % 6 = 1 THEN 'https://example.org' END FROM customer
  UNION ALL SELECT c_custkey, 'cin', CASE WHEN c_custkey % 4 = 1 THEN {fx.SQL_NUMBER} ELSE {_CIN} END, c_custkey % 4 <> 2, CASE WHEN c_custkey % 4 = 2 THEN 'error' ELSE 'info' END,
    CASE WHEN c_custkey % 4 = 2 THEN 'CIN must be 21 characters long, got 20' ELSE 'Valid CIN' END, CASE WHEN c_custkey % 4 = 1 THEN {fx.SQL_NUMBER} END FROM customer
  UNION ALL SELECT c_custkey, 'incorporation_date', {_DAY}, c_custkey % 6 <> 2, CASE WHEN c_custkey % 6 = 2 THEN 'error' ELSE 'info' END,
    CASE c_custkey % 6 WHEN 2 THEN 'Cannot parse date string' WHEN 5 THEN 'Optional field is empty' ELSE 'Valid date string' END,
    list_value('2020-01-05', '2020-01-05', NULL, '2020-01-15', '2020-01-05', NULL)[c_custkey % 6 + 1] FROM customer
  UNION ALL SELECT c_custkey, 'location', repeat('town ', 60), false, 'error', 'String too long (max: 255, got: 300)', left(repeat('town ', 60), 255) FROM customer
  UNION ALL SELECT c_custkey, 'mca_status', 'Active', true, 'info', 'Valid string', NULL FROM customer
  UNION ALL SELECT c_custkey, 'data_quality_score', '0.5', false, 'error', 'Expected string, got float', NULL FROM customer
  UNION ALL SELECT c_custkey, 'created_at', '2025-01-01 00:00:00', true, 'info', 'Valid date', NULL FROM customer
  UNION ALL SELECT c_custkey, 'updated_at', NULL, {_EMPTY} FROM customer)
"""


def _results(spark, folder):
    return validate(_company_rows(spark, folder), "company", ROW, "observed").drop("entity_type")


@query("v1_validate_entity", f"WITH {SQL_COMPANY_RESULTS} SELECT * FROM res")
def v1(spark, folder):
    return _results(spark, folder)


def _one_field(field, *, only=None):
    def build(spark, folder):
        rows = _results(spark, folder).where(F.col("field") == field)
        return rows.where(only) if only else rows

    return build


query(
    "v2_required_rule",
    f"WITH {SQL_COMPANY_RESULTS} SELECT * FROM res WHERE field IN ('big_award_id', 'original_awardee')",
)(lambda spark, folder: _results(spark, folder).where(F.col("field").isin("big_award_id", "original_awardee")))
query(
    "v3_string_rule",
    f"WITH {SQL_COMPANY_RESULTS} SELECT * FROM res WHERE field IN ('registered_name', 'big_award_year', 'location', 'data_quality_score')",
)(
    lambda spark, folder: _results(spark, folder).where(
        F.col("field").isin("registered_name", "big_award_year", "location", "data_quality_score")
    )
)
query("v5_registration_rule", f"WITH {SQL_COMPANY_RESULTS} SELECT * FROM res WHERE field = 'cin'")(_one_field("cin"))
query("v6_date_rule", f"WITH {SQL_COMPANY_RESULTS} SELECT * FROM res WHERE field = 'incorporation_date'")(
    _one_field("incorporation_date")
)

_SQL_URL_TEXT = """CASE WHEN page_id % 7 = 0 THEN list_value('', '  ', 'not a url')[page_id % 3 + 1]
  WHEN page_id % 3 = 0 THEN regexp_replace(url, '^https?://', '') ELSE url END"""


@query(
    "v4_url_rule",
    f"""SELECT page_id, t AS value, page_id % 7 = 0 AND page_id % 3 = 0 OR t LIKE 'http%' AS is_valid,
          CASE WHEN t = '' OR t LIKE 'http%' THEN 'info' WHEN page_id % 7 = 0 THEN 'error' ELSE 'warning' END AS severity,
          CASE WHEN page_id % 7 <> 0 AND page_id % 3 = 0 THEN 'https://' || t END AS suggested_value
        FROM (SELECT page_id, {_SQL_URL_TEXT} AS t FROM pages)""",
)
def v4(spark, folder):
    """The rule on real page addresses."""
    rows = fx.urls(spark, folder).select(
        "page_id",
        F.when(F.col("page_id") % 7 == 0, F.col("url_text")).otherwise(F.trim("url_text")).alias("website_url"),
    )
    verdict = judge(rows, next(r for r in rule_set("company") if r.field == "website_url"))
    return rows.select(
        "page_id",
        verdict.value.alias("value"),
        verdict.valid.alias("is_valid"),
        verdict.severity.alias("severity"),
        verdict.suggested.alias("suggested_value"),
    )




@query(
    "v7_rule_sets",
    """SELECT s AS entity_type, n * count(*) AS checks, count(*) * (n - r) AS optional_checks FROM orders,
         (VALUES ('company', 12, 2), ('person', 8, 2), ('people', 8, 2), ('patent', 13, 2), ('patents', 13, 2), ('publication', 10, 1),
           ('product', 7, 1), ('products_services', 7, 1), ('funding', 12, 1), ('news_coverage', 7, 1), ('extraction_log', 8, 1)) v(s, n, r)
       GROUP BY s, n, r""",
)
def v7(spark, folder):
    """Every rule set over a table that lacks all its columns: what is required
    fails, the rest is optional and empty."""
    rows = fx.table(spark, folder, "orders").select("o_orderkey")
    counted = reduce(DataFrame.unionByName, [row_counts(rows, name, ["o_orderkey"]) for name in RULE_SETS])
    return counted.groupBy("entity_type").agg(
        F.sum("fields").alias("checks"), F.sum("valid_fields").alias("optional_checks")
    )


# Per set, a letter for each field in order: R required text, T text with a
# limit, F free text, Y year, N number, B boolean, D date, U address, C
# registration number.
_SQL_SETS = """(VALUES ('company', 'RRTYUCDFTNDD'), ('person', 'NRRTTTUD'), ('people', 'NRRTTTUD'), ('patent', 'NRRTFFYBBFTUD'),
  ('patents', 'NRRTFFYBBFTUD'), ('publication', 'NRNFTYFTUD'), ('product', 'NRTTTUD'), ('products_services', 'NRTTTUD'),
  ('funding', 'NRTNFTTDTUDD'), ('news_coverage', 'NRFDTUD'), ('extraction_log', 'NRTTNFUD')) v(s, codes)"""
_GOOD = {"string": "x", "year": "2020", "numeric": "-12.5", "boolean": "True", "date": "2024-01-05", "url": "https://a.example.org", "registration": "u12345mh2020ptc000001"}
_BAD = {"year": "20x0", "numeric": "soon", "boolean": "maybe", "date": "2024-13-41", "url": "https://x y", "registration": "U12345"}


@query(
    "v7_rule_values",
    f"""SELECT o_orderkey, s AS entity_type, length(codes)::INTEGER AS fields,
          len([j FOR j IN range(0, length(codes)) IF CASE (o_orderkey + j) % 5 WHEN 0 THEN codes[j + 1] = 'F' WHEN 1 THEN codes[j + 1] <> 'R' ELSE true END])::INTEGER AS valid_fields
        FROM orders, {_SQL_SETS}""",
)
def v7_values(spark, folder):
    """Good, bad and empty values of every field of every set, by row."""
    orders = fx.table(spark, folder, "orders").select("o_orderkey")

    def filled(name):
        columns = []
        for j, rule in enumerate(RULE_SETS[name]):
            bad = "x" * (rule.max_length + 1) if rule.max_length else _BAD.get(rule.kind, "x" * 1000)
            state = F.pmod(F.col("o_orderkey") + j, F.lit(5))
            columns.append(F.when(state == 0, bad).when(state == 1, "").otherwise(_GOOD[rule.kind]).alias(rule.field))
        return orders.select("o_orderkey", *columns)

    counted = [row_counts(filled(name), name, ["o_orderkey"]) for name in RULE_SETS]
    return reduce(DataFrame.unionByName, counted).select("o_orderkey", "entity_type", "fields", "valid_fields")


_NAMES = ("company", "people", "person", "patents", "robot", "Company", "news_coverage")


@query(
    "v8_unknown_type",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (4, 5) THEN 'Unknown entity type: ' || list_value{_NAMES}[o_orderkey % 7 + 1] END AS error FROM orders""",
)
def v8(spark, folder):
    """Names and aliases of rule sets are known, others are named."""
    rows = fx.table(spark, folder, "orders").select(
        "o_orderkey", F.get(F.array(*map(F.lit, _NAMES)), (F.col("o_orderkey") % len(_NAMES)).cast("int")).alias("kind")
    )
    return rows.select("o_orderkey", type_error(F.col("kind")).alias("error"))


@query(
    "v9_apply_suggestions",
    f"""SELECT c_custkey AS row_id, CASE WHEN c_custkey % 23 = 1 THEN repeat('x', 255) ELSE {_NAME} END AS registered_name,
          CASE WHEN c_custkey % 6 = 1 THEN 'https://example.org' ELSE {_WEB} END AS website_url,
          CASE WHEN c_custkey % 4 = 1 THEN {fx.SQL_NUMBER} ELSE {_CIN} END AS cin,
          coalesce(list_value('2020-01-05', '2020-01-05', NULL, '2020-01-15', '2020-01-05', NULL)[c_custkey % 6 + 1], {_DAY}) AS incorporation_date,
          left(repeat('town ', 60), 255) AS location FROM customer""",
)
def v9(spark, folder):
    cleaned = apply_suggestions(_company_rows(spark, folder), "company", "observed")
    return cleaned.select("row_id", "registered_name", "website_url", "cin", "incorporation_date", "location")


@query(
    "v10_row_validity",
    """SELECT o_orderkey AS row_id, o_orderkey % 3 <> 1 AND o_orderkey % 5 IN (0, 1, 4) AS is_valid FROM orders""",
)
def v10(spark, folder):
    """Warnings alone do not make a row invalid."""
    return row_validity(_people_rows(spark, folder), "people", ROW).drop("entity_type")


def _people_rows(spark, folder):
    """People of a profile: a third without a name, addresses good or bad."""
    return fx.table(spark, folder, "orders").selectExpr(
        "o_orderkey AS row_id",
        "concat('C/', o_custkey) AS big_award_id",
        "CASE WHEN o_orderkey % 3 = 1 THEN '' ELSE concat('Clerk ', o_orderkey) END AS full_name",
        "o_orderpriority AS role_type",
        "element_at(array('', 'example.org', 'no url', 'http://bad host', 'https://example.org'), cast(o_orderkey % 5 AS INT) + 1) AS source_url",
    )


_SQL_PEOPLE = """
pe AS (SELECT o_custkey AS k, 8 AS fields,
    (o_orderkey % 3 = 1)::INT + (o_orderkey % 5 IN (2, 3))::INT AS errors, (o_orderkey % 5 = 1)::INT AS warnings FROM orders)
"""
_SQL_FIN = """
fu AS (SELECT o_custkey AS k, 12 AS fields,
    (length(CASE WHEN o_orderkey % 4 = 0 THEN 'a very long round name' ELSE o_orderpriority END) > 20)::INT + (o_orderkey % 6 = 5)::INT AS errors, 0 AS warnings FROM orders)
"""


def _funding_rows(spark, folder):
    return fx.table(spark, folder, "orders").selectExpr(
        "o_orderkey AS row_id",
        "concat('C/', o_custkey) AS big_award_id",
        "CASE WHEN o_orderkey % 4 = 0 THEN 'a very long round name' ELSE o_orderpriority END AS stage",
        "o_totalprice AS amount_inr",
        "CASE WHEN o_orderkey % 6 = 5 THEN 'soon' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS announced_date",
    )


@query(
    "v11_quality_score",
    f"""WITH {_SQL_PEOPLE} SELECT 'C/' || k AS big_award_id, 'people' AS entity_type, sum(fields - errors - warnings)::BIGINT AS valid_fields,
          sum(fields)::BIGINT AS fields, sum(fields - errors - warnings)::DOUBLE / sum(fields)::DOUBLE AS score FROM pe GROUP BY k""",
)
def v11(spark, folder):
    """Scores out of the long results."""
    results = validate(_people_rows(spark, folder), "people", ["big_award_id"])
    return quality_scores(count_results(results))


def _payloads(spark, folder):
    companies = _companies(spark, folder)
    # Some companies lose their name or get an address that cannot be right.
    key = F.substring_index("big_award_id", "/", -1).cast("bigint")
    companies = companies.withColumn("_key", key).withColumns(
        {
            "registered_name": F.when(F.col("_key") % 29 == 0, F.lit(None)).otherwise(F.col("registered_name")),
            "website_url": F.when(F.col("_key") % 31 == 0, F.lit("no url")).otherwise(F.col("website_url")),
        }
    )
    return {
        "company": companies.drop("_key"),
        "people": _people_rows(spark, folder).drop("row_id"),
        "funding_rounds": _funding_rows(spark, folder).drop("row_id"),
    }


# Report of those payloads on the SQL side.
SQL_REPORT = f"""
WITH {_SQL_PEOPLE}, {_SQL_FIN},
co AS (SELECT c_custkey AS k, 12 AS fields, (c_custkey % 29 = 0)::INT + (c_custkey % 31 = 0)::INT AS errors FROM customer WHERE c_custkey % 17 <> 0),
ps AS (SELECT k, sum(fields - errors - warnings)::DOUBLE / sum(fields)::DOUBLE AS s, sum(errors) AS e, sum(warnings) AS w FROM pe GROUP BY k),
fs AS (SELECT k, sum(fields - errors)::DOUBLE / sum(fields)::DOUBLE AS s, sum(errors) AS e FROM fu GROUP BY k),
ids AS (SELECT k FROM co UNION SELECT k FROM ps),
rep AS (
  SELECT ids.k, (co.fields - co.errors)::DOUBLE / co.fields::DOUBLE AS company_score, ps.s AS people_score, fs.s AS funding_score,
    coalesce(co.errors, 0) + coalesce(ps.e, 0) + coalesce(fs.e, 0) AS total_errors, coalesce(ps.w, 0) AS total_warnings,
    coalesce((co.fields - co.errors)::DOUBLE / co.fields >= 0.6, true) AND coalesce(ps.s >= 0.8, true) AND coalesce(fs.s >= 0.7, true) AS is_valid
  FROM ids LEFT JOIN co ON co.k = ids.k LEFT JOIN ps ON ps.k = ids.k LEFT JOIN fs ON fs.k = ids.k)
"""


def _report(spark, folder):
    return profile_report(_payloads(spark, folder))


@query(
    "v12_threshold_gate",
    f"""{SQL_REPORT} SELECT 'C/' || k AS big_award_id, company_score, people_score, funding_score, is_valid FROM rep""",
)
def v12(spark, folder):
    score = lambda t: F.try_element_at("quality_scores", F.lit(t))
    return _report(spark, folder).select(
        "big_award_id",
        score("company").alias("company_score"),
        score("people").alias("people_score"),
        score("funding_rounds").alias("funding_score"),
        "is_valid",
    )


@query(
    "v13_error_totals",
    f"""{SQL_REPORT} SELECT 'C/' || k AS big_award_id, total_errors::BIGINT AS total_errors, total_warnings::BIGINT AS total_warnings FROM rep""",
)
def v13(spark, folder):
    return _report(spark, folder).select("big_award_id", "total_errors", "total_warnings")


@query(
    "v14_overall_status",
    f"""{SQL_REPORT} SELECT 'C/' || k AS big_award_id, CASE WHEN NOT is_valid OR total_errors > 0 THEN 'FAILED'
          WHEN total_warnings > 0 THEN 'WARNING' ELSE 'PASSED' END AS overall_status FROM rep""",
)
def v14(spark, folder):
    return _report(spark, folder).select("big_award_id", "overall_status")


@query(
    "v15_recommendations",
    f"""{SQL_REPORT}, low AS (
          SELECT *, concat_ws(', ', CASE WHEN company_score < 0.5 THEN 'company' END, CASE WHEN people_score < 0.5 THEN 'people' END,
            CASE WHEN funding_score < 0.5 THEN 'funding_rounds' END) AS lows FROM rep)
        SELECT 'C/' || k AS big_award_id, concat_ws(' | ',
          CASE WHEN company_score < 0.6 THEN 'Company quality score (' || round_even(company_score::DECIMAL(20,10), 2)::DECIMAL(10,2) || ') below threshold (0.60)' END,
          CASE WHEN people_score < 0.8 THEN 'People quality score (' || round_even(people_score::DECIMAL(20,10), 2)::DECIMAL(10,2) || ') below threshold (0.80)' END,
          CASE WHEN funding_score < 0.7 THEN 'Funding_Rounds quality score (' || round_even(funding_score::DECIMAL(20,10), 2)::DECIMAL(10,2) || ') below threshold (0.70)' END,
          CASE WHEN total_errors > 10 THEN 'High error count detected. Consider reviewing data extraction logic.' END,
          CASE WHEN lows <> '' THEN 'Low quality data detected in: ' || lows || '. Consider improving extraction methods.' END,
          CASE WHEN company_score IS NOT NULL AND k % 29 = 0 THEN 'Critical field ''registered_name'' has issues: Required field registered_name is missing' END,
          CASE WHEN company_score IS NOT NULL AND k % 31 = 0 THEN 'Critical field ''website_url'' has issues: Invalid URL format' END) AS recommendations
        FROM low""",
)
def v15(spark, folder):
    return _report(spark, folder).select(
        "big_award_id", F.array_join("recommendations", " | ").alias("recommendations")
    )


@query(
    "v16_should_reject",
    f"""{SQL_REPORT} SELECT 'C/' || k AS big_award_id, NOT is_valid OR total_errors > 0 AS rejected FROM rep""",
)
def v16(spark, folder):
    return _report(spark, folder).select("big_award_id", should_reject().alias("rejected"))


@query(
    "v17_profile_gate",
    f"""{SQL_REPORT} SELECT 'people' AS payload, 'C/' || k AS big_award_id, is_valid AS passed, count(*) AS n FROM pe JOIN rep USING (k) GROUP BY ALL
        UNION ALL SELECT 'funding_rounds', 'C/' || k, is_valid, count(*) FROM fu JOIN rep USING (k) GROUP BY ALL
        UNION ALL SELECT 'company', 'C/' || k, is_valid, count(*) FROM co JOIN rep USING (k) GROUP BY ALL""",
)
def v17(spark, folder):
    payloads = _payloads(spark, folder)
    # As in a run, the report is staged: every table's gate reads it.
    report = stage(profile_report(payloads), new_folder(spark, "gate"), "report")
    parts = [
        gated(payloads[name], report).select(F.lit(name).alias("payload"), "big_award_id", "passed") for name in payloads
    ]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("payload", "big_award_id", "passed").agg(F.count("*").alias("n"))


@query(
    "v_report_from_results",
    f"""{SQL_REPORT} SELECT 'C/' || k AS big_award_id, people_score, total_warnings::BIGINT AS total_warnings, people_score >= 0.8 AS is_valid FROM rep WHERE people_score IS NOT NULL""",
)
def v_report(spark, folder):
    """The report made from long results, for one payload type."""
    results = validate(_people_rows(spark, folder), "people", ["big_award_id"])
    report = report_from_counts(count_results(results), ["people"])
    return report.select(
        "big_award_id",
        F.try_element_at("quality_scores", F.lit("people")).alias("people_score"),
        "total_warnings",
        "is_valid",
    )


_ORDER_RULES = [
    FieldRule("o_orderkey", "numeric", required=True),
    FieldRule("o_orderpriority", "string", required=True, max_length=8),
    FieldRule("o_clerk_mail", "string", required=True),
]


@query(
    "v_own_rules_and_table",
    """SELECT o_orderkey, o_orderpriority, 3 AS fields, 1 + (length(o_orderpriority) <= 8)::INT AS valid_fields, o_orderkey % 2 = 0 AS updated FROM orders""",
)
def v_own(spark, folder):
    """Rules and a table that are not built in: judged, loaded, and the even
    rows loaded once more."""
    spec = TableSpec(
        "judged_orders", "o_orderkey BIGINT, o_orderpriority STRING, fields INT, valid_fields INT, updated BOOLEAN",
        primary_key="o_orderkey", natural_key="o_orderkey", mode="upsert", parent_key=None, not_null=("o_orderkey",),
    )
    orders = fx.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    judged = with_counts(orders, "order", rules=_ORDER_RULES).withColumn("updated", F.lit(False))
    table = Table(spark, new_folder(spark, "own"), spec, buckets=4).create()
    now = F.lit("2025-03-01 12:30:00").cast("timestamp")
    load(table, judged, now, "r1")
    load(table, judged.where("o_orderkey % 2 = 0").withColumn("updated", F.lit(True)), now, "r2")
    return table.read()
