"""Votes, dedupe, scores, validation and the report on small cases."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from quorate.operators.consolidate import VOTED_FIELDS, completeness, consolidate, dedupe_first, observe
from quorate.operators.report import gate, profile_report, should_reject
from quorate.operators.rules import RULE_SETS, rule_set, threshold_of
from quorate.operators.validate import apply_suggestions, row_counts, row_validity, validate


def votes(spark, *rows):
    seen = spark.createDataFrame(list(rows), "e STRING, source_rank BIGINT, field STRING, value STRING")
    return {r["e"]: r for r in consolidate(seen, ["e"], ["f", "g"], votes=True).collect()}


def test_majority_vote(spark):
    got = votes(
        spark,
        ("a", 1, "f", "B"), ("a", 2, "f", "A"), ("a", 3, "f", "A"),
        ("b", 1, "f", "B"), ("b", 2, "f", "A"),
        ("c", 1, "f", ""), ("c", 2, "f", None), ("c", 3, "g", "x"),
        ("d", 1, "f", None),
        ("e", 1, "f", " "), ("e", 2, "h", "other field"),
    )
    assert got["a"]["f"] == "A" and got["a"]["f_votes"] == 2
    assert got["b"]["f"] == "B"
    assert got["c"]["f"] is None and got["c"]["g"] == "x"
    assert "d" not in got and got["e"]["f"] == " "


def test_vote_does_not_depend_on_partitioning(spark, data):
    seen = observe(fx.observations_wide(spark, data), ["entity_id"], "source_rank", VOTED_FIELDS)

    def result(rows):
        return sorted(tuple(r) for r in consolidate(rows, ["entity_id"], VOTED_FIELDS).select("entity_id", *[F.coalesce(f, F.lit("-")) for f in VOTED_FIELDS]).collect())

    assert result(seen) == result(seen.repartition(13)) == result(seen.orderBy(F.desc("source_rank")).coalesce(1))


def test_vote_with_one_hot_entity(spark):
    """One entity holds nearly all rows, each with another value but for two."""
    hot = spark.range(50_000).selectExpr("'hot' e", "id source_rank", "'f' field", "concat('v', id) value")
    more = spark.createDataFrame([("hot", 60_000, "f", "v49999"), ("cold", 1, "f", "c")], hot.schema)
    got = {r["e"]: r["f"] for r in consolidate(hot.unionByName(more), ["e"], ["f"]).collect()}
    assert got == {"hot": "v49999", "cold": "c"}


def test_dedupe_first(spark):
    rows = spark.createDataFrame(
        [("a", "Asha", 2, 0, "x"), ("a", "Asha", 1, 5, "y"), ("a", "", 1, 0, "z"), ("a", None, 1, 1, "z"), ("b", "Asha", 9, 9, "w")],
        "e STRING, full_name STRING, source_rank INT, ordinal INT, designation STRING",
    )
    got = dedupe_first(rows, ["e"], "full_name", ["source_rank", "ordinal"]).collect()
    assert {(r["e"], r["designation"]) for r in got} == {("a", "y"), ("b", "w")}


def test_completeness(spark):
    rows = spark.createDataFrame([("x", "", None, " ")], "a STRING, b STRING, c STRING, d STRING")
    assert rows.select(completeness(["a", "b", "c"]), completeness(["a", "d"])).first()[:] == (Decimal("0.33"), Decimal("1.00"))


COMPANY = (
    "big_award_id STRING, registered_name STRING, original_awardee STRING, big_award_year SMALLINT, website_url STRING, cin STRING, "
    "incorporation_date DATE, location STRING, mca_status STRING, data_quality_score DECIMAL(3,2)"
)


def company(spark, **changes):
    row = dict(
        big_award_id="C/1", registered_name="Acme", original_awardee=None, big_award_year=2020, website_url="", cin=None,
        incorporation_date=None, location="", mca_status=None, data_quality_score=Decimal("0.5"),
    )
    row.update(changes)
    return spark.createDataFrame([tuple(row.values())], COMPANY)


def counts(df, kind, style):
    row = row_counts(df, kind, [], style).first()
    return row["fields"], row["valid_fields"], row["errors"], row["warnings"]


def test_company_scores_of_both_styles(spark):
    # Year and score are no text, the older style fails them.
    plain = company(spark)
    assert counts(plain, "company", "observed") == (12, 10, 2, 0)
    assert counts(plain, "company", "typed") == (12, 12, 0, 0)
    # Voted values that came as pairs fail as text as well: 4 of 12.
    odd = plain.withColumns({"original_awardee": F.lit(1), "mca_status": F.lit(2)})
    assert counts(odd, "company", "observed") == (12, 8, 4, 0)
    report = profile_report({"company": odd}, style="observed").first()
    assert report["quality_scores"]["company"] == pytest.approx(0.6667, abs=1e-4) and report["is_valid"]


def test_patent_score_of_the_older_style(spark):
    rows = spark.createDataFrame(
        [("C/1", "P1", False, False, 2020)],
        "big_award_id STRING, patent_number STRING, indian_jurisdiction BOOLEAN, foreign_jurisdiction BOOLEAN, filing_year INT",
    )
    assert counts(rows, "patents", "observed") == (13, 10, 3, 0)
    report = profile_report({"patents": rows}, style="observed").first()
    assert report["quality_scores"]["patents"] == pytest.approx(0.769, abs=1e-3) and report["is_valid"]


def test_url_and_number_rules(spark):
    texts = ["https://example.org", "example.org", "https://x.technology/", "http://1.2.3.4:80/p?q", ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, website_url STRING")
    got = validate(rows, "company", ["i"]).where("field = 'website_url'").orderBy("i").collect()
    assert [(r["is_valid"], r["severity"]) for r in got] == [
        (True, "info"), (False, "warning"), (False, "error"), (True, "info"), (True, "info"),
    ]
    assert got[1]["suggested_value"] == "https://example.org"
    good = "u12345mh2020ptc000001"
    rows = spark.createDataFrame([(0, good), (1, "Z" + good[1:].upper()), (2, good[1:])], "i INT, cin STRING")
    got = validate(rows, "company", ["i"]).where("field = 'cin'").orderBy("i").collect()
    assert [r["is_valid"] for r in got] == [True, True, False]
    assert got[0]["suggested_value"] == good.upper() and got[1]["suggested_value"] is None


def test_typed_rules(spark):
    rows = spark.createDataFrame([("12", "x", "TRUE")], "patent_id STRING, filing_year STRING, indian_jurisdiction STRING")
    got = {r["field"]: r["is_valid"] for r in validate(rows, "patent", []).collect()}
    assert got["patent_id"] and not got["filing_year"] and got["indian_jurisdiction"] and not got["patent_number"]


def test_white_space_counts_as_present(spark):
    assert row_validity(company(spark, registered_name=" "), "company", []).first()["is_valid"]
    assert not row_validity(company(spark, registered_name=""), "company", []).first()["is_valid"]


def test_rule_sets():
    sizes = dict(company=12, person=8, people=8, patent=13, patents=13, publication=10, product=7, products_services=7, funding=12, news_coverage=7, extraction_log=8)
    assert {k: len(v) for k, v in RULE_SETS.items()} == sizes
    assert len(rule_set("publications")) == 10 and len(rule_set("funding_rounds")) == 12
    with pytest.raises(ValueError):
        rule_set("nothing")
    assert [threshold_of(t) for t in ("company", "people", "products_services", "news_coverage", "other")] == [0.6, 0.8, 0.8, 0.9, 0.7]


def test_suggestions(spark):
    row = apply_suggestions(company(spark, website_url="example.org", registered_name="x" * 300), "company").first()
    assert row["website_url"] == "https://example.org" and len(row["registered_name"]) == 255
    with pytest.raises(Exception, match="company.registered_name"):
        apply_suggestions(company(spark, registered_name=""), "company", fail_on="error").collect()


def test_report_and_gate(spark):
    companies = company(spark).unionByName(company(spark, big_award_id="C/2", website_url="no url", registered_name=None))
    people = spark.createDataFrame(
        [("C/1", "A", None), ("C/2", None, "no url"), ("C/2", None, "no url"), ("C/3", "Z", "example.org")],
        "big_award_id STRING, full_name STRING, source_url STRING",
    )
    payloads = {"company": companies, "people": people}
    report = profile_report(payloads)
    got = {r["big_award_id"]: r for r in report.collect()}
    assert got["C/1"]["overall_status"] == "PASSED" and got["C/1"]["recommendations"] == []
    assert got["C/3"]["overall_status"] == "WARNING" and set(got["C/3"]["quality_scores"]) == {"people"}
    second = got["C/2"]
    assert second["overall_status"] == "FAILED" and second["total_errors"] == 6 and not second["is_valid"]
    assert second["recommendations"] == [
        "People quality score (0.75) below threshold (0.80)",
        "Critical field 'registered_name' has issues: Required field registered_name is missing",
        "Critical field 'website_url' has issues: Invalid URL format",
    ]
    rejected = {r[0]: r[1] for r in report.select("big_award_id", should_reject()).collect()}
    assert rejected == {"C/1": False, "C/2": True, "C/3": False}
    passed, held = gate(payloads, report)
    for name, df in payloads.items():
        assert passed[name].count() + held[name].count() == df.count()
    assert {r["big_award_id"] for r in held["people"].collect()} == {"C/2"}
    everything, nothing = gate(payloads, report, enabled=False)
    assert everything["people"].count() == 4 and nothing["people"].count() == 0


def test_timestamps_count_as_dates(spark):
    rows = company(spark).withColumn("created_at", F.lit(datetime(2025, 1, 1)))
    assert counts(rows, "company", "typed") == (12, 12, 0, 0)


def test_a_stop_is_not_pruned(spark):
    rows = company(spark, registered_name="").withColumn("place", F.lit(1))
    with pytest.raises(Exception, match="registered_name"):
        apply_suggestions(rows, "company", fail_on="error").select("place").collect()
    with pytest.raises(Exception, match="registered_name"):
        apply_suggestions(rows, "company", fail_on="error").count()
    assert apply_suggestions(rows, "company").select("place").count() == 1
