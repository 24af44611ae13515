"""What the plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from quorate.operators import feeds
from quorate.operators import payloads as P

PYTHON_ALLOWED = {
    "x6_html_sections", "x9_patent_titles", "x15_isolated_sources", "g6_people_rows", "g7_product_rows", "g8_patent_rows",
    "g9_publication_rows", "s4_landing_address",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_no_python_rows_and_no_cartesian_product(spark, data, name):
    plan = plan_of(contract.queries()[name](spark, data))
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_ALLOWED:
        assert "MapInPandas" not in plan


def test_gate_is_one_join_per_payload(spark, data):
    plan = plan_of(contract.queries()["v17_profile_gate"](spark, data))
    assert plan.count("LeftOuter") == 3 and "LeftSemi" not in plan and "LeftAnti" not in plan


def test_vote_shuffles_twice(spark, data):
    plan = plan_of(contract.queries()["g1_majority_vote"](spark, data))
    assert plan.count("Exchange hashpartitioning") == 2


def test_top_rows_are_cut_before_the_shuffle(spark, data):
    plan = plan_of(contract.queries()["x13_news_per_entity"](spark, data))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_amounts_of_rounds_are_read_once(spark):
    rows = spark.sql("SELECT 'a' AS entity_id, array(named_struct('stage', 's', 'amount_inr', parse_json('1'), 'amount', '1', 'source_name', 'f', 'source_type', 't', 'funding_type', 'g', 'announced_date', '2025-01-01', 'source_url', 'u', '_item', parse_json(CAST(NULL AS STRING)))) AS funding_rounds FROM range(1)")
    plan = P.marked_rounds(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get(") <= 3
    kept = P.marked_rounds(rows).collect()
    assert [(r["stage"], float(r["amount_inr"]), r["reason"]) for r in kept] == [("s", 1.0, None)]


def test_scan_is_pruned(spark, data):
    plan = plan_of(contract.queries()["l8_cascade_delete"](spark, data))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_every_body_is_parsed_once(spark):
    """One scan for all feeds, one parse in it for each of them."""
    rows = spark.createDataFrame([("a", "news", "{}")], "entity_id STRING, source STRING, body STRING")
    routes = {name: F.col("source") == name for name in ("patents_json", "publications_json", "news_json", "news_rss")}
    plan = feeds.marked_rows(rows, routes, ("entity_id",))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 3 and plan.count("from_xml(") == 1 and plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_consumers_read_their_feed_only(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", "news", '{"news": [{"title": "n"}, {"title": "m"}]}'), ("b", "news", "{"), ("c", "rss", "<rss><channel/></rss>"), ("d", "no", "")],
        "entity_id STRING, source STRING, body STRING",
    )
    marked = feeds.mark_feeds(rows, {"news_json": F.col("source") == "news", "news_rss": F.col("source") == "rss"}, ("entity_id",), str(tmp_path))
    news = marked.items("news_json")
    plan = plan_of(news)
    assert "PartitionFilters: [isnotnull(feed" in plan and "news_rss:struct" not in plan and "body:string" not in plan
    assert [(r["ordinal"], r["headline"]) for r in news.orderBy("ordinal").collect()] == [(0, "n"), (1, "m")]
    assert {r[0] for f in ("news_json", "news_rss") for r in marked.answered(f).collect()} == {"a", "c"}
    assert [tuple(r) for r in marked.unreadable().collect()] == [("news_json", "b", "{")]


def test_every_item_is_read_once(spark):
    """One read of an item for each JSON feed, not one for each column."""
    rows = spark.createDataFrame([("a", "news", "{}")], "entity_id STRING, source STRING, body STRING")
    routes = {name: F.col("source") == name for name in ("patents_json", "publications_json", "news_json", "news_rss")}
    plan = feeds.marked_rows(rows, routes, ("entity_id",))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get(") == 3
