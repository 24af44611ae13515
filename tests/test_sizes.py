"""Larger tables are more tasks and not larger ones; texts are parsed once."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

import quorate.store
from checks import QUERIES, fixtures, loading
from quorate.operators.load import apply_defaults
from quorate.schemas import NEWS
from quorate.store import Table


def test_texts_are_parsed_once(spark, data):
    for name in ("x2_profile_parse", "x2_outermost_object"):
        plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1


def test_costly_tables_are_dealt_by_rows(spark, data, monkeypatch):
    monkeypatch.setattr(fixtures, "TASK_ROWS", 50)
    assert fixtures.spread_table(spark, data, "orders").rdd.getNumPartitions() > spark.sparkContext.defaultParallelism


def test_tiles_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(loading, "TASK_ROWS", 7)
    for n in (3, 20, 103):
        rows = spark.range(n).select((F.col("id") * 7 % 1009).alias("k"))
        tiled = loading._tiled(rows, "k", 20).collect()
        want = rows.select("k", F.ntile(20).over(Window.orderBy("k")).alias("tile")).collect()
        assert sorted(map(tuple, tiled)) == sorted(map(tuple, want))


def test_an_append_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quorate.store, "TASK_ROWS", 10)
    table = Table(spark, str(tmp_path), NEWS).create()
    now = F.lit("2025-03-01 12:30:00").cast("timestamp")
    rows = apply_defaults(spark.range(100).select(F.col("id").alias("news_id")), NEWS, now)
    table.replace(rows, F.lit("r"), ["r"], str(tmp_path / "load"))
    assert sorted(r["news_id"] for r in table.read(["r"]).collect()) == list(range(100))
    assert len([f for f in table.read(["r"]).inputFiles() if "slice=r" in f]) > 2


def test_stored_tables_start_no_python_workers(spark, tmp_path, monkeypatch):
    now = F.lit("2025-03-01 12:30:00").cast("timestamp")
    rows = apply_defaults(spark.range(3).select(F.col("id").alias("news_id")), NEWS, now)
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    table = Table(spark, str(tmp_path), NEWS).create()
    assert table.read().count() == 0
    table.replace(rows, F.lit("r"), ["r", "gone"], str(tmp_path / "load"))
    assert table.slices() == ["gone", "r"] and table.read().count() == 3
    assert Table(spark, str(tmp_path), NEWS).create().read().schema == table.read().schema
