"""Entity lists, landing tables and staging."""

from __future__ import annotations

import pytest

from quorate.sources import entity_list, read_entities, read_entity_file, split_by_status, staging_root


def test_csv_list(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text(
        "ordinal,Reference Number,Name Of The Company,Grant Year,Other\n"
        "3,R3,Third,2003,x\n1,R1,First, 2001 ,x\n2,R2,Second,2002.0,x\n4,,Fourth,2004,x\n5,R5,Fifth,soon,x\n"
    )
    good, bad = read_entities(spark, str(path))
    assert {(r["entity_id"], r["grant_year"]) for r in good.collect()} == {("R1", 2001), ("R2", 2002), ("R3", 2003)}
    assert {(r["entity_id"], r["reason"]) for r in bad.collect()} == {
        (None, "entity id is missing"), ("R5", "year is not a number"),
    }
    pilot, _ = read_entities(spark, str(path), mode="pilot", n=2)
    assert {r["entity_id"] for r in pilot.collect()} == {"R1", "R2"}


@pytest.fixture
def small_pieces(spark):
    """Files are read in pieces of 2 kB."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n, value in zip(names, ("2048", "16")):
        spark.conf.set(n, value)
    yield
    for n, value in zip(names, before):
        spark.conf.set(n, value)


@pytest.mark.parametrize("sizes", [[700], [5, 0, 300, 1, 90]])
def test_plain_list_in_file_order(spark, tmp_path, small_pieces, sizes):
    """No column tells the order; files are of several pieces, or empty."""
    wanted = []
    for number, size in enumerate(sizes):
        ids = [f"R{number}-{(i * 7919) % 1000}" for i in range(size)]
        wanted += ids
        lines = [f"{i},Company {i},{2000 + n % 20}" for n, i in enumerate(ids)]
        (tmp_path / f"list-{number}.csv").write_text("\n".join(["Reference Number,Name Of The Company,Grant Year", *lines]) + "\n")
    rows = read_entity_file(spark, str(tmp_path))
    assert spark.read.csv(str(tmp_path)).rdd.getNumPartitions() > 1
    assert [r["entity_id"] for r in sorted(rows.collect(), key=lambda r: r["ordinal"])] == wanted
    assert sorted(r["ordinal"] for r in rows.collect()) == list(range(len(wanted)))
    for n in (3, 10, 400):
        pilot, bad = read_entities(spark, str(tmp_path), mode="pilot", n=n)
        assert {r["entity_id"]: r["ordinal"] for r in pilot.collect()} == dict(zip(wanted[:n], range(n))) and bad.count() == 0


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        entity_list(spark.createDataFrame([("a", "b", "1", 1)], "entity_id STRING, entity_name STRING, grant_year STRING, ordinal INT"), "other")


def test_status(spark):
    rows = spark.createDataFrame([("a", 200, "x"), ("b", 404, "x"), ("c", None, "x"), ("d", 200, None)], "e STRING, status_code INT, body STRING")
    good, bad = split_by_status(rows)
    assert [r["e"] for r in good.collect()] == ["a"]
    assert {(r["e"], r["reason"]) for r in bad.collect()} == {("b", "status 404"), ("c", "status unknown"), ("d", "no body")}


def test_staging_folder_is_the_session_s(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
