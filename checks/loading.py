"""Queries of loads, export and run accounting."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from quorate.operators.accounting import extraction_log, run_summary, run_version, source_counts, stamp_run
from quorate.operators.export import export_tables, without_zone
from quorate.operators.load import (
    apply_defaults,
    cascade_delete,
    check_constraints,
    new_rows,
    replace_children,
    schema_problems,
    upsert,
)
from quorate.plans.loads import load
from quorate.schemas import COMPANIES, FUNDING, NEWS, PATENTS, PEOPLE, PUBLICATIONS
from quorate.sources import new_folder, stage
from quorate.store import TASK_ROWS, KeySketch, Table

NOW = datetime(2025, 3, 1, 12, 30)
STAMP = "yyyy-MM-dd HH:mm:ss"


def _now():
    return F.lit("2025-03-01 12:30:00").cast("timestamp")


def _loaded_companies(spark, folder):
    return fx.table(spark, folder, "customer").selectExpr(
        "concat('C/', c_custkey) AS big_award_id",
        "c_name AS registered_name",
        "2000 + c_custkey % 25 AS big_award_year",
        "CASE WHEN c_custkey % 10 = 3 THEN concat('U', c_custkey % 40) ELSE concat('V', c_custkey) END AS cin",
    )


@query(
    "l1_create_and_load",
    """SELECT 'C/' || c_custkey AS big_award_id, c_name AS registered_name, 2000 + c_custkey % 25 AS big_award_year,
         0.0::DOUBLE AS data_quality_score, '2025-03-01 12:30:00' AS created_at FROM customer
       QUALIFY c_custkey % 10 <> 3 OR 'C/' || c_custkey = min('C/' || c_custkey) OVER (PARTITION BY c_custkey % 10 = 3, c_custkey % 40)""",
)
def l1(spark, folder):
    """Make a table, open it once more (which checks its schema), load, read.
    Of the companies with one registration number the first is stored."""
    root = new_folder(spark, "tables")
    Table(spark, root, COMPANIES, buckets=4).create()
    table = Table(spark, root, COMPANIES, buckets=4).create()
    load(table, _loaded_companies(spark, folder), _now(), run_version(NOW))
    return table.read().select(
        "big_award_id",
        "registered_name",
        F.col("big_award_year").cast("bigint").alias("big_award_year"),
        F.col("data_quality_score").cast("double").alias("data_quality_score"),
        F.date_format("created_at", STAMP).alias("created_at"),
    )


@query(
    "l1_schema_problems",
    """SELECT 'funding_rounds' AS table_name, c AS column_name, p AS problem, n AS rows FROM (
         SELECT 'amount_inr' AS c, 'value does not fit the type' AS p, count(*) FILTER (o_orderkey % 4 = 0) AS n FROM orders
         UNION ALL SELECT 'stage', 'text is too long', count(*) FILTER (o_orderkey % 3 = 0) FROM orders
         UNION ALL SELECT 'stage', 'value does not fit the type', 0
         UNION ALL SELECT 'big_award_id', 'value does not fit the type', 0
         UNION ALL SELECT unnest(['funding_id', 'source_name', 'source_type', 'funding_type', 'announced_date', 'data_source', 'source_url',
           'created_at', 'updated_at']), 'column is missing', count(*) FROM orders GROUP BY 1)""",
)
def l1_problems(spark, folder):
    rows = fx.table(spark, folder, "orders").selectExpr(
        "concat('C/', o_custkey) AS big_award_id",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'a very long name of a round' ELSE 'seed' END AS stage",
        "CASE WHEN o_orderkey % 4 = 0 THEN 'much' ELSE cast(o_totalprice AS STRING) END AS amount_inr",
    )
    return schema_problems(rows, FUNDING)


_SQL_BATCH = """
cur AS (SELECT CASE WHEN o_orderkey % 20 = 1 THEN NULL ELSE o_orderkey END AS k, o_orderkey AS row_id, o_custkey AS parent, o_totalprice AS price,
    o_orderstatus AS note FROM orders WHERE o_orderkey % 3 <> 0),
bat AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderkey END AS k, o_orderkey + 1000000000 AS row_id, o_custkey AS parent,
    CASE WHEN o_orderkey % 5 = 1 THEN o_totalprice ELSE o_totalprice + 1 END AS price FROM orders WHERE o_orderkey % 2 = 0)
"""
# Keyless batch rows are plain inserts, so their earlier copies stay too.
_SQL_UPSERT = f"""WITH {_SQL_BATCH},
  merged AS (
    SELECT coalesce(cur.k, bat.k) AS natural_key, coalesce(cur.row_id, bat.row_id) AS row_id, coalesce(bat.price, cur.price) AS price, cur.note,
      CASE WHEN cur.k IS NULL THEN '2025-03-01 12:30:00' ELSE '2024-01-01 00:00:00' END AS created_at,
      CASE WHEN cur.k IS NULL OR bat.price <> cur.price THEN '2025-03-01 12:30:00' ELSE '2024-01-01 00:00:00' END AS updated_at
    FROM (SELECT * FROM cur WHERE k IS NOT NULL) cur FULL JOIN (SELECT * FROM bat WHERE k IS NOT NULL) bat ON cur.k = bat.k
    UNION ALL SELECT NULL, row_id, price, note, '2024-01-01 00:00:00', '2024-01-01 00:00:00' FROM cur WHERE k IS NULL
    UNION ALL SELECT NULL, row_id, price, NULL, '2025-03-01 12:30:00', '2025-03-01 12:30:00' FROM bat WHERE k IS NULL
    UNION ALL SELECT NULL, row_id, price + 100, NULL, '2025-03-01 12:30:00', '2025-03-01 12:30:00' FROM bat WHERE k IS NULL AND (row_id - 1000000000) % 4 = 0)
  SELECT natural_key, row_id, round(price, 2) AS price, note, created_at, updated_at FROM merged"""


def _upserted(spark, folder, fallback=None):
    rows = upsert(
        fx.current_rows(spark, folder),
        fx.batch_rows(spark, folder),
        "natural_key",
        ("ordinal",),
        _now(),
        keep=("created_at", "row_id"),
        fallback=fallback,
    )
    return rows.select(
        "natural_key",
        "row_id",
        F.round("price", 2).alias("price"),
        "note",
        F.date_format("created_at", STAMP).alias("created_at"),
        F.date_format("updated_at", STAMP).alias("updated_at"),
    )


@query("l2_upsert", _SQL_UPSERT)
def l2(spark, folder):
    """Inserted, changed, unchanged and untouched rows, and rows that have no
    key, which are plain inserts here."""
    return _upserted(spark, folder)


# Matched by their id, keyless rows are there once: the last batch row.
_SQL_BY_ID = f"""WITH {_SQL_BATCH},
  keyed AS (SELECT * FROM ({_SQL_UPSERT}) WHERE natural_key IS NOT NULL)
  SELECT * FROM keyed
  UNION ALL SELECT NULL, row_id, round(price, 2), note, '2024-01-01 00:00:00', '2024-01-01 00:00:00' FROM cur WHERE k IS NULL
  UNION ALL SELECT NULL, row_id, round(price, 2), NULL, '2025-03-01 12:30:00', '2025-03-01 12:30:00' FROM bat WHERE k IS NULL"""


@query("l4_upsert_natural_key", _SQL_BY_ID)
def l4(spark, folder):
    """The same with keyless rows matched by their id."""
    return _upserted(spark, folder, fallback="row_id")


@query(
    "l3_replace_children",
    """SELECT o_custkey AS parent, o_orderkey AS row_id, 'old' AS origin FROM orders
         WHERE o_orderkey % 3 <> 0 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
       UNION ALL SELECT o_custkey, o_orderkey, 'new' FROM orders WHERE o_totalprice > 400000""",
)
def l3(spark, folder):
    columns = ("parent", "row_id", "origin")
    current = fx.current_rows(spark, folder).withColumn("origin", F.lit("old")).select(*columns)
    batch = fx.table(spark, folder, "orders").where("o_totalprice > 400000")
    batch = batch.selectExpr("o_custkey AS parent", "o_orderkey AS row_id", "'new' AS origin")
    return replace_children(current, batch, "parent")


@query(
    "l5_append",
    """WITH cur AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 <> 0), bat AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 2 = 0)
       SELECT 'all' AS mode, k FROM cur UNION ALL SELECT 'all', k FROM bat
       UNION ALL SELECT 'new', k FROM cur UNION ALL SELECT 'new', k FROM bat WHERE k NOT IN (SELECT k FROM cur)""",
)
def l5(spark, folder):
    orders = fx.table(spark, folder, "orders").select(F.col("o_orderkey").alias("k"))
    current, batch = orders.where("k % 3 <> 0"), orders.where("k % 2 = 0")
    parts = [
        current.unionByName(new_rows(current, batch, keys)).select(F.lit(mode).alias("mode"), "k")
        for mode, keys in (("all", ()), ("new", ("k",)))
    ]
    return parts[0].unionByName(parts[1])


def _twice(spark, spec, batches, order=(), parents=None, dedupe_keys=()):
    """Load every batch two times under one run name through a stored table,
    and give the table and the rows it refused."""
    table = Table(spark, new_folder(spark, "stored"), spec, buckets=4).create()
    refused = []
    for i, batch in enumerate(batches):
        staged = stage(batch, new_folder(spark, "stored-batch"), spec.name)
        for _ in range(2):
            bad = load(table, staged, _now(), f"run{i}", order, dedupe_keys, parents)
        refused.append(bad)
    return table, reduce(DataFrame.unionByName, refused)


@query(
    "l2_upsert_stored",
    """SELECT 'C/' || o_orderkey AS big_award_id, CASE WHEN o_orderkey % 2 = 0 THEN 'new ' ELSE 'old ' END || o_orderstatus AS registered_name FROM orders
       WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0""",
)
def l2_stored(spark, folder):
    """Base and delta, each twice, and the last of two rows of a key."""
    orders = fx.table(spark, folder, "orders")
    first = orders.where("o_orderkey % 3 <> 0").selectExpr("concat('C/', o_orderkey) AS big_award_id", "concat('old ', o_orderstatus) AS registered_name", "1 AS ordinal")
    key = "concat('C/', o_orderkey) AS big_award_id"
    even = orders.where("o_orderkey % 2 = 0")
    second = even.selectExpr(key, "concat('new ', o_orderstatus) AS registered_name", "2 AS ordinal").unionByName(
        even.selectExpr(key, "'not the last' AS registered_name", "1 AS ordinal")
    )
    table, _ = _twice(spark, COMPANIES, [first, second], ("ordinal",))
    return table.read().select("big_award_id", "registered_name")


@query(
    "l3_replace_stored",
    """WITH hot AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000)
       SELECT 'C/' || o_custkey AS big_award_id, o_orderkey AS person_id, 'old' AS full_name FROM orders
         WHERE o_orderkey % 3 <> 0 AND o_custkey NOT IN (SELECT o_custkey FROM hot)
       UNION ALL SELECT 'C/' || o_custkey, o_orderkey, 'new' FROM orders WHERE o_totalprice > 400000""",
)
def l3_stored(spark, folder):
    orders = fx.table(spark, folder, "orders")
    columns = ["concat('C/', o_custkey) AS big_award_id", "o_orderkey AS person_id"]
    batches = [
        orders.where("o_orderkey % 3 <> 0").selectExpr(*columns, "'old' AS full_name"),
        orders.where("o_totalprice > 400000").selectExpr(*columns, "'new' AS full_name"),
    ]
    table, _ = _twice(spark, PEOPLE, batches)
    return table.read().select("big_award_id", "person_id", "full_name")


@query(
    "l4_upsert_stored",
    """SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey::INTEGER END AS pubmed_id, o_orderkey AS publication_id,
         CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE 'old' END AS title FROM orders""",
)
def l4_stored(spark, folder):
    """Natural keys, some of them missing; every batch twice."""
    orders = fx.table(spark, folder, "orders")
    columns = ["CASE WHEN o_orderkey % 5 <> 0 THEN cast(o_orderkey AS INT) END AS pubmed_id", "o_orderkey AS publication_id"]
    batches = [orders.selectExpr(*columns, "'old' AS title"), orders.where("o_orderkey % 2 = 0").selectExpr(*columns, "'new' AS title")]
    table, _ = _twice(spark, PUBLICATIONS, batches)
    return table.read().select("pubmed_id", "publication_id", "title")


@query(
    "l5_append_stored",
    """SELECT o_orderkey AS news_id, 'run0' AS run FROM orders WHERE o_orderkey % 3 <> 0
       UNION ALL SELECT o_orderkey, 'run1' FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 = 0""",
)
def l5_stored(spark, folder):
    """Appends that add only keys of no other run; every attempt twice."""
    orders = fx.table(spark, folder, "orders").selectExpr("o_orderkey AS news_id")
    table, _ = _twice(spark, NEWS, [orders.where("news_id % 3 <> 0"), orders.where("news_id % 2 = 0")], dedupe_keys=("news_id",))
    return table.read(with_slice=True).select("news_id", F.col("slice").alias("run"))


def _tiled(rows, key, tiles):
    """``ntile`` over all rows by a key, without all rows in one task: ranges
    of the key are numbered each on its own, behind the sizes of those before."""
    total = rows.count()
    pieces = rows.repartitionByRange(total // TASK_ROWS + 1, key).withColumn("_piece", F.spark_partition_id())
    pieces = stage(pieces, new_folder(rows.sparkSession, "ranges"), "pieces")
    sizes = pieces.groupBy("_piece").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_piece", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_piece").orderBy(key)) - 1
    # The first tiles have a row more where the rows do not come out even.
    small, larger = divmod(total, tiles)
    edge = larger * (small + 1)
    tile = f"CASE WHEN _place < {edge} THEN _place DIV {small + 1} ELSE {larger} + (_place - {edge}) DIV {max(small, 1)} END + 1"
    return pieces.join(offsets, "_piece").withColumn("_place", place).select(*rows.columns, F.expr(tile).alias("tile"))


@query(
    "l5_sketched_append",
    """WITH o AS (SELECT o_orderkey AS k, ntile(20) OVER (ORDER BY o_orderkey) AS t FROM orders)
       SELECT k AS news_id, 'run' || t AS run FROM o WHERE k % 3 <> 0
       UNION ALL SELECT k, 'late' FROM o WHERE t IN (4, 5) AND k % 3 = 0""",
)
def l5_sketched(spark, folder):
    """A late batch that repeats two of twenty stored runs, with the rows that
    they lacked: bitmaps tell which runs to look into."""
    table = Table(spark, new_folder(spark, "tables"), NEWS).create()
    orders = _tiled(fx.table(spark, folder, "orders").select(F.col("o_orderkey").alias("news_id")), "news_id", 20)
    orders = orders.withColumn("run", F.concat(F.lit("run"), "tile")).drop("tile")
    orders = stage(orders, new_folder(spark, "runs"), "orders")
    stored = apply_defaults(orders.where("news_id % 3 <> 0"), NEWS, _now(), ("run",))
    runs = [f"run{i}" for i in range(1, 21)]
    table.replace(stored, F.col("run"), runs, new_folder(spark, "load"))
    KeySketch(table, ("news_id",)).write(stored, F.col("run"))
    load(table, orders.where("run IN ('run4', 'run5')").drop("run"), _now(), "late", dedupe_keys=("news_id",))
    return table.read(with_slice=True).select("news_id", F.col("slice").alias("run"))


@query(
    "l7_enforced_load",
    """WITH t AS (SELECT o_orderkey AS k, o_orderkey % 7 = 0 AS no_number, o_orderkey % 11 = 0 AS long, o_orderkey % 13 = 0 AS misfit,
           o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0) AS owned FROM orders)
       SELECT k AS patent_id, CASE WHEN no_number THEN 'patent_number is missing' WHEN long THEN 'patent_type is too long' WHEN misfit THEN 'filing_year does not fit its type'
         WHEN NOT owned THEN 'parent is not there' ELSE 'stored' END AS state FROM t""",
)
def l7_enforced(spark, folder):
    """Rows that a table may not hold go to the reject table."""
    batch = fx.table(spark, folder, "orders").selectExpr(
        "o_orderkey AS patent_id", "concat('C/', o_custkey) AS big_award_id", "CASE WHEN o_orderkey % 7 <> 0 THEN concat('P', o_orderkey) END AS patent_number",
        "CASE WHEN o_orderkey % 11 = 0 THEN repeat('x', 101) ELSE 'x' END AS patent_type", "CASE WHEN o_orderkey % 13 = 0 THEN 'soon' ELSE '2020' END AS filing_year",
    )
    parents = fx.table(spark, folder, "customer").where("c_custkey % 5 <> 0").selectExpr("concat('C/', c_custkey) AS big_award_id")
    table, refused = _twice(spark, PATENTS, [batch], parents=parents)
    return table.read().select("patent_id", F.lit("stored").alias("state")).unionByName(refused.select("patent_id", F.col("reason").alias("state")))


@query(
    "l7_values_in_order",
    """SELECT 'C/' || c_custkey AS big_award_id,
         CASE c_custkey % 5 WHEN 0 THEN 'W' || c_custkey
           WHEN 1 THEN CASE WHEN c_custkey = 1 THEN 'V0' ELSE 'V' || (c_custkey - 1) END ELSE 'V' || c_custkey END AS cin,
         CASE WHEN (c_custkey % 5 = 2 AND c_custkey < (SELECT max(c_custkey) FROM customer)) OR (c_custkey % 5 = 4 AND c_custkey < (SELECT max(c_custkey) FROM customer))
           THEN 'cin is taken' END AS reason
       FROM customer""",
)
def l7_in_order(spark, folder):
    """A second load in which numbers are given up, taken over, wanted too
    early and wanted in vain. The last company of all finds its number free."""
    table = Table(spark, new_folder(spark, "tables"), COMPANIES, buckets=8).create()
    first = fx.spread_table(spark, folder, "customer", TASK_ROWS).selectExpr(
        "concat('C/', c_custkey) AS big_award_id", "c_name AS registered_name", "concat('V', c_custkey) AS cin", "c_custkey AS ordinal"
    )
    first = stage(first, new_folder(spark, "companies"), "first")
    load(table, first, _now(), run_version(NOW), ("ordinal",))
    last = first.agg(F.max("ordinal")).first()[0]
    wish = F.expr(
        f"""CASE ordinal % 5 WHEN 0 THEN concat('W', ordinal) WHEN 1 THEN concat('V', ordinal - 1)
              WHEN 3 THEN cin ELSE CASE WHEN ordinal = {last} THEN cin ELSE concat('V', ordinal + 1) END END"""
    )
    refused = load(table, first.withColumn("cin", wish), _now(), run_version(NOW), ("ordinal",))
    why = refused.select("big_award_id", "reason")
    return table.read().select("big_award_id", "cin").join(why, "big_award_id", "left")


def _outcomes(spark, folder):
    """An outcome per user: errors fail it, many views do not pass."""
    events = fx.table(spark, folder, "events")
    return (
        events.groupBy(F.concat(F.lit("C/"), "user_id").alias("big_award_id"))
        .agg(
            F.count_if(F.col("event_type") == "error").alias("errors"),
            F.count_if(F.col("event_type") == "view").alias("views"),
            F.count("*").alias("records"),
        )
        .selectExpr(
            "big_award_id",
            "CASE WHEN errors > 3 THEN 'failed' WHEN views > 3 THEN 'validation_failed' ELSE 'successful' END AS outcome",
            "records",
            "CASE WHEN errors > 3 THEN concat(errors, ' errors') END AS error",
        )
    )


_SQL_OUTCOMES = """
o AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS e, count(*) FILTER (event_type = 'view') AS v, count(*) AS n FROM events GROUP BY user_id),
out AS (SELECT *, CASE WHEN e > 3 THEN 'failed' WHEN v > 3 THEN 'validation_failed' ELSE 'successful' END AS outcome FROM o)
"""


@query(
    "l6_extraction_log",
    f"""WITH {_SQL_OUTCOMES} SELECT 'C/' || user_id AS big_award_id, 'full_pipeline_RUN_20250301_123000' AS data_type,
          CASE outcome WHEN 'successful' THEN 'success' ELSE 'failed' END AS extraction_status,
          (CASE outcome WHEN 'successful' THEN n ELSE 0 END)::INTEGER AS records_found, CASE WHEN e > 3 THEN e || ' errors' END AS error_message
        FROM out WHERE outcome <> 'validation_failed'""",
)
def l6(spark, folder):
    log = extraction_log(_outcomes(spark, folder), run_version(NOW), _now())
    return log.select("big_award_id", "data_type", "extraction_status", "records_found", "error_message")


@query(
    "l7_constraints",
    """SELECT 'companies' AS table_name, 'not_null' AS constraint_name, 'registered_name' AS column_name, count(*) FILTER (c_custkey % 9 = 0) AS violations FROM customer
       UNION ALL SELECT 'companies', 'unique', 'cin', count(*) FROM (SELECT c_custkey % 40 FROM customer WHERE c_custkey % 10 = 3 GROUP BY 1 HAVING count(*) > 1)
       UNION ALL SELECT 'funding_rounds', 'foreign_key', 'big_award_id', count(*) FROM orders WHERE o_custkey % 7 = 0""",
)
def l7(spark, folder):
    companies = _loaded_companies(spark, folder).withColumn(
        "registered_name",
        F.when(F.substring_index("big_award_id", "/", -1).cast("bigint") % 9 != 0, F.col("registered_name")),
    )
    kept = companies.where(F.substring_index("big_award_id", "/", -1).cast("bigint") % 7 != 0)
    children = fx.table(spark, folder, "orders").select(F.concat(F.lit("C/"), "o_custkey").alias("big_award_id"))
    return check_constraints(companies, "companies", ["registered_name"], ["cin"]).unionByName(
        check_constraints(children, "funding_rounds", parents=kept)
    )


@query(
    "l8_cascade_delete",
    """SELECT 'customer' AS kept, c_custkey AS k, c_custkey AS parent FROM customer WHERE c_acctbal >= 0
       UNION ALL SELECT 'orders', o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def l8(spark, folder):
    parents = fx.table(spark, folder, "customer").select("c_custkey", "c_acctbal", F.col("c_custkey").alias("parent"))
    children = {"orders": fx.table(spark, folder, "orders").withColumnRenamed("o_custkey", "parent")}
    left, kept = cascade_delete(parents, children, parents.where("c_acctbal < 0"), "parent")
    return left.select(F.lit("customer").alias("kept"), F.col("c_custkey").alias("k"), "parent").unionByName(
        kept["orders"].select(F.lit("orders").alias("kept"), F.col("o_orderkey").alias("k"), "parent")
    )


@query(
    "l9_export",
    """SELECT 'export_orders' AS sheet, o_orderkey::VARCHAR AS id, o_orderstatus AS text FROM orders
       UNION ALL SELECT 'big', o_orderkey::VARCHAR, o_orderpriority FROM orders WHERE o_totalprice > 250000""",
)
def l9(spark, folder):
    """Export a table, a SQL text and an empty table, and read the files."""
    fx.table(spark, folder, "orders").createOrReplaceTempView("export_orders")
    fx.table(spark, folder, "orders").where("o_orderkey < 0").createOrReplaceTempView("export_nothing")
    path = new_folder(spark, "export")
    written = export_tables(
        spark,
        {
            "export_orders": "export_orders",
            "big": "SELECT o_orderkey, o_orderpriority FROM export_orders WHERE o_totalprice > 250000",
            "export_nothing": "export_nothing",
        },
        path,
    )
    parts = []
    for target in written:
        rows = spark.read.option("header", True).csv(target)
        text = "o_orderstatus" if target.endswith("export_orders") else "o_orderpriority"
        sheet = F.lit(target.rsplit("/", 1)[1]).alias("sheet")
        parts.append(rows.select(sheet, F.col("o_orderkey").alias("id"), F.col(text).alias("text")))
    return reduce(DataFrame.unionByName, parts)


@query(
    "l10_zoneless_timestamps",
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts, 'timestamp_ntz' AS kind FROM events""",
)
def l10(spark, folder):
    zoned = fx.table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    plain = without_zone(zoned)
    kind = plain.schema["ts"].dataType.typeName()
    return plain.select("event_id", F.date_format("ts", STAMP).alias("ts"), F.lit(kind).alias("kind"))


@query(
    "l11_defaults",
    """SELECT 'WO' || p_partkey AS patent_number, CASE WHEN p_partkey % 4 = 0 THEN true ELSE false END AS indian_jurisdiction, false AS foreign_jurisdiction,
         CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS filing_year, '2025-03-01 12:30:00' AS created_at FROM part""",
)
def l11(spark, folder):
    rows = fx.table(spark, folder, "part").selectExpr(
        "concat('WO', p_partkey) AS patent_number",
        "CASE WHEN p_partkey % 4 = 0 THEN true WHEN p_partkey % 4 = 1 THEN false END AS indian_jurisdiction",
        "CASE WHEN p_partkey % 5 = 0 THEN 'unknown' ELSE cast(p_size AS STRING) END AS filing_year",
    )
    return apply_defaults(rows, PATENTS, _now()).select(
        "patent_number",
        "indian_jurisdiction",
        "foreign_jurisdiction",
        F.col("filing_year").cast("int").alias("filing_year"),
        F.date_format("created_at", STAMP).alias("created_at"),
    )


@query(
    "r1_run_summary",
    f"""WITH {_SQL_OUTCOMES} SELECT count(*) FILTER (outcome = 'successful') AS successful, count(*) FILTER (outcome = 'failed') AS failed,
          count(*) FILTER (outcome = 'validation_failed') AS validation_failures FROM out""",
)
def r1(spark, folder):
    return run_summary(_outcomes(spark, folder))


@query("r2_run_version", "SELECT event_id, 'RUN_20250301_123000' AS run_version FROM events")
def r2(spark, folder):
    return stamp_run(fx.table(spark, folder, "events").select("event_id"), run_version(NOW))


@query(
    "r3_source_counts",
    """SELECT 'C/' || user_id AS entity_id, event_type AS source, count(*) FILTER (value >= 1) AS records_found,
         CASE WHEN count(*) FILTER (value < 1) > 0 THEN 'failed' ELSE 'success' END AS status FROM events GROUP BY user_id, event_type""",
)
def r3(spark, folder):
    items = fx.table(spark, folder, "events").select(
        F.concat(F.lit("C/"), "user_id").alias("entity_id"), F.col("event_type").alias("source"), "value"
    )
    return source_counts(items, ["entity_id", "source"], F.col("value") < 1)
