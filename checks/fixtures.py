"""Inputs in the engine's shapes, made from the driver's tables.

Every recipe works row by row on a whole table (no grouping, no collecting), so
that the inputs grow with the tables and have no hot spots of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows of a costly table that one task parses, at most about that many.
TASK_ROWS = 50_000


def spread_table(spark: SparkSession, folder: str, name: str, task_rows: int | None = None, by_number: bool = False) -> DataFrame:
    """A table whose rows are costly to parse, dealt over the cores before
    messy text is made of it: the driver's files are one split each. Larger
    tables are more tasks and not larger ones. ``by_number`` deals the same rows
    to each task, but a plan that is asked for its shuffles by key has none of
    them here."""
    rows = table(spark, folder, name)
    # By the key, as dealing in turn sorts the rows first.
    tasks, key = max(spark.sparkContext.defaultParallelism, rows.count() // (task_rows or TASK_ROWS) + 1), rows.columns[0]
    return rows.repartitionById(tasks, F.pmod(F.hash(key), F.lit(tasks))) if by_number else rows.repartition(tasks, key)


def entities(spark, folder) -> DataFrame:
    """Entity list with untidy names and, now and then, a junk year."""
    return table(spark, folder, "customer").selectExpr(
        "concat('C/', c_custkey) AS entity_id",
        """CASE c_custkey % 3
             WHEN 0 THEN concat('  ', upper(c_name), '   ', c_mktsegment, ' ')
             WHEN 1 THEN concat(lower(c_name), '\t', lower(c_mktsegment))
             ELSE concat(c_name, '\u00a0', c_mktsegment, '\n') END AS entity_name""",
        "CASE WHEN c_custkey % 17 = 0 THEN 'n/a' ELSE cast(2000 + c_custkey % 25 AS STRING) END AS grant_year",
        "c_custkey AS ordinal",
    )


# What the SQL side uses for a cleaned entity name and for the year.
SQL_ENTITY_NAME = "c_name || ' ' || upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2))"
SQL_YEAR = "2000 + c_custkey % 25"


def observations_wide(spark, folder) -> DataFrame:
    """Source rows: one order is one source's view of its customer."""
    return spread_table(spark, folder, "orders", by_number=True).selectExpr(
        "concat('C/', o_custkey) AS entity_id",
        "o_orderkey AS source_rank",
        "CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE concat('site-', lower(o_orderstatus), '.example.org') END AS website_url",
        """CASE WHEN o_orderkey % 7 = 1 THEN NULL
                WHEN o_orderkey % 3 = 0 THEN concat('u', lpad(o_custkey % 100000, 5, '0'), 'mh', year(o_orderdate), 'ptc', lpad(o_custkey % 1000000, 6, '0'))
                ELSE concat('U', o_custkey) END AS cin""",
        "CASE WHEN o_orderkey % 7 = 2 THEN '' ELSE date_format(trunc(o_orderdate, 'YEAR'), 'MMM d, yyyy') END AS incorporation_date",
        "CASE WHEN o_orderkey % 7 = 3 THEN '' ELSE concat(' ', o_orderpriority, '  town ') END AS location",
        "CASE WHEN o_orderkey % 7 = 4 THEN '' ELSE o_orderstatus END AS original_awardee",
        "CASE WHEN o_orderkey % 7 = 5 THEN NULL ELSE o_orderpriority END AS mca_status",
    )


# The same rows on the SQL side.
SQL_OBSERVATIONS = """
obs_wide AS (
  SELECT o_custkey AS k, o_orderkey AS r,
    CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'site-' || lower(o_orderstatus) || '.example.org' END AS website_url,
    CASE WHEN o_orderkey % 7 = 1 THEN NULL
         WHEN o_orderkey % 3 = 0 THEN 'u' || lpad((o_custkey % 100000)::VARCHAR, 5, '0') || 'mh' || year(o_orderdate) || 'ptc' || lpad((o_custkey % 1000000)::VARCHAR, 6, '0')
         ELSE 'U' || o_custkey END AS cin,
    CASE WHEN o_orderkey % 7 = 2 THEN '' ELSE 'Jan 1, ' || year(o_orderdate) END AS incorporation_date,
    CASE WHEN o_orderkey % 7 = 3 THEN '' ELSE ' ' || o_orderpriority || '  town ' END AS location,
    CASE WHEN o_orderkey % 7 = 4 THEN '' ELSE o_orderstatus END AS original_awardee,
    CASE WHEN o_orderkey % 7 = 5 THEN NULL ELSE o_orderpriority END AS mca_status
  FROM orders),
obs AS (
  SELECT k, r, 'website_url' AS f, website_url AS v FROM obs_wide
  UNION ALL SELECT k, r, 'cin', cin FROM obs_wide
  UNION ALL SELECT k, r, 'incorporation_date', incorporation_date FROM obs_wide
  UNION ALL SELECT k, r, 'location', location FROM obs_wide
  UNION ALL SELECT k, r, 'original_awardee', original_awardee FROM obs_wide
  UNION ALL SELECT k, r, 'mca_status', mca_status FROM obs_wide),
tally AS (
  SELECT k, f, v, count(*) AS n, min(r) AS m FROM obs WHERE v <> '' GROUP BY k, f, v),
vote AS (
  SELECT k, f, arg_max(v, struct_pack(c := n, m := -m)) AS v, max(n) AS n FROM tally GROUP BY k, f),
voted AS (
  SELECT k,
    max(v) FILTER (f = 'website_url') AS website_url, max(v) FILTER (f = 'cin') AS cin,
    max(v) FILTER (f = 'incorporation_date') AS incorporation_date, max(v) FILTER (f = 'location') AS location,
    max(v) FILTER (f = 'original_awardee') AS original_awardee, max(v) FILTER (f = 'mca_status') AS mca_status
  FROM vote GROUP BY k)
"""

# The company table on the SQL side, as built from the voted rows.
SQL_COMPANIES = f"""
company AS (
  SELECT 'C/' || c_custkey AS big_award_id, {SQL_ENTITY_NAME} AS registered_name, original_awardee,
    {SQL_YEAR} AS big_award_year,
    CASE WHEN coalesce(website_url, '') = '' THEN '' ELSE 'https://' || website_url END AS website_url,
    CASE WHEN length(cin) = 21 THEN upper(cin) END AS cin,
    CASE WHEN incorporation_date <> '' THEN right(incorporation_date, 4) || '-01-01' END AS incorporation_date,
    coalesce(trim(regexp_replace(location, ' +', ' ', 'g')), '') AS location, mca_status,
    round(((website_url IS NOT NULL)::INT + (cin IS NOT NULL)::INT + (incorporation_date IS NOT NULL)::INT
      + (location IS NOT NULL)::INT + (original_awardee IS NOT NULL)::INT + (mca_status IS NOT NULL)::INT) / 6.0, 2)::DOUBLE AS data_quality_score
  FROM customer LEFT JOIN voted ON k = c_custkey
  WHERE c_custkey % 17 <> 0)
"""


def profile_landing(spark, folder) -> DataFrame:
    """Profile texts, one per order: clean JSON, JSON with white space or prose
    around it, and (every fifth) cut off."""
    return (
        spread_table(spark, folder, "orders")
        .selectExpr(
            "concat('C/', o_custkey) AS entity_id",
            "o_orderkey AS payload_id",
            """concat('{"website_url": " site-', o_custkey, '.example.org ", ',
                 '"founders": [{"full_name": " Founder ', o_orderkey, 'a ", "designation": " CEO "}, "Founder ', o_orderkey,
                 'b", {"full_name": " "}, 7, {"full_name": "Founder ', o_orderkey, 'c", "designation": "", "role_type": "Adviser"}], ',
                 '"cin": "', CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('U', o_custkey) END, '", ',
                 '"incorporation_date": "', date_format(o_orderdate, 'yyyy-MM-dd'), '", ',
                 '"location": "', o_orderpriority, '", "original_awardee": null, "mca_status": "', o_orderstatus, '", ',
                 '"products_services": [{"product_name": "Product ', o_orderkey, '", "development_stage": "Research"}], ',
                 '"funding_rounds": [',
                   array_join(transform(sequence(0, o_orderkey % 3), i -> concat(
                     '{"stage": "round ', i, '", "amount_inr": ',
                     CASE WHEN o_orderkey % 11 = 0 THEN '"plenty"' WHEN i = 1 THEN cast(floor(o_totalprice) AS STRING) ELSE concat('"', cast(floor(o_totalprice) AS STRING), ' Lakh"') END,
                     ', "source_name": "Fund ', o_custkey, '", "announced_date": "', date_format(o_orderdate, 'MMM d, yyyy'), '"}')), ', '),
                 ']}') AS _json""",
        )
        .selectExpr(
            "entity_id",
            "payload_id",
            """CASE payload_id % 5 WHEN 0 THEN _json WHEN 1 THEN concat('\n ', _json) WHEN 2 THEN concat(_json, ' Hope this helps.')
                 WHEN 3 THEN concat('Sure, here it is: ', _json) ELSE left(_json, 60) END AS body""",
        )
    )


def nested_profile_landing(spark, folder) -> DataFrame:
    """Profile objects inside prose, one per order, in six shapes."""
    return spread_table(spark, folder, "orders").selectExpr(
        "o_orderkey AS payload_id",
        r"""CASE o_orderkey % 6
             WHEN 0 THEN concat('Here you go: {"meta": {"src": {"n": ', o_orderkey, '}}, "cin": "U', o_custkey, '", "location": "', o_orderpriority, '", "mca_status": "', o_orderstatus, '"} Bye.')
             WHEN 1 THEN concat('Found {"cin": "U', o_custkey, '", "location": "a } b {{ ', o_orderpriority, '", "mca_status": "', o_orderstatus, '"}')
             WHEN 2 THEN concat('Use {this} or { that, a 5" disk: {"location": "', o_orderpriority, '", "mca_status": "', o_orderstatus, '", "cin": "U', o_custkey, '"} {"cin": "no"}')
             WHEN 3 THEN concat('Sure: {"cin": "U', o_custkey, '", "founders": [{"full_name": "A"}, {"full_name": "B", "x": {"cin": "no"}}')
             WHEN 4 THEN concat('So: {"mca_status": "said \\"', o_orderstatus, '}\\"", "founders": [{"x": {"y": {}}}], "location": "', o_orderpriority, '", "cin": "U', o_custkey, '"}')
             ELSE concat('First {"cin": oops, "x": {"cin": "no"}} then {"cin": "U', o_custkey, '", "location": "', o_orderpriority, '", "mca_status": "', o_orderstatus, '"}')
           END AS body""",
    )


def dirty_names(spark, folder, *also: str) -> DataFrame:
    """Part names with case, blanks, tabs and no-break spaces changed."""
    return table(spark, folder, "part").selectExpr(
        "p_partkey",
        *also,
        """CASE p_partkey % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN concat(' ', replace(p_name, ' ', '   '), ' ')
             WHEN 2 THEN replace(p_name, ' ', '\t') WHEN 3 THEN concat('\u00a0', replace(p_name, ' ', '\u00a0'), '\n')
             ELSE '' END AS dirty""",
    )


SQL_CAPITALISED = "list_aggregate(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ')"


def amounts(spark, folder) -> DataFrame:
    """Amount texts in the documented units, and junk."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        """CASE o_orderkey % 7
             WHEN 0 THEN concat('₹', cast(floor(o_totalprice) AS STRING), '.5 Cr')
             WHEN 1 THEN concat(cast(floor(o_totalprice) AS STRING), ' Lakh')
             WHEN 2 THEN concat(' ', cast(floor(o_totalprice) AS STRING), ' million ')
             WHEN 3 THEN concat('INR ', cast(floor(o_totalprice) % 1000 AS STRING), '.25B')
             WHEN 4 THEN concat('Rs. ', format_number(floor(o_totalprice), 0))
             WHEN 5 THEN cast(cast(o_totalprice AS DECIMAL(18,2)) AS STRING)
             ELSE element_at(array('abc', '1.2.3', '5K'), cast(o_orderkey % 3 AS INT) + 1) END AS amount""",
    )


SQL_AMOUNT = """CASE o_orderkey % 7
  WHEN 0 THEN (floor(o_totalprice) + 0.5) * 1e7 WHEN 1 THEN floor(o_totalprice) * 1e5
  WHEN 2 THEN floor(o_totalprice) * 1e6 WHEN 3 THEN (floor(o_totalprice) % 1000 + 0.25) * 1e9
  WHEN 4 THEN floor(o_totalprice) WHEN 5 THEN round(o_totalprice, 2) END"""


def dates(spark, folder) -> DataFrame:
    """Order dates written in several ways, and junk."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        """CASE o_orderkey % 6
             WHEN 0 THEN date_format(o_orderdate, 'MMM d, yyyy') WHEN 1 THEN concat(' ', date_format(o_orderdate, 'MMMM  d, yyyy'))
             WHEN 2 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 3 THEN date_format(o_orderdate, 'dd/MM/yyyy')
             WHEN 4 THEN date_format(o_orderdate, 'yyyy-M-d HH:mm:ss') ELSE concat('2025-02-3', o_orderkey % 2) END AS date_text""",
    )


def urls(spark, folder) -> DataFrame:
    """Page addresses, some without a scheme, some blank or junk."""
    return table(spark, folder, "pages").selectExpr(
        "page_id",
        """CASE WHEN page_id % 7 = 0 THEN element_at(array('', '  ', 'not a url'), cast(page_id % 3 AS INT) + 1)
                WHEN page_id % 3 = 0 THEN concat(' ', regexp_replace(url, '^https?://', ''))
                ELSE url END AS url_text""",
    )


def registrations(spark, folder) -> DataFrame:
    """Registration numbers and locations; by key good, lower case, short or
    with another first letter."""
    return (
        table(spark, folder, "customer")
        .selectExpr(
            "c_custkey",
            "c_nationkey",
            """concat('U', lpad(c_custkey % 100000, 5, '0'), 'MH', 2000 + c_custkey % 25, 'PTC', lpad(c_custkey % 1000000, 6, '0')) AS good""",
        )
        .selectExpr(
            "c_custkey",
            "c_nationkey",
            """CASE c_custkey % 4 WHEN 0 THEN good WHEN 1 THEN concat(' ', lower(good)) WHEN 2 THEN left(good, 20)
                 ELSE concat('Z', substr(good, 2)) END AS number_text""",
            """CASE c_custkey % 3 WHEN 0 THEN array(' ', concat('Nation  ', c_nationkey, ' '), 'x') WHEN 1 THEN array(concat('Nation ', c_nationkey))
                 ELSE array('', '  ') END AS places""",
        )
    )


SQL_NUMBER = "'U' || lpad((c_custkey % 100000)::VARCHAR, 5, '0') || 'MH' || (2000 + c_custkey % 25) || 'PTC' || lpad((c_custkey % 1000000)::VARCHAR, 6, '0')"


def patent_landing(spark, folder) -> DataFrame:
    """Patent search answers, one per part: JSON for even keys, HTML for odd."""
    return spread_table(spark, folder, "part").selectExpr(
        "concat('C/', p_partkey % 100) AS entity_id",
        "p_partkey AS payload_id",
        "CASE WHEN p_partkey % 2 = 0 THEN 'Application/JSON; charset=utf-8' ELSE 'text/html' END AS content_type",
        """CASE WHEN p_partkey % 10 = 4 THEN '{"results": [{"title": '
             WHEN p_partkey % 2 = 0 THEN
               concat('{"results": [', array_join(transform(sequence(0, p_partkey % 4), i -> concat(
                 '{"publicationNumber": "WO', p_partkey, '-', i, '", "title": "', p_name, ' ', i, '", "inventors": ["A ', p_brand, '", "B"], "filingDate": "',
                 1990 + p_size % 30, '-05-06", "jurisdiction": ', CASE WHEN i = 0 THEN 'null' ELSE '"IN,US"' END, '}')), ','), ']}')
             ELSE concat('<html><body><div class="list">', array_join(transform(sequence(1, 1 + p_partkey % 14), i -> concat(
                 CASE WHEN i % 2 = 0 THEN concat('<h3> ', p_name, ' <b>no ', i, '</b></h3>') ELSE concat('<p class="big title">', p_name, ' &amp; ', i, '</p>') END,
                 '<p>other<br>text')), ''), '</div></body></html>') END AS body""",
    )


def publication_landing(spark, folder) -> DataFrame:
    """Publication answers, one per order; every ninth is no JSON."""
    return spread_table(spark, folder, "orders").selectExpr(
        "concat('C/', o_custkey) AS entity_id",
        "o_orderkey AS payload_id",
        """CASE WHEN o_orderkey % 9 = 0 THEN '<error/>' ELSE
             concat('{"records": [', array_join(transform(sequence(1, o_orderkey % 3 + 1), i -> concat(
               '{"uid": "', o_orderkey * 4 + i, '", "title": "Study ', o_orderkey, ' part ', i, '", "source": "Journal ', o_orderpriority,
               '", "pubdate": "', date_format(o_orderdate, 'yyyy MMM'), '"}')), ','), ']}') END AS body""",
    )


def news_landing(spark, folder) -> DataFrame:
    """News answers per order: a JSON feed and an RSS feed of the same items,
    with the JSON one good, empty, broken or refused by key."""
    return (
        spread_table(spark, folder, "orders")
        .selectExpr(
            "concat('C/', o_custkey) AS entity_id",
            "o_orderkey AS payload_id",
            "o_orderkey",
            "o_orderdate",
            "o_orderpriority",
            "transform(sequence(1, 1 + o_orderkey % 7), i -> i) AS items",
            "CASE WHEN o_orderkey % 5 = 3 THEN 503 ELSE 200 END AS status_code",
        )
        .selectExpr(
            "entity_id",
            "payload_id",
            "status_code",
            """CASE WHEN o_orderkey % 5 = 1 THEN '{"news": []}' WHEN o_orderkey % 5 = 2 THEN '{"news": [{"title": "cut' ELSE
                 concat('{"news": [', array_join(transform(items, i -> concat('{"title": "Item ', o_orderkey, '-', i, '", "link": "https://news.example.org/', o_orderkey, '/', i, '", ',
                   CASE WHEN i % 2 = 0 THEN concat('"source": {"domain": "', o_orderpriority, '"}, ') ELSE '' END,
                   '"publishedDate": ', CASE WHEN i = 3 THEN 'null' ELSE concat('"', date_format(o_orderdate, 'yyyy-MM-dd'), 'T00:00:00Z"') END, '}')), ','), ']}') END AS json_body""",
            """CASE WHEN o_orderkey % 13 = 0 THEN '<rss><channel><item>' ELSE
                 concat('<?xml version="1.0"?><rss version="2.0"><channel><title>feed</title>', CASE WHEN o_orderkey % 4 = 1 THEN '</channel>' ELSE '' END, array_join(transform(items, i -> concat(
                   '<item><title>Item ', o_orderkey, '-', i, ' &amp; more</title><link>https://rss.example.org/', o_orderkey, '/', i, '</link><pubDate>',
                   CASE WHEN i = 3 THEN 'yesterday' ELSE date_format(o_orderdate, 'EEE, dd MMM yyyy 07:00:00 ') || 'GMT' END, '</pubDate></item>')), ''), CASE WHEN o_orderkey % 4 = 1 THEN '' ELSE '</channel>' END, '</rss>') END AS rss_body""",
        )
    )


# Items of the JSON feed and of the RSS feed on the SQL side, before limits.
SQL_NEWS = """
item AS (SELECT o.*, i FROM orders o, generate_series(1, 7) g(i) WHERE i <= 1 + o_orderkey % 7),
json_item AS (
  SELECT o_custkey, o_orderkey, i - 1 AS ordinal, 'Item ' || o_orderkey || '-' || i AS headline,
    'https://news.example.org/' || o_orderkey || '/' || i AS article_url,
    CASE WHEN i % 2 = 0 THEN o_orderpriority ELSE 'General' END AS news_category,
    CASE WHEN i <> 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS published_date
  FROM item WHERE o_orderkey % 5 NOT IN (1, 2)),
rss_item AS (
  SELECT o_custkey, o_orderkey, i - 1 AS ordinal, 'Item ' || o_orderkey || '-' || i || ' & more' AS headline,
    'https://rss.example.org/' || o_orderkey || '/' || i AS article_url, 'General' AS news_category,
    CASE WHEN i <> 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS published_date
  FROM item WHERE o_orderkey % 13 <> 0)
"""


def current_rows(spark, folder) -> DataFrame:
    """Stored rows of the keyed loads."""
    return (
        table(spark, folder, "orders")
        .where("o_orderkey % 3 <> 0")
        .selectExpr(
            "CASE WHEN o_orderkey % 20 = 1 THEN NULL ELSE o_orderkey END AS natural_key",
            "o_orderkey AS row_id",
            "o_custkey AS parent",
            "o_totalprice AS price",
            "o_orderstatus AS note",
            "timestamp'2024-01-01 00:00:00' AS created_at",
            "timestamp'2024-01-01 00:00:00' AS updated_at",
        )
    )


def batch_rows(spark, folder) -> DataFrame:
    """A batch: half of the keys (some with no change), each fourth key twice,
    some with no key."""
    once = (
        table(spark, folder, "orders")
        .where("o_orderkey % 2 = 0")
        .selectExpr(
            "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderkey END AS natural_key",
            "o_orderkey + 1000000000 AS row_id",
            "o_custkey AS parent",
            "CASE WHEN o_orderkey % 5 = 1 THEN o_totalprice ELSE o_totalprice + 1 END AS price",
            "explode(CASE WHEN o_orderkey % 4 = 0 THEN array(1, 2) ELSE array(2) END) AS ordinal",
        )
    )
    return once.selectExpr("natural_key", "row_id", "parent", "CASE ordinal WHEN 1 THEN price + 100 ELSE price END AS price", "ordinal")
