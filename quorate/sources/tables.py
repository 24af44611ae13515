"""Tables and SQL texts by one name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan(spark: SparkSession, name_or_sql: str) -> DataFrame:
    """A plain name is a catalog table or view, anything else is SQL text."""
    return spark.table(name_or_sql) if name_or_sql.isidentifier() else spark.sql(name_or_sql)
