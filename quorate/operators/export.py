"""Tables to folders of files."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorate.sources.tables import scan


def without_zone(df: DataFrame) -> DataFrame:
    """Zoned timestamps as plain ones, read in the session zone."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def folder_name(label: str) -> str:
    return re.sub(r"\W+", "_", label).strip("_")


def export_tables(spark: SparkSession, tables: list[str] | dict[str, str], path: str, fmt: str = "csv") -> list[str]:
    """Write each table (a name or SQL text, or a label with either) to a
    folder of its own. Empty tables are left out; it is an error if all are,
    or if two labels have one folder."""
    named = tables if isinstance(tables, dict) else {t: t for t in tables}
    folders = Counter(map(folder_name, named))
    if shared := sorted(label for label in named if folders[folder_name(label)] > 1):
        raise ValueError(f"labels with one folder: {', '.join(shared)}")
    written = []
    for label, source in named.items():
        df = without_zone(scan(spark, source))
        if df.isEmpty():
            continue
        target = f"{path}/{folder_name(label)}"
        writer = df.write.mode("overwrite").format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(target)
        written.append(target)
    if not written:
        raise ValueError("No data to export: every table is empty.")
    return written
