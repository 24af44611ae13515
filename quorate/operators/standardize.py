"""One pass that applies a cleaning rule to each named column."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorate import functions as fn
from quorate.sources.staging import stage


def _scalar(pick: Callable[[Column], Column], clean: Callable[..., Column]):
    """Rule over a text column or, by ``pick``, over a list of texts."""

    def apply(column: Column, dtype: T.DataType, **options) -> Column:
        value = pick(column) if isinstance(dtype, T.ArrayType) else column
        return clean(value, **options)

    return apply


RULES = {
    "name": _scalar(fn.first_nonblank, fn.clean_name),
    "url": _scalar(fn.first_item, fn.clean_url),
    "date": _scalar(fn.first_nonblank, fn.parse_date),
    "date_as": _scalar(fn.first_nonblank, fn.parse_date_as),
    "location": _scalar(fn.first_nonblank, fn.clean_location),
    "registration": _scalar(fn.first_nonblank, fn.clean_number),
    "amount": _scalar(fn.first_nonblank, fn.parse_amount),
    "text": _scalar(fn.first_nonblank, fn.truncate_words),
    "web_url": _scalar(fn.first_item, lambda u: F.when(fn.is_web_url(u), u)),
    "first_nonblank": _scalar(fn.first_nonblank, lambda c: c),
}


@dataclass(frozen=True)
class Rule:
    """Clean ``column`` by ``kind`` into ``into`` (the column itself if unset)."""

    column: str
    kind: str
    into: str | None = None
    options: dict = field(default_factory=dict)

    @property
    def target(self) -> str:
        return self.into or self.column


def _cleaned(df: DataFrame, rule: Rule) -> Column:
    if rule.kind not in RULES:
        raise ValueError(f"unknown cleaning rule {rule.kind!r}")
    return RULES[rule.kind](F.col(rule.column), df.schema[rule.column].dataType, **rule.options)


def _raw_text(df: DataFrame, rule: Rule) -> Column:
    column = F.col(rule.column)
    if isinstance(df.schema[rule.column].dataType, T.ArrayType):
        return F.array_join(column, " ")
    return column.cast("string")


def _lost(df: DataFrame, rule: Rule) -> Column:
    """The raw value has visible text and the rule made nothing of it."""
    raw = fn.is_filled(fn.strip(_raw_text(df, rule)))
    return raw & ~fn.is_filled(_cleaned(df, rule))


def standardize(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Cleaned table, and one row per rule ``(column_name, rule, rejected)``.

    Both are single scans of native expressions; the counts are one partial
    aggregate per task, so nothing but counters is shuffled.
    """
    clean = df.withColumns({r.target: _cleaned(df, r) for r in rules})
    counts = df.agg(*[F.count_if(_lost(df, r)).alias(f"_{i}") for i, r in enumerate(rules)])
    lines = [
        F.struct(F.lit(r.column).alias("column_name"), F.lit(r.kind).alias("rule"), F.col(f"_{i}").alias("rejected"))
        for i, r in enumerate(rules)
    ]
    return clean, counts.select(F.inline(F.array(*lines)))


def standardize_stored(df: DataFrame, rules: Sequence[Rule], folder: str, name: str = "clean") -> tuple[DataFrame, DataFrame]:
    """The two tables of ``standardize`` from one scan: the cleaned rows are
    written below ``folder`` and counted on their way there. A row that a
    repeated task writes again counts once, as there is no exchange between
    the scan and the write. The counts have the rows of the table as well:
    ``(column_name, rule, rejected, rows)``."""
    counted = Observation()
    lost = [F.count_if(_lost(df, r)).alias(f"_{i}") for i, r in enumerate(rules)]
    observed = df.observe(counted, F.count(F.lit(1)).alias("_rows"), *lost)
    clean = stage(observed.withColumns({r.target: _cleaned(df, r) for r in rules}), folder, name)
    found = counted.get
    lines = [(r.column, r.kind, found[f"_{i}"], found["_rows"]) for i, r in enumerate(rules)]
    return clean, df.sparkSession.createDataFrame(lines, "column_name STRING, rule STRING, rejected BIGINT, rows BIGINT")


def rejected_values(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """Long table ``(keys, column_name, rule, raw)`` of the values that rules lost."""
    lines = [
        F.when(
            _lost(df, r),
            F.struct(F.lit(r.column).alias("column_name"), F.lit(r.kind).alias("rule"), _raw_text(df, r).alias("raw")),
        )
        for r in rules
    ]
    return df.select(*keys, F.inline(F.array_compact(F.array(*lines))))


def normalise_text_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Name cleaning over the listed columns that exist and hold text; nulls stay."""
    texts = [f for f in fields if f in df.columns and isinstance(df.schema[f].dataType, T.StringType)]
    return df.withColumns({f: F.when(F.col(f).isNotNull(), fn.clean_name(F.col(f))) for f in texts})


def parse_founders(df: DataFrame, names: str, keys: Sequence[str], role: str = "Founder") -> DataFrame:
    """A list column of names to one row per cleaned, non-empty name."""
    rows = df.select(*keys, F.posexplode(names).alias("ordinal", "_name"))
    cleaned = rows.select(*keys, "ordinal", fn.clean_name(F.col("_name")).alias("full_name"))
    return cleaned.where(F.col("full_name") != "").withColumn("role_type", F.lit(role))
