"""Field validation: rules compiled to native column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorate.functions.dates import parse_record_date
from quorate.functions.registration import LOOSE_NUMBER, NUMBER_LENGTH, normalise_number
from quorate.functions.urls import URL_PATTERN, has_scheme
from quorate.operators.rules import MESSAGES, SEVERITIES, FieldRule, rule_set

INFO, WARNING, ERROR, CRITICAL = SEVERITIES


def _say(key: str, **given) -> Column:
    """Message text; values that are columns are concatenated in."""
    parts, text = [], MESSAGES[key]
    while "{" in text:
        head, rest = text.split("{", 1)
        name, text = rest.split("}", 1)
        value = given[name]
        parts += [F.lit(head), value.cast("string") if isinstance(value, Column) else F.lit(str(value))]
    return F.concat(*parts, F.lit(text)) if parts else F.lit(text)


def _type_name(dtype: T.DataType) -> str:
    """Name of the value's type in messages."""
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, T.IntegralType):
        return "int"
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return "float"
    if isinstance(dtype, T.DateType):
        return "date"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return dtype.typeName()


@dataclass(frozen=True)
class _Case:
    when: Column | None
    valid: bool
    severity: str
    message: str
    suggested: Column | None
    given: dict


class _Cases:
    """Ordered outcomes, the first that applies wins; the last has no condition."""

    def __init__(self):
        self.cases: list[_Case] = []

    def add(self, when: Column | None, valid: bool, severity: str, message: str, suggested=None, **given) -> None:
        self.cases.append(_Case(when, valid, severity, message, suggested, given))

    def pick(self, part: Callable[[_Case], Column]) -> Column:
        *first, last = self.cases
        if not first:
            return part(last)
        chain = F.when(first[0].when, part(first[0]))
        for case in first[1:]:
            chain = chain.when(case.when, part(case))
        return chain.otherwise(part(last))


@dataclass(frozen=True)
class Verdict:
    """One rule on one column; each part is an expression of its own, made when
    it is asked for, as scores need no messages."""

    rule: FieldRule
    value: Column
    cases: _Cases

    @property
    def valid(self) -> Column:
        return self.cases.pick(lambda c: F.lit(c.valid))

    @property
    def severity(self) -> Column:
        return self.cases.pick(lambda c: F.lit(c.severity))

    @property
    def message(self) -> Column:
        return self.cases.pick(lambda c: _say(c.message, **c.given))

    @property
    def suggested(self) -> Column:
        return self.cases.pick(lambda c: F.lit(None).cast("string") if c.suggested is None else c.suggested)


def _is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.NullType))


def _string(rule: FieldRule, c: Column, dtype, cases: _Cases) -> None:
    if not _is_text(dtype):
        cases.add(None, False, ERROR, "no_string", type=_type_name(dtype))
        return
    length = F.length(c)
    if rule.min_length:
        cases.add(length < rule.min_length, False, ERROR, "too_short", limit=rule.min_length, got=length)
    if rule.max_length is not None:
        cut = F.substring(c, 1, rule.max_length)
        cases.add(length > rule.max_length, False, ERROR, "too_long", cut, limit=rule.max_length, got=length)
    if rule.pattern:
        cases.add(~c.rlike(rule.pattern), False, ERROR, "no_match")
    cases.add(None, True, INFO, "string_ok")


def _url(rule: FieldRule, c: Column, dtype, cases: _Cases) -> None:
    if not _is_text(dtype):
        cases.add(None, False, ERROR, "no_string_url", type=_type_name(dtype))
        return
    suggested = F.concat(F.lit("https://"), c)
    cases.add(c.rlike(URL_PATTERN), True, INFO, "url_ok")
    cases.add(~has_scheme(c) & suggested.rlike(URL_PATTERN), False, WARNING, "no_scheme", suggested)
    cases.add(None, False, ERROR, "bad_url")


def _registration(rule: FieldRule, c: Column, dtype, cases: _Cases) -> None:
    if not _is_text(dtype):
        cases.add(None, False, ERROR, "no_string_number", type=_type_name(dtype))
        return
    number = normalise_number(c)
    cases.add(F.length(number) != NUMBER_LENGTH, False, ERROR, "number_length", got=F.length(number))
    cases.add(~number.rlike(LOOSE_NUMBER), False, ERROR, "bad_number")
    cases.add(None, True, INFO, "number_ok", F.when(number != c, number))


def _date(rule: FieldRule, c: Column, dtype, cases: _Cases) -> None:
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        cases.add(None, True, INFO, "date_ok")
    elif _is_text(dtype):
        date = parse_record_date(c)
        cases.add(date.isNotNull(), True, INFO, "date_text_ok", date.cast("string"))
        cases.add(None, False, ERROR, "bad_date")
    else:
        cases.add(None, False, ERROR, "no_date", type=_type_name(dtype))


def _numeric(rule: FieldRule, c: Column, dtype, cases: _Cases) -> None:
    if isinstance(dtype, T.NumericType):
        cases.add(None, True, INFO, "numeric_ok")
    elif _is_text(dtype):
        cases.add(c.try_cast("decimal(38,9)").isNotNull(), True, INFO, "numeric_ok")
        cases.add(None, False, ERROR, "no_number")
    else:
        cases.add(None, False, ERROR, "no_number")


def _year(rule: FieldRule, c: Column, dtype, cases: _Cases) -> None:
    if isinstance(dtype, (T.NumericType, T.StringType, T.NullType)):
        cases.add(c.cast("string").rlike(r"^[0-9]{4}\z"), True, INFO, "year_ok")
    cases.add(None, False, ERROR, "bad_year")


def _boolean(rule: FieldRule, c: Column, dtype, cases: _Cases) -> None:
    if isinstance(dtype, T.BooleanType):
        cases.add(None, True, INFO, "boolean_ok")
        return
    if _is_text(dtype):
        cases.add(F.lower(c).isin("true", "false"), True, INFO, "boolean_ok")
    cases.add(None, False, ERROR, "no_boolean")


_KINDS = {
    "string": _string,
    "url": _url,
    "registration": _registration,
    "date": _date,
    "numeric": _numeric,
    "year": _year,
    "boolean": _boolean,
}


def judge(df: DataFrame, rule: FieldRule) -> Verdict:
    """Compile one rule; a column the table lacks counts as null."""
    known = rule.field in df.columns
    dtype = df.schema[rule.field].dataType if known else T.NullType()
    c = F.col(rule.field) if known else F.lit(None).cast("string")
    cases = _Cases()
    empty = c.isNull() | (c == "") if _is_text(dtype) else c.isNull()
    if rule.required:
        cases.add(empty, False, ERROR, "missing", field=rule.field)
    else:
        cases.add(empty, True, INFO, "empty")
    if known:
        _KINDS[rule.kind](rule, c, dtype, cases)
    else:
        cases.cases = [replace(cases.cases[0], when=None)]
    verdict = Verdict(rule, c.cast("string"), cases)
    if rule.kind == "registration" and known and _is_text(dtype):
        normal = F.when(~empty & verdict.valid, normalise_number(c)).otherwise(verdict.value)
        return replace(verdict, value=normal)
    return verdict


def judge_all(
    df: DataFrame, entity_type: str, style: str = "typed", rules: Sequence[FieldRule] | None = None
) -> list[Verdict]:
    """Verdicts of a built-in rule set, or of ``rules`` under any name."""
    return [judge(df, rule) for rule in (rule_set(entity_type, style) if rules is None else rules)]


def validate(
    df: DataFrame,
    entity_type: str,
    keys: Sequence[str],
    style: str = "typed",
    rules: Sequence[FieldRule] | None = None,
) -> DataFrame:
    """Long results ``(keys, entity_type, field, value, is_valid, severity,
    message, suggested_value)``, one row per table row and declared field."""
    lines = [
        F.struct(
            F.lit(v.rule.field).alias("field"),
            v.value.alias("value"),
            v.valid.alias("is_valid"),
            v.severity.alias("severity"),
            v.message.alias("message"),
            v.suggested.alias("suggested_value"),
        )
        for v in judge_all(df, entity_type, style, rules)
    ]
    return df.select(*keys, F.lit(entity_type).alias("entity_type"), F.inline(F.array(*lines)))


def _mark(case: _Case) -> int:
    if case.valid:
        return 0
    return {ERROR: 1, CRITICAL: 1, WARNING: 2}.get(case.severity, 3)


def with_counts(df: DataFrame, entity_type: str, style: str = "typed", rules: Sequence[FieldRule] | None = None) -> DataFrame:
    """Add to every row its numbers of fields, valid fields, errors and
    warnings, without building the long table.

    Each rule is judged once per row: its outcome is one small number, and the
    counters look at the array of those numbers only.
    """
    marks = []
    for v in judge_all(df, entity_type, style, rules):
        marks.append(v.cases.pick(lambda c: F.lit(_mark(c))))
    marked = df.select("*", F.explode(F.array(F.array(*marks))).alias("_marks"))

    def marked_as(mark: int) -> Column:
        return F.size(F.filter("_marks", lambda m: m == mark))

    return marked.select(
        *df.columns,
        F.lit(len(marks)).alias("fields"),
        marked_as(0).alias("valid_fields"),
        marked_as(1).alias("errors"),
        marked_as(2).alias("warnings"),
    )


def row_counts(
    df: DataFrame, entity_type: str, keys: Sequence[str], style: str = "typed", rules: Sequence[FieldRule] | None = None
) -> DataFrame:
    """The counters of ``with_counts`` with keys and type only."""
    counted = with_counts(df, entity_type, style, rules)
    return counted.select(
        *keys, F.lit(entity_type).alias("entity_type"), "fields", "valid_fields", "errors", "warnings"
    )


def row_validity(
    df: DataFrame, entity_type: str, keys: Sequence[str], style: str = "typed", rules: Sequence[FieldRule] | None = None
) -> DataFrame:
    """Per row: is every result that is not a warning valid?"""
    verdicts = judge_all(df, entity_type, style, rules)
    passes = reduce(lambda a, b: a & b, [v.valid | (v.severity == WARNING) for v in verdicts])
    return df.select(*keys, F.lit(entity_type).alias("entity_type"), passes.alias("is_valid"))


def apply_suggestions(
    df: DataFrame, entity_type: str, style: str = "typed", fail_on: str = "critical", rules: Sequence[FieldRule] | None = None
) -> DataFrame:
    """Put suggested values in place. A failure of severity ``fail_on`` or worse
    stops the job (no built-in rule is critical).

    The stop is a filter and not part of the values, so it is there whatever
    columns are asked for later. Rules that have no such failure add nothing.
    """
    at_least = SEVERITIES[SEVERITIES.index(fail_on) :]
    verdicts = [v for v in judge_all(df, entity_type, style, rules) if v.rule.field in df.columns]
    changed, stops = {}, []
    for v in verdicts:
        column = v.rule.field
        changed[column] = F.coalesce(v.suggested.try_cast(df.schema[column].dataType), F.col(column))
        if any(not c.valid and c.severity in at_least for c in v.cases.cases):
            fatal = ~v.valid & v.severity.isin(list(at_least))
            error = F.raise_error(F.concat(F.lit(f"{entity_type}.{column}: "), v.message)).cast("boolean")
            stops.append(F.when(fatal, error).otherwise(True))
    if stops:
        df = df.where(reduce(lambda a, b: a & b, stops))
    return df.withColumns(changed)
