"""Date rules. The text's shape picks the format, so that no row pays for a
failed parse in the usual case, and the year always has four digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quorate.functions.text import collapse_space

_YEAR = r"(?!0000)\d{4}"
_CLOCK = r"(?:[01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d"
_ISO_DAY = rf"^{_YEAR}-\d{{1,2}}-\d{{1,2}}$"
_SLASHED = rf"^\d{{1,2}}/\d{{1,2}}/{_YEAR}$"
_ISO_DAY_CLOCK = rf"^{_YEAR}-\d{{1,2}}-\d{{1,2}}\s+{_CLOCK}$"
_ISO_INSTANT = rf"^{_YEAR}-\d{{1,2}}-\d{{1,2}}T{_CLOCK}Z$"
_MAIL = rf"(?i)^(?:mon|tue|wed|thu|fri|sat|sun), (\d{{1,2}} [a-z]{{3}} {_YEAR}) {_CLOCK} (?:gmt|utc)$"


def _if(text: Column, shape: str, date: Column) -> Column:
    return F.when(text.rlike(shape), date)


def parse_date(text: Column) -> Column:
    """`Aug 7, 2025`, `August 7, 2025` or `2025-08-07`; anything else is null."""
    flat = collapse_space(text.cast("string"))
    return (
        _if(flat, rf"^[A-Za-z]{{3}} \d{{1,2}}, {_YEAR}$", F.try_to_date(flat, "MMM d, yyyy"))
        .when(flat.rlike(rf"^[A-Za-z]{{4,9}} \d{{1,2}}, {_YEAR}$"), F.try_to_date(flat, "MMMM d, yyyy"))
        .when(flat.rlike(_ISO_DAY), F.try_to_date(flat, "yyyy-M-d"))
    )


def parse_date_as(text: Column, fmt: str = "yyyy-M-d") -> Column:
    """One given Spark date format, else null."""
    return F.try_to_date(text, fmt)


def parse_record_date(text: Column) -> Column:
    """Date texts that validation accepts; a slashed date is read day first."""
    return (
        _if(text, _ISO_DAY, F.try_to_date(text, "yyyy-M-d"))
        .when(
            text.rlike(_SLASHED),
            F.coalesce(F.try_to_date(text, "d/M/yyyy"), F.try_to_date(text, "M/d/yyyy")),
        )
        .when(text.rlike(_ISO_DAY_CLOCK), F.try_to_date(F.regexp_extract(text, r"^\S+", 0), "yyyy-M-d"))
    )


def parse_instant_date(text: Column) -> Column:
    """Day of an instant such as `2025-01-31T00:00:00Z`, else null."""
    return _if(text, _ISO_INSTANT, F.try_to_date(F.substring_index(text, "T", 1), "yyyy-M-d"))


def parse_mail_date(text: Column) -> Column:
    """Day of a feed date such as `Fri, 31 Jan 2025 07:00:00 GMT`, else null."""
    return _if(text, _MAIL, F.try_to_date(F.regexp_extract(text, _MAIL, 1), "d MMM yyyy"))
