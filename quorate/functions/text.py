"""Text rules as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space (Unicode's, plus the
# four ASCII separator controls). Spark's trim() alone knows the plain blank.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_SPACE_RUN = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]++"


def collapse_space(text: Column) -> Column:
    """Every white-space run becomes one blank, none is left at the ends."""
    return F.trim(F.regexp_replace(text, _SPACE_RUN, " "))


def strip(text: Column) -> Column:
    """Remove white space at both ends, keep it inside."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_filled(value: Column) -> Column:
    """True for a value that is neither null nor the empty string."""
    return F.coalesce(value.cast("string") != "", F.lit(False))


def clean_name(text: Column) -> Column:
    """Collapsed white space, each word capitalised and its rest lowered."""
    return F.coalesce(F.initcap(collapse_space(text)), F.lit(""))


def clean_location(text: Column) -> Column:
    return F.coalesce(collapse_space(text.cast("string")), F.lit(""))


def truncate_words(text: Column, max_length: int | None = None) -> Column:
    """Collapse white space; over ``max_length`` cut there, drop the last
    partial word and add an ellipsis."""
    flat = F.coalesce(collapse_space(text), F.lit(""))
    if not max_length:
        return flat
    head = F.regexp_replace(F.substring(flat, 1, max_length), " [^ ]*+$", "")
    return F.when(F.length(flat) > max_length, F.concat(head, F.lit("..."))).otherwise(flat)


def first_nonblank(values: Column) -> Column:
    """First element of an array that has a visible character, else null."""
    return F.try_element_at(F.filter(values, lambda v: strip(v) != ""), F.lit(1))


def first_item(values: Column) -> Column:
    return F.try_element_at(values, F.lit(1))
