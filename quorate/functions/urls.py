"""URL rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quorate.functions.text import strip

# Fixed value: the URL shape that counts as valid (host labels, localhost or a
# dotted quad; top-level domains of two to six letters; optional port, path).
URL_PATTERN = (
    r"(?i)^https?://"
    r"(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,6}\.?|"
    r"localhost|"
    r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"
    r"(?::\d+)?"
    r"(?:/?|[/?]\S+)$"
)


def has_scheme(url: Column) -> Column:
    return url.startswith("http://") | url.startswith("https://")


def with_scheme(url: Column) -> Column:
    return F.when(has_scheme(url), url).otherwise(F.concat(F.lit("https://"), url))


def clean_url(url: Column) -> Column:
    """Trimmed URL with an http(s) scheme; empty text for nothing."""
    bare = F.coalesce(strip(url.cast("string")), F.lit(""))
    return F.when(bare == "", bare).otherwise(with_scheme(bare))


def is_web_url(url: Column) -> Column:
    """An http or https scheme and a non-empty host part."""
    return F.coalesce(url.rlike(r"(?i)^[\x00-\x20]*https?://[^/?#]"), F.lit(False))
