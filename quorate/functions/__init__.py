"""Column functions: native expressions only, no Python workers."""

from quorate.functions.amounts import UNIT_FACTORS, parse_amount
from quorate.functions.dates import (
    parse_date,
    parse_date_as,
    parse_instant_date,
    parse_mail_date,
    parse_record_date,
)
from quorate.functions.registration import clean_number, normalise_number
from quorate.functions.text import (
    clean_location,
    clean_name,
    collapse_space,
    first_item,
    first_nonblank,
    is_filled,
    strip,
    truncate_words,
)
from quorate.functions.urls import clean_url, is_web_url

__all__ = [
    "UNIT_FACTORS",
    "clean_location",
    "clean_name",
    "clean_number",
    "clean_url",
    "collapse_space",
    "first_item",
    "first_nonblank",
    "is_filled",
    "is_web_url",
    "normalise_number",
    "parse_amount",
    "parse_date",
    "parse_date_as",
    "parse_instant_date",
    "parse_mail_date",
    "parse_record_date",
    "strip",
    "truncate_words",
]
