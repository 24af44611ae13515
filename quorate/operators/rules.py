"""Validation rules as data.

Two sets exist. ``typed`` judges a column by what it holds (numbers, booleans,
dates) and puts no limit on free text. ``observed`` is the older, stricter
reading in which every plain field must be text of at most 255 characters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from here on: field names, limits, thresholds and texts.
DEFAULT_TEXT_LIMIT = 255
YEAR_PATTERN = r"^\d{4}$"


@dataclass(frozen=True)
class FieldRule:
    field: str
    kind: str  # string, year, numeric, boolean, date, url, registration
    required: bool = False
    max_length: int | None = None
    min_length: int = 0
    pattern: str | None = None


def _text(field: str, limit: int | None = None, required: bool = False) -> FieldRule:
    return FieldRule(field, "string", required, limit)


def _kind(kind: str, *fields: str) -> list[FieldRule]:
    return [FieldRule(f, kind) for f in fields]


_OWNER = _text("big_award_id", 50, required=True)

_COMPANY = [
    _OWNER,
    _text("registered_name", 255, required=True),
    _text("original_awardee", 255),
    *_kind("year", "big_award_year"),
    *_kind("url", "website_url"),
    *_kind("registration", "cin"),
    *_kind("date", "incorporation_date"),
    _text("location"),
    _text("mca_status", 50),
    *_kind("numeric", "data_quality_score"),
    *_kind("date", "created_at", "updated_at"),
]
_PERSON = [
    *_kind("numeric", "person_id"),
    _OWNER,
    _text("full_name", 255, required=True),
    _text("designation", 255),
    _text("role_type", 50),
    _text("source", 100),
    *_kind("url", "source_url"),
    *_kind("date", "created_at"),
]
_PATENT = [
    *_kind("numeric", "patent_id"),
    _OWNER,
    _text("patent_number", 100, required=True),
    _text("patent_type", 100),
    _text("title"),
    _text("inventors"),
    *_kind("year", "filing_year"),
    *_kind("boolean", "indian_jurisdiction", "foreign_jurisdiction"),
    _text("jurisdiction_list"),
    _text("source", 100),
    *_kind("url", "source_url"),
    *_kind("date", "created_at"),
]
_PUBLICATION = [
    *_kind("numeric", "publication_id"),
    _OWNER,
    *_kind("numeric", "pubmed_id"),
    _text("title"),
    _text("journal", 255),
    *_kind("year", "publication_year"),
    _text("citation_text"),
    _text("source", 100),
    *_kind("url", "source_url"),
    *_kind("date", "created_at"),
]
_PRODUCT = [
    *_kind("numeric", "product_id"),
    _OWNER,
    _text("product_name", 255),
    _text("development_stage", 100),
    _text("source", 100),
    *_kind("url", "source_url"),
    *_kind("date", "created_at"),
]
_FUNDING = [
    *_kind("numeric", "funding_id"),
    _OWNER,
    _text("stage", 20),
    *_kind("numeric", "amount_inr"),
    _text("source_name"),
    _text("source_type", 20),
    _text("funding_type", 10),
    *_kind("date", "announced_date"),
    _text("data_source", 100),
    *_kind("url", "source_url"),
    *_kind("date", "created_at", "updated_at"),
]
_NEWS = [
    *_kind("numeric", "news_id"),
    _OWNER,
    _text("headline"),
    *_kind("date", "published_date"),
    _text("news_category", 100),
    *_kind("url", "article_url"),
    *_kind("date", "scraped_at"),
]
_LOG = [
    *_kind("numeric", "log_id"),
    _OWNER,
    _text("data_type", 100),
    _text("extraction_status", 50),
    *_kind("numeric", "records_found"),
    _text("error_message"),
    *_kind("url", "source_url"),
    *_kind("date", "extracted_at"),
]

# The eleven named sets; plural names mean the same rules.
RULE_SETS: dict[str, list[FieldRule]] = {
    "company": _COMPANY,
    "person": _PERSON,
    "people": _PERSON,
    "patent": _PATENT,
    "patents": _PATENT,
    "publication": _PUBLICATION,
    "product": _PRODUCT,
    "products_services": _PRODUCT,
    "funding": _FUNDING,
    "news_coverage": _NEWS,
    "extraction_log": _LOG,
}
# Payload names that are not names of a set, and the name under which each
# payload's threshold is kept.
RULE_SET_ALIASES = {"publications": "publication", "funding_rounds": "funding", "news": "news_coverage"}
THRESHOLD_ALIASES = {
    "people": "person",
    "patents": "patent",
    "publications": "publication",
    "products_services": "product",
    "news_coverage": "news",
    "funding_rounds": "funding",
}
THRESHOLDS = {
    "company": 0.6,
    "person": 0.8,
    "patent": 0.7,
    "publication": 0.7,
    "product": 0.8,
    "news": 0.9,
    "funding": 0.7,
}
DEFAULT_THRESHOLD = 0.7
CRITICAL_FIELDS = ("registered_name", "website_url")
ERRORS_THAT_RECOMMEND, ERRORS_THAT_REJECT = 10, 20
LOW_SCORE, REJECT_COMPANY_SCORE = 0.5, 0.3

SEVERITIES = ("info", "warning", "error", "critical")
MESSAGES = {
    "missing": "Required field {field} is missing",
    "empty": "Optional field is empty",
    "no_string": "Expected string, got {type}",
    "too_short": "String too short (min: {limit}, got: {got})",
    "too_long": "String too long (max: {limit}, got: {got})",
    "no_match": "String doesn't match required pattern",
    "string_ok": "Valid string",
    "no_string_url": "Expected string URL, got {type}",
    "no_scheme": "URL missing protocol",
    "bad_url": "Invalid URL format",
    "url_ok": "Valid URL",
    "no_string_number": "Expected string CIN, got {type}",
    "number_length": "CIN must be 21 characters long, got {got}",
    "bad_number": "Invalid CIN format",
    "number_ok": "Valid CIN",
    "date_ok": "Valid date",
    "date_text_ok": "Valid date string",
    "bad_date": "Cannot parse date string",
    "no_date": "Expected date, got {type}",
    # texts of the typed set only
    "no_number": "Expected a number",
    "numeric_ok": "Valid number",
    "bad_year": "Expected a year of four digits",
    "year_ok": "Valid year",
    "no_boolean": "Expected a boolean",
    "boolean_ok": "Valid boolean",
}
ADVICE = {
    "below": "{type} quality score ({score}) below threshold ({threshold})",
    "many_errors": "High error count detected. Consider reviewing data extraction logic.",
    "low_quality": "Low quality data detected in: {types}. Consider improving extraction methods.",
    "critical": "Critical field '{field}' has issues: {message}",
}


def rule_set(entity_type: str, style: str = "typed") -> list[FieldRule]:
    """Rules of a set by its name or a payload's name, in the given style."""
    if style not in ("typed", "observed"):
        raise ValueError(f"unknown rule style {style!r}")
    name = RULE_SET_ALIASES.get(entity_type, entity_type)
    if name not in RULE_SETS:
        raise ValueError(f"Unknown entity type: {entity_type}")
    rules = RULE_SETS[name]
    return rules if style == "typed" else [_observed(r) for r in rules]


def type_error(name: Column) -> Column:
    """What is wrong with the name of a rule set, or null."""
    known = name.isin(*RULE_SETS, *RULE_SET_ALIASES)
    return F.when(~F.coalesce(known, F.lit(False)), F.concat(F.lit("Unknown entity type: "), F.coalesce(name, F.lit(""))))


def _observed(rule: FieldRule) -> FieldRule:
    """Plain fields as limited text; a year is text of four digits."""
    if rule.kind == "year":
        return FieldRule(rule.field, "string", rule.required, 4, 0, YEAR_PATTERN)
    if rule.kind in ("string", "numeric", "boolean"):
        return FieldRule(rule.field, "string", rule.required, rule.max_length or DEFAULT_TEXT_LIMIT)
    return rule


def threshold_of(entity_type: str, thresholds: dict[str, float] = THRESHOLDS) -> float:
    for name in (entity_type, THRESHOLD_ALIASES.get(entity_type)):
        if name in thresholds:
            return thresholds[name]
    return DEFAULT_THRESHOLD
