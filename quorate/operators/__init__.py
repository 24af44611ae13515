"""Operators: DataFrame in, DataFrame out."""

from quorate.operators.accounting import extraction_log, run_summary, run_version, source_counts
from quorate.operators.bundle import extract_bundle
from quorate.operators.consolidate import completeness, consolidate, dedupe_first, observe
from quorate.operators.export import export_tables
from quorate.operators.feeds import explode_feed, top_per_entity, with_fallback
from quorate.operators.html_sections import extract_sections, extract_titles
from quorate.operators.load import cascade_delete, check_constraints, new_rows, replace_children, upsert
from quorate.operators.profiles import parse_profiles
from quorate.operators.prompts import build_prompts
from quorate.operators.report import gate, profile_report, report_from_counts, should_reject
from quorate.operators.standardize import Rule, standardize
from quorate.operators.validate import apply_suggestions, row_validity, validate

__all__ = [
    "Rule",
    "apply_suggestions",
    "build_prompts",
    "cascade_delete",
    "check_constraints",
    "completeness",
    "consolidate",
    "dedupe_first",
    "explode_feed",
    "export_tables",
    "extract_bundle",
    "extract_sections",
    "extract_titles",
    "extraction_log",
    "gate",
    "new_rows",
    "observe",
    "parse_profiles",
    "profile_report",
    "replace_children",
    "report_from_counts",
    "row_validity",
    "run_summary",
    "run_version",
    "should_reject",
    "source_counts",
    "standardize",
    "top_per_entity",
    "upsert",
    "validate",
    "with_fallback",
]
