"""Observations to scored and gated company rows: the core of the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.operators.consolidate import VOTED_FIELDS, consolidate
from quorate.operators.payloads import company_rows
from quorate.operators.rules import threshold_of
from quorate.operators.validate import with_counts


def consolidated_companies(entities: DataFrame, observations: DataFrame, style: str = "typed") -> DataFrame:
    """Vote, completeness, company rows, rule score and threshold gate.

    An entity is one row here, so its score is computed in place: after the
    vote and the join nothing is shuffled again.
    """
    companies = company_rows(entities, consolidate(observations, ["entity_id"], VOTED_FIELDS))
    score = F.col("valid_fields") / F.col("fields")
    return with_counts(companies, "company", style).select(
        *companies.columns, score.alias("rule_score"), (score >= threshold_of("company")).alias("is_valid")
    )
