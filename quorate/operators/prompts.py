"""Prompt table for any batch inference system."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.functions import strip

# The wording is ours and a parameter; the JSON keys are those that
# ``profiles.parse_profiles`` reads. ``{name}`` is replaced by the entity name.
PROMPT_TEMPLATE = """Collect what is known about the organisation "{name}".

Answer with one JSON object and nothing else, shaped like this:
{
    "website_url": "...",
    "founders": [{"full_name": "...", "designation": "...", "role_type": "Founder"}],
    "cin": "...",
    "incorporation_date": "YYYY-MM-DD",
    "location": "...",
    "original_awardee": "...",
    "mca_status": "...",
    "products_services": [{"product_name": "...", "development_stage": "..."}],
    "funding_rounds": [{"stage": "...", "amount_inr": 0, "source_name": "...",
                        "source_type": "...", "funding_type": "...", "announced_date": "YYYY-MM-DD"}]
}

Organisation: "{name}"
JSON:
"""


def build_prompts(
    df: DataFrame, name: str, custom: str | None = None, template: str = PROMPT_TEMPLATE
) -> tuple[DataFrame, DataFrame]:
    """Add ``prompt`` to every row with a name; a non-empty custom prompt wins.
    Rows without a name come back as rejects."""
    bare = strip(F.col(name))
    has_name = F.coalesce(bare != "", F.lit(False))
    pieces = []
    for i, part in enumerate(template.split("{name}")):
        pieces += ([bare] if i else []) + [F.lit(part)]
    prompt = F.concat(*pieces)
    if custom:
        prompt = F.coalesce(F.nullif(F.col(custom), F.lit("")), prompt)
    return df.where(has_name).withColumn("prompt", prompt), df.where(~has_name)
