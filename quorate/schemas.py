"""Declared schemas of the target tables, as data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

ENTITY_KEY = "big_award_id"


@dataclass(frozen=True)
class TableSpec:
    """A target table: columns, keys and column defaults.

    ``defaults`` maps a column to its literal; the value ``"now"`` stands for
    the load time, which the caller passes in once per run. ``mode`` says how
    a batch is taken: ``upsert`` by the natural key, ``replace`` all rows of
    the batch's parents, or ``append``. ``parent_key`` names the parent's key;
    None for a table without a parent.
    """

    name: str
    ddl: str
    primary_key: str
    natural_key: str | None = None
    mode: str = "append"
    parent_key: str | None = ENTITY_KEY
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# Table, column and limit names of the target model.
COMPANIES = TableSpec(
    "companies",
    "big_award_id STRING, registered_name STRING, original_awardee STRING, big_award_year SMALLINT, "
    "website_url STRING, cin STRING, incorporation_date DATE, location STRING, mca_status STRING, "
    "data_quality_score DECIMAL(3,2), created_at TIMESTAMP, updated_at TIMESTAMP",
    primary_key="big_award_id",
    natural_key="big_award_id",
    mode="upsert",
    parent_key=None,
    not_null=("big_award_id", "registered_name"),
    unique=("big_award_id", "cin"),
    max_length={"big_award_id": 50, "registered_name": 255, "original_awardee": 255, "cin": 50, "mca_status": 50},
    defaults={"data_quality_score": 0, "created_at": "now", "updated_at": "now"},
)
PEOPLE = TableSpec(
    "people",
    "person_id BIGINT, big_award_id STRING, full_name STRING, designation STRING, role_type STRING, "
    "source STRING, source_url STRING, created_at TIMESTAMP",
    primary_key="person_id",
    mode="replace",
    not_null=("full_name",),
    max_length={"full_name": 255, "designation": 255, "role_type": 50, "source": 100},
    defaults={"created_at": "now"},
)
PATENTS = TableSpec(
    "patents",
    "patent_id BIGINT, big_award_id STRING, patent_number STRING, patent_type STRING, title STRING, "
    "inventors STRING, filing_year SMALLINT, indian_jurisdiction BOOLEAN, foreign_jurisdiction BOOLEAN, "
    "jurisdiction_list STRING, source STRING, source_url STRING, created_at TIMESTAMP",
    primary_key="patent_id",
    natural_key="patent_number",
    mode="upsert",
    not_null=("patent_number",),
    unique=("patent_number",),
    max_length={"patent_number": 100, "patent_type": 100, "source": 100},
    defaults={"indian_jurisdiction": False, "foreign_jurisdiction": False, "created_at": "now"},
)
PUBLICATIONS = TableSpec(
    "publications",
    "publication_id BIGINT, big_award_id STRING, pubmed_id INT, title STRING, journal STRING, "
    "publication_year SMALLINT, citation_text STRING, source STRING, source_url STRING, created_at TIMESTAMP",
    primary_key="publication_id",
    natural_key="pubmed_id",
    mode="upsert",
    unique=("pubmed_id",),
    max_length={"journal": 255},
    defaults={"created_at": "now"},
)
PRODUCTS = TableSpec(
    "products_services",
    "product_id BIGINT, big_award_id STRING, product_name STRING, development_stage STRING, source STRING, "
    "source_url STRING, created_at TIMESTAMP",
    primary_key="product_id",
    mode="replace",
    max_length={"product_name": 255, "development_stage": 100},
    defaults={"created_at": "now"},
)
FUNDING = TableSpec(
    "funding_rounds",
    "funding_id BIGINT, big_award_id STRING, stage STRING, amount_inr DECIMAL(18,2), source_name STRING, "
    "source_type STRING, funding_type STRING, announced_date DATE, data_source STRING, source_url STRING, "
    "created_at TIMESTAMP, updated_at TIMESTAMP",
    primary_key="funding_id",
    max_length={"stage": 20, "source_type": 20, "funding_type": 10, "data_source": 100},
    defaults={"created_at": "now", "updated_at": "now"},
)
NEWS = TableSpec(
    "news_coverage",
    "news_id BIGINT, big_award_id STRING, headline STRING, published_date DATE, news_category STRING, "
    "article_url STRING, scraped_at TIMESTAMP",
    primary_key="news_id",
    max_length={"news_category": 100},
    defaults={"scraped_at": "now"},
)
EXTRACTION_LOG = TableSpec(
    "extraction_log",
    "log_id BIGINT, big_award_id STRING, data_type STRING, extraction_status STRING, records_found INT, "
    "error_message STRING, source_url STRING, extracted_at TIMESTAMP",
    primary_key="log_id",
    max_length={"data_type": 100, "extraction_status": 50},
    defaults={"records_found": 0, "extracted_at": "now"},
)

TABLES = {
    t.name: t
    for t in (COMPANIES, PEOPLE, PATENTS, PUBLICATIONS, PRODUCTS, FUNDING, NEWS, EXTRACTION_LOG)
}
CHILD_TABLES = tuple(name for name in TABLES if name != "companies")

# Payload keys in build order and the table each one loads into.
PAYLOAD_TABLES = {
    "company": "companies",
    "people": "people",
    "products_services": "products_services",
    "patents": "patents",
    "publications": "publications",
    "funding_rounds": "funding_rounds",
    "news_coverage": "news_coverage",
}
