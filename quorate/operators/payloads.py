"""Rows of the seven payload tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorate import functions as fn
from quorate.operators.consolidate import VOTED_FIELDS, completeness
from quorate.schemas import ENTITY_KEY, PATENTS

# Tags that stored rows carry.
PROFILE_TAG = "AI Agent"
SITE_TAG = "Website"
SITE_ROLES = {"team": "Core Team", "advisors": "Advisor"}


def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _number(text: str, kind: str) -> Column:
    return F.col(text).cast("string").try_cast(kind)


def company_rows(entities: DataFrame, voted: DataFrame) -> DataFrame:
    """Every listed entity with its voted fields, each cleaned by its rule. The
    score counts the voted values before cleaning."""
    raw = F.col
    return entities.join(voted, "entity_id", "left").select(
        raw("entity_id").alias(ENTITY_KEY),
        fn.clean_name(raw("entity_name")).alias("registered_name"),
        raw("original_awardee"),
        raw("grant_year").cast("smallint").alias("big_award_year"),
        fn.clean_url(raw("website_url")).alias("website_url"),
        fn.clean_number(raw("cin")).alias("cin"),
        fn.parse_date(raw("incorporation_date")).alias("incorporation_date"),
        fn.clean_location(raw("location")).alias("location"),
        raw("mca_status"),
        completeness(VOTED_FIELDS).alias("data_quality_score"),
        *([raw("ordinal").cast("bigint").alias("ordinal")] if "ordinal" in entities.columns else []),
    )


def people_rows(founders: DataFrame, sections: DataFrame, site_urls: DataFrame | None = None) -> DataFrame:
    """Founders of the profiles, team and advisors of the sites."""
    own = founders.select(
        F.col("entity_id").alias(ENTITY_KEY),
        "full_name",
        "designation",
        "role_type",
        F.lit(PROFILE_TAG).alias("source"),
        _null().alias("source_url"),
        F.col("ordinal").cast("bigint").alias("ordinal"),
    )
    role = reduce(
        lambda chain, item: chain.when(F.col("section") == item[0], item[1]),
        list(SITE_ROLES.items())[1:],
        F.when(F.col("section") == list(SITE_ROLES)[0], list(SITE_ROLES.values())[0]),
    )
    site = _with_site_url(sections.where(F.col("section").isin(list(SITE_ROLES))), site_urls).select(
        F.col("entity_id").alias(ENTITY_KEY),
        fn.clean_name(F.col("text")).alias("full_name"),
        _null().alias("designation"),
        role.alias("role_type"),
        F.lit(SITE_TAG).alias("source"),
        "source_url",
        F.col("ordinal").cast("bigint").alias("ordinal"),
    )
    return own.unionByName(site)


def _with_site_url(sections: DataFrame, site_urls: DataFrame | None) -> DataFrame:
    """Site rows carry the address they were read from, where it is known."""
    if site_urls is None:
        return sections.withColumn("source_url", _null())
    return sections.join(site_urls.select("entity_id", "source_url"), "entity_id", "left")


def product_rows(sections: DataFrame, site_urls: DataFrame | None = None) -> DataFrame:
    return _with_site_url(sections.where(F.col("section") == "products"), site_urls).select(
        F.col("entity_id").alias(ENTITY_KEY),
        F.col("text").alias("product_name"),
        _null().alias("development_stage"),
        F.lit(SITE_TAG).alias("source"),
        "source_url",
        F.col("ordinal").cast("bigint").alias("ordinal"),
    )


def patent_rows(
    from_json: DataFrame, from_html: DataFrame, sections: DataFrame, site_urls: DataFrame | None = None
) -> DataFrame:
    """Patents of the search feed, of its HTML form and of the sites."""
    order = F.col("ordinal").cast("bigint").alias("ordinal")
    columns = [c for c in PATENTS.columns if c not in (PATENTS.primary_key, "created_at")]

    def shaped(rows: DataFrame, **given: Column) -> DataFrame:
        kinds = {f.name: f.dataType.simpleString() for f in PATENTS.schema}
        fixed = {"indian_jurisdiction": F.lit(False), "foreign_jurisdiction": F.lit(False)}
        return rows.select(*[(given.get(c) if c in given else fixed.get(c, _null(kinds[c]))).alias(c) for c in columns], order)

    entity = F.col("entity_id")
    feed = shaped(
        from_json,
        big_award_id=entity,
        filing_year=_number("filing_year", "smallint"),
        **{c: F.col(c) for c in ("patent_number", "title", "inventors", "jurisdiction_list", "source", "source_url")},
    )
    address = {"source_url": F.col("source_url")} if "source_url" in from_html.columns else {}
    titles = shaped(from_html, big_award_id=entity, title=F.col("title"), source=F.col("source"), **address)
    site = shaped(
        _with_site_url(sections.where(F.col("section") == "patents"), site_urls),
        big_award_id=entity,
        patent_number=F.col("text"),
        source=F.lit(SITE_TAG),
        source_url=F.col("source_url"),
    )
    return feed.unionByName(titles).unionByName(site)


def publication_rows(from_json: DataFrame, sections: DataFrame, site_urls: DataFrame | None = None) -> DataFrame:
    feed = from_json.select(
        F.col("entity_id").alias(ENTITY_KEY),
        _number("pubmed_id", "int").alias("pubmed_id"),
        "title",
        "journal",
        _number("publication_year", "smallint").alias("publication_year"),
        "citation_text",
        "source",
        "source_url",
        F.col("ordinal").cast("bigint").alias("ordinal"),
    )
    site = _with_site_url(sections.where(F.col("section") == "publications"), site_urls).select(
        F.col("entity_id").alias(ENTITY_KEY),
        _null("int").alias("pubmed_id"),
        F.col("text").alias("title"),
        _null().alias("journal"),
        _null("smallint").alias("publication_year"),
        _null().alias("citation_text"),
        F.lit(SITE_TAG).alias("source"),
        "source_url",
        F.col("ordinal").cast("bigint").alias("ordinal"),
    )
    return feed.unionByName(site)


def explode_founders(profiles: DataFrame, rank: str = "source_rank") -> DataFrame:
    """Founder rows of all profiles, with the rank of their source and place."""
    # The outer form, as the inner one would put a filter that makes the list
    # once more below the generator.
    rows = profiles.select("entity_id", rank, F.posexplode_outer("founders").alias("ordinal", "_founder"))
    return rows.where(F.col("ordinal").isNotNull()).select("entity_id", rank, "ordinal", "_founder.*")


def funding_rows(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Funding rounds of the profiles and the rounds that were not usable.

    A round is rejected when it is no object, or when its amount is given and
    cannot be read; a round without an amount stays, with none. Whoever needs
    both tables should stage ``marked_rounds`` and split that.
    """
    return split_rounds(marked_rounds(profiles))


def split_rounds(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = marked.where("reason is null").drop("reason", "raw")
    return rows, marked.where("reason is not null").select(ENTITY_KEY, "ordinal", "reason", "raw")


def marked_rounds(profiles: DataFrame) -> DataFrame:
    """All rounds, read once: the row's columns, ``reason`` where it can't be
    used, and then its text as ``raw``."""
    rounds = profiles.select("entity_id", F.posexplode("funding_rounds").alias("ordinal", "_round"))
    amount = F.try_variant_get("_round.amount_inr", "$", "string")
    # An empty text or the number zero counts as not given; the text "0" is zero.
    kind = F.schema_of_variant("_round.amount_inr")
    not_given = (amount == "") | ((amount == "0") & (kind != "STRING"))
    given = F.coalesce(F.when(~not_given, amount), F.col("_round.amount"))
    # By way of generators, here and below: the amount's text is looked at in
    # several places, which would each read it again.
    rounds = rounds.select("entity_id", "ordinal", "_round", F.explode(F.array(given)).alias("_given"))
    given = F.col("_given")
    read = rounds.select(
        F.col("entity_id").alias(ENTITY_KEY),
        F.col("_round.stage").alias("stage"),
        F.explode(F.array(fn.parse_amount(given))).alias("amount_inr"),
        F.col("_round.source_name").alias("source_name"),
        F.col("_round.source_type").alias("source_type"),
        F.col("_round.funding_type").alias("funding_type"),
        fn.parse_date(F.col("_round.announced_date")).alias("announced_date"),
        F.lit(PROFILE_TAG).alias("data_source"),
        F.col("_round.source_url").alias("source_url"),
        F.col("ordinal").cast("bigint").alias("ordinal"),
        given,
        F.col("_round").alias("_round"),
    )
    item = F.col("_round._item")
    no_object = F.col("_round").isNull() | ~F.coalesce(F.schema_of_variant(item).startswith("OBJECT"), F.lit(True))
    bad = F.when(no_object, "round is no object").when(
        fn.is_filled(F.col("_given")) & F.col("amount_inr").isNull(), "amount cannot be read"
    )
    text = F.coalesce(F.to_json(item), F.to_json("_round"))
    return read.withColumn("reason", bad).withColumn("raw", F.when(F.col("reason").isNotNull(), text)).drop("_round", "_given")


def news_rows(news: DataFrame, load_date: Column) -> DataFrame:
    return news.select(
        F.col("entity_id").alias(ENTITY_KEY),
        "headline",
        "published_date",
        "news_category",
        "article_url",
        load_date.cast("timestamp").alias("scraped_at"),
        F.col("ordinal").cast("bigint").alias("ordinal"),
    )


def with_surrogate_id(df: DataFrame, id_column: str, natural: list[str], ordinal: str = "ordinal") -> DataFrame:
    """A stable id from what a row says and its place, equal in every rerun."""
    return df.withColumn(id_column, F.xxhash64(*natural, ordinal))


def records_per_entity(payloads: dict[str, DataFrame], key: str = ENTITY_KEY) -> DataFrame:
    """Rows over all payload tables per entity: one shuffle, of counters."""
    keys = [df.select(key) for df in payloads.values()]
    return reduce(DataFrame.unionByName, keys).groupBy(key).agg(F.count("*").alias("records"))


