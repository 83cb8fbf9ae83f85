"""Company tables: staging, market statistics, the company dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.text import location_key, normalize_key
from quotelake.operators.incremental import newer_than_target
from quotelake.operators.latest import latest_by
from quotelake.sources.bronze import members

UNKNOWN = "Unknown"
TEXT_ATTRIBUTES = (
    "symbol", "company_name", "currency", "sector", "industry", "ceo_name", "website",
    "headquarters", "founded_date", "isin", "logo_url",
)


def staged_companies(companies_raw: DataFrame) -> DataFrame:
    """Latest raw row per symbol with defaults for name, sector and market cap."""
    text = members(
        companies_raw,
        ["symbol", "company_name", "sector", "market_cap", "logo_url"],
        keep=["load_ts"],
    )
    typed = text.filter(F.col("symbol").isNotNull()).select(
        "symbol",
        F.coalesce("company_name", F.lit("Unknown Company")).alias("company_name"),
        F.coalesce("sector", F.lit("Unclassified")).alias("sector"),
        F.coalesce(F.col("market_cap").try_cast("double"), F.lit(0.0)).alias("market_cap"),
        "logo_url",
        F.col("load_ts").alias("created_at"),
    )
    return latest_by(typed, ["symbol"], ["created_at"])


def completed_companies(company: DataFrame) -> DataFrame:
    """Company master with ``Unknown`` for missing text and inactive as default.

    A missing founding date reads ``unknown`` in lower case.
    """
    present = set(company.columns)
    columns = ["company_id"]
    for name in TEXT_ATTRIBUTES:
        value = F.col(name) if name in present else F.lit(None).cast("string")
        default = "unknown" if name == "founded_date" else UNKNOWN
        columns.append(F.coalesce(value.cast("string"), F.lit(default)).alias(name))
    columns.append(F.coalesce("is_active", F.lit(False)).alias("is_active"))
    return company.select(*columns, "created_at", "updated_at")


def company_attributes(companies_raw: DataFrame) -> DataFrame:
    """Raw company rows as text columns, one per row read."""
    names = [n for n in TEXT_ATTRIBUTES if n != "logo_url"]
    return members(companies_raw, names, keep=["file_name", "load_ts"])


def market_stats(
    stats: DataFrame, company: DataFrame, target: DataFrame | None = None
) -> DataFrame:
    """Market statistics of known companies; the company's sector wins over the market's."""
    if target is not None:
        stats = newer_than_target(
            stats.withColumnRenamed("created_at", "ingested_at"), target, "ingested_at"
        )
    else:
        stats = stats.withColumnRenamed("created_at", "ingested_at")
    known = company.select(
        "company_id", "symbol", "company_name", F.col("sector").alias("company_sector")
    )
    return (
        stats.withColumnRenamed("sector", "market_sector")
        .join(known, "company_id")
        .select(
            "stat_id", "company_id", "symbol", "company_name", "company_sector",
            "snapshot_datetime", "price", "change_pct", "volume", "relative_volume", "market_cap",
            "pe_ratio", "eps_ttm", "eps_growth_yoy", "div_yield_pct", "market_sector",
            "analyst_rating",
            F.coalesce("company_sector", "market_sector").alias("effective_sector"),
            "ingested_at",
        )
    )


def company_dimension(company: DataFrame, stats: DataFrame, prices: DataFrame) -> DataFrame:
    """Company with its newest market statistics and the span of its prices."""
    newest = latest_by(
        stats.select(
            "company_id",
            "snapshot_datetime",
            "stat_id",
            F.col("price").alias("latest_price"),
            F.col("change_pct").alias("latest_change_pct"),
            F.col("market_cap").alias("latest_market_cap"),
            "pe_ratio",
            "eps_ttm",
            "div_yield_pct",
            "effective_sector",
            F.col("analyst_rating").alias("market_analyst_rating"),
        ),
        ["company_id"],
        ["snapshot_datetime", "stat_id"],
    )
    span = prices.groupBy("symbol").agg(
        F.max("trade_date").alias("latest_price_date"),
        F.countDistinct("trade_date").alias("trading_days_available"),
    )
    return (
        company.drop("market_cap")
        .join(span, "symbol", "left")
        .join(newest, "company_id", "left")
        .select(
            "company_id",
            "symbol",
            "company_name",
            F.coalesce("effective_sector", "sector").alias("sector"),
            "industry",
            "latest_price",
            "latest_change_pct",
            F.col("latest_market_cap").alias("market_cap"),
            "pe_ratio",
            "eps_ttm",
            "div_yield_pct",
            F.coalesce("market_analyst_rating", "analyst_rating").alias("analyst_rating"),
            "logo_url",
            "latest_price_date",
            "trading_days_available",
            "is_active",
            F.col("snapshot_datetime").alias("latest_market_data_at"),
            F.col("created_at").alias("ingested_at"),
            F.col("updated_at").alias("company_last_updated"),
        )
    )


def company_star(
    companies: DataFrame,
    currency: DataFrame,
    sector: DataFrame,
    industry: DataFrame,
    location: DataFrame,
) -> DataFrame:
    """Company with the ids of four text dimensions; unknown text gives a null id."""
    lookups: Sequence = (
        (normalize_key("currency"), currency, "currency_code", "currency_id"),
        (normalize_key("sector"), sector, "sector_name", "sector_id"),
        (normalize_key("industry"), industry, "industry_name", "industry_id"),
        (location_key("headquarters"), location, "location_name", "location_id"),
    )
    joined = companies
    for key, dimension, name, identity in lookups:
        pairs = dimension.select(F.col(name).alias("_name"), identity)
        joined = joined.join(pairs, key == F.col("_name"), "left").drop("_name")
    return joined.select(
        "symbol", "company_name", "currency_id", "sector_id", "industry_id", "location_id",
        "ceo_name", "website", "founded_date", "isin",
    )
