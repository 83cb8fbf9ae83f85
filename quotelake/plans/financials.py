"""Financial statements: text cleaning, typed staging with ratios, facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.measures import positive_ratio, surrogate_key
from quotelake.functions.text import (
    fiscal_quarter_label,
    fiscal_year_number,
    normalize_key,
    parse_magnitude,
    quarter_start,
    strip_signs,
    try_double,
)
from quotelake.operators.incremental import newer_than_target
from quotelake.operators.latest import latest_by
from quotelake.operators.lookups import enrich
from quotelake.schemas import STATEMENT_METRICS
from quotelake.sources.bronze import INGEST_SYMBOL, members

MONEY_METRICS = tuple(m for m in STATEMENT_METRICS if m not in ("eps", "gross_profit"))


def trimmed_statements(financial_text: DataFrame) -> DataFrame:
    """Statement rows with text trimmed and the quarter split; metrics stay text."""
    return financial_text.select(
        "company_id",
        normalize_key("symbol").alias("symbol"),
        F.trim("quarter").alias("raw_quarter"),
        fiscal_quarter_label("quarter").alias("fiscal_quarter"),
        fiscal_year_number("quarter").alias("fiscal_year"),
        *[F.trim(name).alias(name) for name in STATEMENT_METRICS],
    )


def staged_financials(
    finance_raw: DataFrame, companies: DataFrame, target: DataFrame | None = None
) -> DataFrame:
    """Typed statements with company attributes and ratios; key (symbol, quarter).

    Metrics are display text such as ``1.2 B`` or plain numbers.
    ``debt_to_asset_ratio`` is assets over liabilities, as the source defines it.
    """
    text = members(
        finance_raw,
        [INGEST_SYMBOL, "symbol", "quarter", "fiscal_year", "fiscal_quarter", *STATEMENT_METRICS],
        keep=["load_ts"],
        also={"quarter": "Quarter"},
    )
    typed = text.select(
        F.coalesce(INGEST_SYMBOL, "symbol").alias("symbol"),
        F.coalesce(quarter_start("quarter"), F.col("quarter").try_cast("date")).alias("quarter"),
        *[F.col(name).try_cast("int").alias(name) for name in ("fiscal_year", "fiscal_quarter")],
        *[
            (try_double(strip_signs(name)) if name == "eps" else parse_magnitude(name))
            .cast("double")
            .alias(name)
            for name in STATEMENT_METRICS
        ],
        F.col("load_ts").alias("ingested_at"),
    ).filter(F.col("quarter").isNotNull())
    if target is not None:
        typed = newer_than_target(typed, target, "ingested_at")
    single = latest_by(typed, ["symbol", "quarter"], ["ingested_at"])
    return financial_ratios(enrich(single, companies, "symbol", ["company_name", "sector"]))


def financial_ratios(rows: DataFrame) -> DataFrame:
    """Metrics with 0 for missing, and margins in percent.

    Without revenue the gross margin is 0, the other ratios are null.
    """
    revenue, net = F.col("total_revenue"), F.col("net_income")
    assets, debts = F.col("total_assets"), F.col("total_liabilities")
    zero = F.lit(0.0)
    gross = F.coalesce("gross_profit", zero)
    return rows.select(
        "symbol",
        "company_name",
        "sector",
        "quarter",
        "fiscal_year",
        "fiscal_quarter",
        *[F.coalesce(name, zero).alias(name) for name in STATEMENT_METRICS],
        F.coalesce(positive_ratio(gross, revenue, 100), zero).alias("gross_margin_pct"),
        positive_ratio(net, revenue, 100).alias("net_margin_pct"),
        positive_ratio(net, assets, 100).alias("roa_pct"),
        positive_ratio(assets, debts).alias("debt_to_asset_ratio"),
        "ingested_at",
    )


def text_financials(finance_raw: DataFrame) -> DataFrame:
    """Statement rows whose cells are display text such as ``1.2 B``, as numbers."""
    text = members(
        finance_raw,
        ["symbol", INGEST_SYMBOL, "quarter", "eps", *MONEY_METRICS],
        keep=["file_name", "load_ts"],
        also={"quarter": "Quarter"},
    )
    return text.select(
        F.coalesce("symbol", INGEST_SYMBOL).alias("symbol"),
        quarter_start("quarter").alias("quarter_date"),
        *[parse_magnitude(name).alias(name) for name in MONEY_METRICS],
        try_double(strip_signs("eps")).alias("eps"),
        "file_name",
        "load_ts",
    )


def financial_facts(statements: DataFrame) -> DataFrame:
    """Dated statements with a surrogate key."""
    return statements.filter(F.col("quarter_date").isNotNull()).withColumn(
        "financial_id", surrogate_key("symbol", "quarter_date")
    )


def price_facts(prices: DataFrame) -> DataFrame:
    """Dated prices with a surrogate key."""
    return (
        prices.filter(F.col("date").isNotNull())
        .drop("last_day_raw")
        .withColumn("price_id", surrogate_key("symbol", "date"))
    )
