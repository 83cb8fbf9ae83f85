"""Typed loaders: rows of known files to normalized tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake import schemas
from quotelake.functions.text import clean_numeric, normalize_key, parse_volume
from quotelake.operators.incremental import merge_columns, without_keys
from quotelake.operators.latest import latest_by
from quotelake.operators.lookups import resolve, unmatched
from quotelake.operators.stable_ids import append_batch, continue_ids
from quotelake.session import scratch_path

# The source tag of batch prices, and the three index rows.
BATCH_SOURCE = "BATCH_S3"
INDEX_ROWS = (
    (1, "EGX30", "EGX 30 Index", "Top 30 most liquid and active stocks", True),
    (2, "EGX70", "EGX 70 EWI", "Equally Weighted Index of 70 stocks", True),
    (3, "EGX100", "EGX 100", "Top 100 stocks by liquidity", True),
)
EQUAL, UNWEIGHTED = "equal", "none"
PRICE_KEY = ("company_id", "trade_date", "data_source")


class MissingColumns(ValueError):
    """A file lacks columns its table needs."""


def require_columns(
    df: DataFrame, required: Sequence[str], defaults: dict[str, object] | None = None
) -> DataFrame:
    """Check required columns, and add optional ones with their default."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing {missing}, found {df.columns}")
    for name, value in (defaults or {}).items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    return df


def index_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(INDEX_ROWS), schemas.INDEX)


def upsert_companies(
    company: DataFrame,
    updates: DataFrame,
    order: Sequence[str],
    created_at: datetime | Column | None = None,
) -> DataFrame:
    """Merge name, sector and market cap by symbol; of repeated symbols the latest counts.

    New companies are numbered in the order of their symbols, after the greatest
    id; they are active, and created and updated at ``created_at``.
    """
    columns = ["company_name", "sector", "market_cap"]
    checked = require_columns(
        updates, ["symbol", "company_name"], {"sector": "Unknown", "market_cap": 0}
    )
    spark, path = company.sparkSession, scratch_path(company.sparkSession, "companies")
    latest_by(checked, ["symbol"], order).select("symbol", *columns).write.parquet(path)
    source = spark.read.parquet(path)
    stamp = created_at if isinstance(created_at, Column) else F.lit(created_at)
    defaults = {"is_active": F.lit(True), "created_at": stamp, "updated_at": stamp}
    fresh = continue_ids(
        without_keys(source, company, ["symbol"]), ["symbol"], "company_id", company
    )
    added = fresh.select(
        *[
            (F.col(f.name) if f.name in fresh.columns else defaults.get(f.name, F.lit(None)))
            .cast(f.dataType)
            .alias(f.name)
            for f in company.schema.fields
        ]
    )
    return merge_columns(company, source, "symbol", columns, insert=False).unionByName(added)


def _unreadable(rows: DataFrame) -> Column:
    """Whether a price row lacks a readable day, or has a close that is no number."""
    checked = require_columns(rows, ["symbol", "trade_date", "close"])
    close = checked["close"]
    return checked["trade_date"].try_cast("date").isNull() | (
        close.isNotNull() & close.try_cast("decimal(18,4)").isNull()
    )


def rejected_prices(rows: DataFrame) -> DataFrame:
    """Price rows that cannot be loaded, as they came."""
    return rows.filter(_unreadable(rows))


def load_prices(
    rows: DataFrame, company: DataFrame, created_at: datetime | Column, source: str = BATCH_SOURCE
) -> DataFrame:
    """Daily prices with their company id; unknown symbols drop out.

    Rows of ``rejected_prices`` are left out; other unreadable cells count as missing.
    """
    rows = rows.filter(~_unreadable(rows))
    money = "decimal(18,4)"
    checked = require_columns(rows, ["symbol", "trade_date", "close"])
    absent = [c for c in ("open", "high", "low", "volume") if c not in checked.columns]
    for name in absent:
        checked = checked.withColumn(name, F.lit(None))
    close = F.col("close").try_cast(money)
    stamp = created_at if isinstance(created_at, Column) else F.lit(created_at)
    matched = resolve(checked, company, F.col("symbol"), "symbol", "company_id")
    return matched.select(
        "company_id",
        F.col("trade_date").try_cast("date").alias("trade_date"),
        F.coalesce(F.col("open").try_cast(money), close).alias("open_price"),
        F.coalesce(F.col("high").try_cast(money), close).alias("high_price"),
        F.coalesce(F.col("low").try_cast(money), close).alias("low_price"),
        close.alias("close_price"),
        F.coalesce(F.col("volume").try_cast("bigint"), F.lit(0)).alias("volume"),
        F.lit(source).alias("data_source"),
        stamp.alias("created_at"),
    )


def append_prices(
    path: str,
    batch_id: int,
    rows: DataFrame,
    company: DataFrame,
    created_at: datetime | Column,
    source: str = BATCH_SOURCE,
    latest: Sequence[str] = (),
) -> DataFrame:
    """Load daily prices as one batch of the price table; gives the table up to it.

    A company, day and source is stored once and keeps its price_id; of several
    rows in one load the latest by ``latest`` counts.
    """
    return append_batch(
        path,
        batch_id,
        load_prices(rows, company, created_at, source),
        schemas.STOCK_PRICE,
        "price_id",
        PRICE_KEY,
        PRICE_KEY,
        latest,
    )


def load_membership(
    listed: DataFrame,
    company: DataFrame,
    index_id: int | Column,
    effective: date | Column,
    weighting: str = UNWEIGHTED,
) -> DataFrame:
    """Members of one index from its list of symbols, each company once.

    The equal weight counts every listed row, matched or not.
    """
    key = normalize_key("Symbol" if "Symbol" in listed.columns else "symbol")
    weight = F.lit(None)
    rows = listed
    if weighting == EQUAL:
        size = listed.agg((F.lit(100.0) / F.count("*")).alias("w"))
        weight = size.scalar()
    matched = resolve(rows, company, key, "symbol", "company_id")
    return matched.select(
        (index_id if isinstance(index_id, Column) else F.lit(index_id)).alias("index_id"),
        "company_id",
        weight.cast("decimal(8,4)").alias("weight"),
        (effective if isinstance(effective, Column) else F.lit(effective))
        .cast("date")
        .alias("effective_date"),
        F.lit(True).alias("is_current"),
    ).dropDuplicates(["index_id", "company_id"])


def append_memberships(path: str, batch_id: int, rows: DataFrame) -> DataFrame:
    """Store members as one batch; an index and company is stored once and keeps its id."""
    key = ["index_id", "company_id"]
    return append_batch(
        path, batch_id, rows, schemas.INDEX_MEMBERSHIP, "membership_id", key, key
    )


def unlisted_symbols(listed: DataFrame, company: DataFrame) -> DataFrame:
    """Listed symbols that no company carries."""
    column = "Symbol" if "Symbol" in listed.columns else "symbol"
    keyed = listed.select(normalize_key(column).alias("symbol"))
    return unmatched(keyed, company, F.col("symbol"), "symbol").distinct()


def derive_index(
    memberships: DataFrame, index_id: int | Column, effective: date | Column
) -> DataFrame:
    """Unweighted index over the distinct companies of all given memberships."""
    return memberships.select("company_id").distinct().select(
        (index_id if isinstance(index_id, Column) else F.lit(index_id)).alias("index_id"),
        "company_id",
        F.lit(None).cast("decimal(8,4)").alias("weight"),
        (effective if isinstance(effective, Column) else F.lit(effective))
        .cast("date")
        .alias("effective_date"),
        F.lit(True).alias("is_current"),
    )


def snapshot_ticker(symbol: Column) -> Column:
    """The first word of the symbol cell in upper case, null when blank."""
    word = F.upper(F.split(F.trim(symbol), r"\s+", 2).getItem(0))
    return F.when(word != "", word)


def load_market_stats(
    rows: DataFrame, company: DataFrame, snapshot: datetime | Column
) -> DataFrame:
    """Market snapshot rows with numbers cleaned; unknown tickers drop out."""
    keyed = rows.withColumn("_ticker", snapshot_ticker(F.col("Symbol")))
    matched = resolve(keyed, company, F.col("_ticker"), "symbol", "company_id")
    stamp = snapshot if isinstance(snapshot, Column) else F.lit(snapshot)
    return matched.select(
        "company_id",
        stamp.alias("snapshot_datetime"),
        clean_numeric("Price").alias("price"),
        clean_numeric("Change %").alias("change_pct"),
        parse_volume("Volume").alias("volume"),
        clean_numeric("Rel Volume").alias("relative_volume"),
        parse_volume("Market cap").alias("market_cap"),
        clean_numeric("P/E").alias("pe_ratio"),
        clean_numeric("EPS dil TTM").alias("eps_ttm"),
        clean_numeric("EPS dil growth TTM YoY").alias("eps_growth_yoy"),
        clean_numeric("Div yield % TTM").alias("div_yield_pct"),
        F.trim("Sector").alias("sector"),
        F.trim("Analyst Rating").alias("analyst_rating"),
    )


def append_market_stats(
    path: str,
    batch_id: int,
    rows: DataFrame,
    company: DataFrame,
    snapshot: datetime | Column,
    created_at: datetime | Column,
) -> DataFrame:
    """Load a market snapshot as one batch of the statistics; every row gets a stat_id.

    Rows are numbered by time, company and then their other columns; rows that are
    alike in all of them are stored as often as they come.
    """
    stamp = created_at if isinstance(created_at, Column) else F.lit(created_at)
    # Stored, because numbering reads the rows twice and their text is dear to clean.
    spark, parsed = rows.sparkSession, scratch_path(rows.sparkSession, "market-stats")
    cleaned = load_market_stats(rows, company, snapshot)
    cleaned.write.parquet(parsed)
    loaded = spark.read.schema(cleaned.schema).parquet(parsed).withColumn("created_at", stamp)
    first = ["snapshot_datetime", "company_id"]
    order = first + [c for c in loaded.columns if c not in first]
    return append_batch(path, batch_id, loaded, schemas.MARKET_STAT, "stat_id", order)


def apply_latest_sector(company: DataFrame, stats: DataFrame) -> DataFrame:
    """Companies with the sector of their newest snapshot that names one."""
    newest = latest_by(
        stats.filter(F.col("sector").isNotNull()).select(
            "company_id", "snapshot_datetime", "sector"
        ),
        ["company_id"],
        ["snapshot_datetime"],
    )
    return merge_columns(company, newest, "company_id", ["sector"], insert=False)
