"""Recent files of a drop folder, routed to their tables and loaded in one job.

A file that cannot be loaded is reported and left out; the others are loaded. The
files are parsed once; tables are kept per batch, so a repeated job replaces what
it wrote and gives the same ids.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake import schemas
from quotelake.operators.stable_ids import BATCH, read_batches
from quotelake.session import scratch_path
from quotelake.sources.files import FILE_NAME, route
from quotelake.sources.ingest import file_cells
from quotelake.sources.loaders import append_prices, rejected_prices, upsert_companies

# Columns a file needs before it can feed its table, and those it may have.
REQUIRED = {"company": ("symbol", "company_name"), "stock_price": ("symbol", "trade_date", "close")}
OPTIONAL = {"company": ("sector", "market_cap"), "stock_price": ("open", "high", "low", "volume")}
LOADED, NO_TABLE, LACKING = "loaded", "no table", "missing columns"


def routed_rows(spark: SparkSession, folder: str, modified_after: datetime | None) -> DataFrame:
    """(file_name, cells, target, status) of the CSV rows of files changed since a time."""
    rows = file_cells(spark, folder, modified_after).withColumn(
        "target", route(F.col(FILE_NAME))
    )
    complete = F.lit(False)
    for target, names in REQUIRED.items():
        there = F.lit(True)
        for name in names:
            there = there & F.map_contains_key("cells", F.lit(name))
        complete = complete | ((F.col("target") == target) & there)
    known = F.col("target").isin(*REQUIRED)
    status = (
        F.when(~F.coalesce(known, F.lit(False)), NO_TABLE)
        .when(complete, LOADED)
        .otherwise(LACKING)
    )
    return rows.withColumn("status", status)


def _cells(rows: DataFrame, target: str, defaults: dict[str, Column]) -> DataFrame:
    names = (*REQUIRED[target], *OPTIONAL[target])
    picked = rows.filter((F.col("target") == target) & (F.col("status") == LOADED))
    return picked.select(
        FILE_NAME,
        *[
            F.when(F.map_contains_key("cells", F.lit(n)), F.try_element_at("cells", F.lit(n)))
            .otherwise(defaults.get(n, F.lit(None)))
            .alias(n)
            for n in names
        ],
    )


def load_recent(
    spark: SparkSession,
    folder: str,
    root: str,
    batch_id: int,
    created_at: datetime | Column,
    modified_after: datetime | None = None,
) -> DataFrame:
    """Load the files changed since a time; gives (file_name, target, status, rows, rejected).

    Company files are merged by symbol, of repeated symbols the file last by name
    counting; price files are appended under their company's id. ``rows`` are those
    of the file, ``rejected`` the price rows without a readable day or close. Files
    without a row below their header do not appear.
    """
    path = scratch_path(spark, "routed")
    routed_rows(spark, folder, modified_after).write.parquet(path)
    rows = spark.read.parquet(path)

    updates = _cells(rows, "company", {"sector": F.lit("Unknown"), "market_cap": F.lit("0")})
    typed = updates.withColumn("market_cap", F.col("market_cap").try_cast("decimal(20,2)"))
    known = read_batches(spark, f"{root}/company", schemas.COMPANY)
    before = known.filter(F.col(BATCH) < batch_id).agg(F.max(BATCH)).scalar()
    company = upsert_companies(
        known.filter(F.col(BATCH) == before).drop(BATCH), typed, [FILE_NAME], created_at
    )
    company.write.mode("overwrite").parquet(f"{root}/company/{BATCH}={batch_id}")

    daily = _cells(rows, "stock_price", {"volume": F.lit("0")})
    append_prices(
        f"{root}/stock_price", batch_id, daily.drop(FILE_NAME), companies(spark, root), created_at,
        latest=["close_price", "volume", "open_price"],
    )
    rejected = rejected_prices(daily).groupBy(FILE_NAME).agg(F.count("*").alias("rejected"))
    counts = rows.groupBy(FILE_NAME, "target", "status").agg(F.count("*").alias("rows"))
    return counts.join(rejected, FILE_NAME, "left").withColumn(
        "rejected", F.coalesce("rejected", F.lit(0))
    )


def companies(spark: SparkSession, root: str) -> DataFrame:
    """The companies as the last job left them."""
    table = read_batches(spark, f"{root}/company", schemas.COMPANY)
    return table.filter(F.col(BATCH) == table.agg(F.max(BATCH)).scalar()).drop(BATCH)


def stock_prices(spark: SparkSession, root: str) -> DataFrame:
    return read_batches(spark, f"{root}/stock_price", schemas.STOCK_PRICE).drop(BATCH)
