"""Live panels over the tick table. Every panel takes the clock as ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.measures import index_label
from quotelake.operators.latest import latest_by, top_rows
from quotelake.operators.ranges import Clock, since

# Fixed value: index tickers start with this.
INDEX_PREFIX = "EGX"
REPORT_ROWS = 10


def is_index(prefix: str = INDEX_PREFIX) -> Column:
    return F.col("ticker").startswith(prefix)


def latest_ticks(ticks: DataFrame, *columns: str) -> DataFrame:
    """The newest tick of every ticker."""
    return latest_by(ticks.select("ticker", "time", *columns), ["ticker"], ["time"])


def market_status(ticks: DataFrame) -> DataFrame:
    """The newest market status."""
    newest = ticks.agg(F.max(F.struct("time", "market_status")).alias("_row"))
    return newest.select("_row.market_status")


def index_panel(ticks: DataFrame) -> DataFrame:
    """Newest value and change of every index ticker."""
    latest = latest_ticks(ticks.filter(is_index()), "price", "price_change_percent")
    return latest.select(
        index_label(F.col("ticker")).alias("index"),
        F.concat(F.col("price").cast("decimal(10,2)").cast("string"), F.lit(" Points")).alias(
            "value"
        ),
        F.col("price_change_percent").cast("decimal(10,2)").alias("change_pct"),
    )


def price_series(ticks: DataFrame, as_of: Clock, span: str = "30 minutes") -> DataFrame:
    return (
        since(ticks, "time", as_of, span)
        .select("time", "price", F.col("ticker").alias("metric"))
        .orderBy("time", "metric")
    )


def movers(ticks: DataFrame, losers: bool = False, n: int = REPORT_ROWS) -> DataFrame:
    """Stocks with the largest (or smallest) change in their newest tick."""
    latest = latest_ticks(
        ticks.filter(~is_index()), "company_name", "price", "price_change_percent"
    ).drop("time")
    ranked = top_rows(latest, "price_change_percent", "ticker", n, ascending=losers)
    return ranked.select("company_name", "ticker", "price", "price_change_percent")


def volume_ranking(
    ticks: DataFrame, as_of: Clock, span: str = "5 minutes", n: int = REPORT_ROWS
) -> DataFrame:
    """Stocks with the most volume in their newest tick of the span."""
    recent = since(ticks, "time", as_of, span).filter(~is_index())
    latest = latest_ticks(recent, "company_name", "volume").filter("volume > 0")
    return top_rows(latest, "volume", "ticker", n).select("company_name", "volume")


def active_tickers(ticks: DataFrame, as_of: Clock, span: str = "5 minutes") -> DataFrame:
    recent = since(ticks, "time", as_of, span)
    return recent.agg(F.countDistinct("ticker").alias("tickers"))


def average_price(ticks: DataFrame, as_of: Clock, span: str = "5 minutes") -> DataFrame:
    recent = since(ticks, "time", as_of, span)
    return recent.agg(F.avg("price").alias("avg_price"))


def total_volume(ticks: DataFrame, as_of: Clock, span: str = "5 minutes") -> DataFrame:
    recent = since(ticks, "time", as_of, span)
    return recent.agg(F.sum("volume").alias("total_volume"))
