"""Panels over tagged points (symbol, time, open, high, low, close, volume)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.operators.latest import latest_by, top_rows
from quotelake.operators.ranges import Clock, moment, until

# Index symbols, shown apart from stocks.
INDEX_SYMBOLS = ("EGX30", "EGX30CAPPED", "EGX70EWI", "EGX100EWI")


def stocks_only(points: DataFrame, indices: Sequence[str] = INDEX_SYMBOLS) -> DataFrame:
    return points.filter(~F.col("symbol").isin(*indices))


def index_values(
    points: DataFrame, as_of: Clock, span: str = "24 hours", indices: Sequence[str] = INDEX_SYMBOLS
) -> DataFrame:
    """Last close of every index symbol."""
    recent = until(points, "time", as_of, span).filter(F.col("symbol").isin(*indices))
    last = latest_by(recent.select("symbol", "time", "close"), ["symbol"], ["time"])
    return last.select("symbol", "time", F.col("close").alias("value"))


def volume_by_symbol(points: DataFrame, as_of: Clock, span: str = "24 hours") -> DataFrame:
    recent = until(stocks_only(points), "time", as_of, span)
    return recent.groupBy("symbol").agg(F.sum("volume").alias("value"))


def volume_top(points: DataFrame, as_of: Clock, n: int = 10, span: str = "24 hours") -> DataFrame:
    return top_rows(volume_by_symbol(points, as_of, span), "value", "symbol", n)


def volume_share(points: DataFrame, as_of: Clock, span: str = "24 hours") -> DataFrame:
    """Volume per symbol and its share of the total in percent.

    The total is a scalar subquery over the same aggregation; a window over all
    symbols would gather them in one task.
    """
    volumes = volume_by_symbol(points, as_of, span)
    total = volumes.agg(F.sum("value").cast("double")).scalar()
    share = F.try_divide(F.col("value").cast("double"), total) * 100
    return volumes.withColumn("share_pct", share)


def net_change(points: DataFrame, as_of: Clock, span: str = "7 days") -> DataFrame:
    """Last close minus first close per symbol: the sum of all consecutive differences.

    A symbol with a single point has no difference and is left out.
    """
    recent = until(stocks_only(points), "time", as_of, span)
    ends = recent.groupBy("symbol").agg(
        F.min(F.struct("time", "close")).alias("_first"),
        F.max(F.struct("time", "close")).alias("_last"),
        F.count("*").alias("_n"),
    )
    return ends.filter("_n > 1").select(
        "symbol", (F.col("_last.close") - F.col("_first.close")).alias("value")
    )


def net_movers(
    points: DataFrame, as_of: Clock, losers: bool = False, n: int = 5, span: str = "7 days"
) -> DataFrame:
    return top_rows(net_change(points, as_of, span), "value", "symbol", n, ascending=losers)


def volatility(points: DataFrame, as_of: Clock, n: int = 10, span: str = "7 days") -> DataFrame:
    """Highest high minus lowest low per symbol, from one aggregation."""
    recent = until(stocks_only(points), "time", as_of, span)
    ranges = recent.groupBy("symbol").agg((F.max("high") - F.min("low")).alias("value"))
    return top_rows(ranges, "value", "symbol", n)


def daily_last(points: DataFrame, as_of: Clock, span: str = "5 years") -> DataFrame:
    """Last close per symbol and day, stamped with the end of the day; no empty days.

    The current day ends at ``as_of``.
    """
    recent = until(points, "time", as_of, span).withColumn(
        "_day", F.date_trunc("day", F.col("time"))
    )
    last = latest_by(
        recent.select("symbol", "_day", "time", "close"), ["symbol", "_day"], ["time"]
    )
    now = moment(points, "time", as_of, lambda t: t)
    return last.select(
        "symbol",
        F.least(F.col("_day") + F.expr("INTERVAL 1 DAY"), now).alias("time"),
        F.col("close").alias("value"),
    )


def latest_fields(
    field_rows: DataFrame, as_of: Clock, fields: Sequence[str], span: str = "24 hours"
) -> DataFrame:
    """Last value of each field per symbol, as one row per (symbol, time).

    ``field_rows`` are points in long form (symbol, time, field, value).
    """
    recent = until(stocks_only(field_rows), "time", as_of, span).filter(
        F.col("field").isin(*fields)
    )
    last = latest_by(recent, ["symbol", "field"], ["time"])
    return last.groupBy("symbol", "time").pivot("field", list(fields)).agg(F.first("value"))
