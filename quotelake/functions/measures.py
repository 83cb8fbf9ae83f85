"""Price measures, ratios, labels and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for a null part inside a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the key parts joined by ``-``."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_KEY_PART))
        for c in columns
    ]
    return F.md5(F.concat_ws("-", *parts))


def percent_change(current: Column, previous: Column, digits: int | None = None) -> Column:
    """Change against the previous value in percent; null without one or at zero."""
    change = F.try_divide(current - previous, previous) * 100
    return change if digits is None else F.round(change, digits)


def positive_ratio(numerator: Column, denominator: Column, scale: int = 1) -> Column:
    """Ratio as DOUBLE, null unless the denominator is above zero."""
    ratio = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator > 0, ratio * scale if scale != 1 else ratio)


def typical_price(high: Column, low: Column, close: Column) -> Column:
    return F.round((high + low + close) / 3, 2)


def trend_signal(close: Column, short_average: Column, long_average: Column) -> Column:
    return (
        F.when((short_average > long_average) & (close > short_average), "BULLISH")
        .when((short_average < long_average) & (close < short_average), "BEARISH")
        .otherwise("NEUTRAL")
    )


def volume_signal(volume: Column, average: Column) -> Column:
    return (
        F.when(volume > average * 1.5, "HIGH")
        .when(volume < average * 0.5, "LOW")
        .otherwise("NORMAL")
    )


def mover_type(change: Column) -> Column:
    return F.when(change > 0, "GAINER").when(change < 0, "LOSER").otherwise("UNCHANGED")


# Display names of two index tickers.
INDEX_LABELS = {"EGX100": "EGX100 EWI", "EGX33SHARIA": "EGX33 (Sharia)"}


def index_label(ticker: Column) -> Column:
    label = ticker
    for code, name in INDEX_LABELS.items():
        label = F.when(ticker == code, name).otherwise(label)
    return label
