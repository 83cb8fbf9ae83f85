"""Date, clock and market-hours expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The exchange's trading hours and zone.
MARKET_ZONE = "Africa/Cairo"
MARKET_OPENS = "10:00:00"
MARKET_CLOSES = "14:30:00"


def market_state(utc_time: Column) -> Column:
    """OPEN from Sunday to Thursday between 10:00 and 14:30 local time, both included.

    The closing minute counts only at its first instant.
    """
    local = F.from_utc_timestamp(utc_time, MARKET_ZONE)
    workday = F.dayofweek(local).between(1, 5)
    day = F.date_trunc("day", local)
    opens = day + F.expr(f"INTERVAL '{MARKET_OPENS}' HOUR TO SECOND")
    closes = day + F.expr(f"INTERVAL '{MARKET_CLOSES}' HOUR TO SECOND")
    return F.when(workday & local.between(opens, closes), "OPEN").otherwise("CLOSED")


def fiscal_year(day: Column) -> Column:
    """The fiscal year starts in July."""
    return F.year(day) + F.when(F.month(day) >= 7, 1).otherwise(0)


def fiscal_quarter(day: Column) -> Column:
    """Jan-Mar 4, Apr-Jun 1, Jul-Sep 2, Oct-Dec 3."""
    return F.pmod(F.quarter(day) + F.lit(2), F.lit(4)) + F.lit(1)


def season(day: Column) -> Column:
    third = F.pmod(F.month(day), F.lit(12))
    return (
        F.when(third < 3, "Winter")
        .when(third < 6, "Spring")
        .when(third < 9, "Summer")
        .otherwise("Autumn")
    )


def is_weekend(day: Column) -> Column:
    """Friday and Saturday."""
    return F.dayofweek(day).isin(6, 7)


def iso_time(text: Column) -> Column:
    """ISO-8601 text with or without an offset to an instant, null when malformed."""
    return F.try_to_timestamp(text)
