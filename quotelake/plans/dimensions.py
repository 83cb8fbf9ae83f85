"""Small dimensions: sector, industry, location, currency, calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions import calendar
from quotelake.functions.measures import surrogate_key
from quotelake.functions.text import location_key, normalize_key, not_blank
from quotelake.operators.dense_ids import dense_ids

# The currencies, and the calendar's first day and length.
CURRENCIES = (("EGP", "Egyptian Pound", "E£"), ("USD", "US Dollar", "$"))
CALENDAR_START = date(2000, 1, 1)
CALENDAR_DAYS = 365 * 50


def hashed_dimension(companies: DataFrame, column: str) -> DataFrame:
    """Distinct values with an md5 id."""
    values = companies.select(column).filter(F.col(column).isNotNull()).distinct()
    return values.select(surrogate_key(column).alias(f"{column}_id"), column)


def numbered_dimension(companies: DataFrame, column: str) -> DataFrame:
    """Distinct cleaned names numbered in name order."""
    name = f"{column}_name"
    names = companies.filter(not_blank(column)).select(normalize_key(column).alias(name))
    return dense_ids(names.distinct(), name, f"{column}_id").select(f"{column}_id", name)


def location_dimension(companies: DataFrame) -> DataFrame:
    """Distinct headquarters with punctuation read as spaces, numbered in name order."""
    names = companies.filter(not_blank("headquarters")).select(
        location_key("headquarters").alias("location_name")
    )
    return dense_ids(names.distinct(), "location_name", "location_id").select(
        "location_id", "location_name"
    )


def currency_dimension(spark: SparkSession) -> DataFrame:
    """The currencies numbered in code order."""
    rows = [
        (i, code, name, symbol, True)
        for i, (code, name, symbol) in enumerate(sorted(CURRENCIES), start=1)
    ]
    return spark.createDataFrame(
        rows,
        "currency_id int, currency_code string, currency_name string, symbol string,"
        " is_active boolean",
    )


def day_rows(spark: SparkSession, start: date = CALENDAR_START, days: int = CALENDAR_DAYS):
    """One row per day from ``start``."""
    first = F.lit(start)
    return spark.range(days).select(F.date_add(first, F.col("id").cast("int")).alias("date"))


def days_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day between the two dates of a one-row table."""
    return bounds.select(F.explode(F.sequence(first, last)).alias("date"))


def date_dimension(days: DataFrame) -> DataFrame:
    """Calendar attributes of every day."""
    day: Column = F.col("date")
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_id"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.concat_ws("-", F.year(day), F.quarter(day)).alias("year_quarter"),
        F.date_format(day, "E").alias("day_name"),
        calendar.is_weekend(day).alias("is_weekend"),
        calendar.fiscal_year(day).alias("fiscal_year"),
        calendar.fiscal_quarter(day).alias("fiscal_quarter"),
        calendar.season(day).alias("season"),
    )


def sample_ids(spark: SparkSession) -> DataFrame:
    """The starter model: one id and one null."""
    return spark.createDataFrame([(1,), (None,)], "id int")


def sample_first(ids: DataFrame) -> DataFrame:
    """The starter model's consumer: the row with id 1."""
    return ids.filter(F.col("id") == 1)
