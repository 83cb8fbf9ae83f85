"""Time ranges relative to a clock, written so that the scan can skip data.

A filter reaches the parquet reader only as ``column > value``. The bound is
therefore computed apart and cast to the column's own type, also when the clock
is a one-row table: the arithmetic then happens inside the scalar subquery,
whose result Spark hands to the reader.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A clock value, or a table of one row and one column that holds it.
Clock = Column | DataFrame | datetime | date | str


def moment(rows: DataFrame, column: str, as_of: Clock, shift: Callable[[Column], Column]) -> Column:
    """The shifted clock in the type of ``column``."""
    kind = rows.schema[column].dataType
    if isinstance(as_of, DataFrame):
        return as_of.select(shift(F.col(as_of.columns[0])).cast(kind)).scalar()
    if isinstance(as_of, str):
        as_of = F.lit(as_of).cast(kind)
    return shift(as_of if isinstance(as_of, Column) else F.lit(as_of)).cast(kind)


def back(span: str) -> Callable[[Column], Column]:
    return lambda now: now - F.expr(f"INTERVAL {span}")


def since(rows: DataFrame, time: str, as_of: Clock, span: str) -> DataFrame:
    """Rows after ``as_of`` minus ``span``, e.g. ``'5 minutes'``."""
    return rows.filter(F.col(time) > moment(rows, time, as_of, back(span)))


def until(rows: DataFrame, time: str, as_of: Clock, span: str) -> DataFrame:
    """Rows from ``as_of`` minus ``span``, included, up to ``as_of``, excluded."""
    first = moment(rows, time, as_of, back(span))
    end = moment(rows, time, as_of, lambda now: now)
    return rows.filter((F.col(time) >= first) & (F.col(time) < end))


def since_months(rows: DataFrame, day: str, as_of: Clock, months: int) -> DataFrame:
    """Rows from the day ``months`` before ``as_of`` on."""
    first = moment(rows, day, as_of, lambda now: F.add_months(now.cast("date"), -months))
    return rows.filter(F.col(day) >= first)
