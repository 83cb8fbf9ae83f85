"""Market hours, fiscal calendar, time ranges."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quotelake.functions import calendar
from quotelake.operators import ranges


@pytest.mark.parametrize(
    ("utc", "state"),
    [
        ("2024-01-07 08:00:00", "OPEN"),  # Sunday, 10:00 in winter
        ("2024-01-07 07:59:59", "CLOSED"),
        ("2024-01-07 12:30:00", "OPEN"),
        ("2024-01-07 12:30:01", "CLOSED"),
        ("2024-01-05 09:00:00", "CLOSED"),  # Friday
        ("2024-01-06 09:00:00", "CLOSED"),  # Saturday
        ("2024-07-07 07:00:00", "OPEN"),  # 10:00 in summer
        ("2024-07-07 11:31:00", "CLOSED"),
    ],
)
def test_market_state(spark, utc, state):
    row = spark.range(1).select(calendar.market_state(F.lit(utc).cast("timestamp")).alias("s"))
    assert row.first()["s"] == state


def test_iso_times(spark):
    cells = ["2024-01-07T10:00:00", "2024-01-07T10:00:00+02:00", "2024-01-07T10:00:00Z", "soon"]
    rows = spark.createDataFrame([(c,) for c in cells], "c string")
    got = [r["t"] for r in rows.select(calendar.iso_time(F.col("c")).alias("t")).collect()]
    assert got == [datetime(2024, 1, 7, 10), datetime(2024, 1, 7, 8), datetime(2024, 1, 7, 10), None]


def test_range_ends(spark):
    now = datetime(2024, 1, 7, 12)
    rows = spark.createDataFrame([(now - timedelta(minutes=m),) for m in (0, 4, 5, 6)], "t timestamp")
    clocks = [now, F.lit(now), str(now), rows.agg(F.max("t").alias("now"))]
    for clock in clocks:
        assert ranges.since(rows, "t", clock, "5 minutes").count() == 2
        assert ranges.until(rows, "t", clock, "5 minutes").count() == 2
    days = spark.createDataFrame([(date(2023, 7, 7),), (date(2023, 7, 6),), (None,)], "d date")
    assert ranges.since_months(days, "d", now, 6).count() == 1
