"""Parsers on literal cells."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quotelake.functions import text

U = " "


def parse(spark, expression, cells):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = rows.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()
    return [r["v"] for r in got]


def test_magnitude(spark):
    cells = ["1.25 B", f"3.5{U}M", "−2K", "1T", "7", "∅", "", "-", "—", None, "abc",
             "1,250", "12 b", "+4K", f"− 1.5{U}T", "5.", ".5M", "1e3"]
    want = [1250000000, 3500000, -2000, 10**12, 7, None, None, None, None, None, None, None, None,
            4000, -1500000000000, 5, 500000, None]
    got = parse(spark, text.parse_magnitude, cells)
    assert got == [None if w is None else Decimal(w) for w in want]


def test_convert_units_ignores_case(spark):
    got = parse(spark, text.convert_units, ["1.5b", "2M", "3k", "USD 12.5", "1T", "x", None])
    assert got == [Decimal(n) if n is not None else None
                   for n in ("1500000000", "2000000", "3000", "12.5", "1", None, None)]


@pytest.mark.parametrize(
    ("cell", "want"),
    [
        ("4.39 M", 4390000), ("1.23 K", 1230), ("2b", 2000000000), ("1,250", 1250), ("12.9", 12),
        ("-12.9", -12), ("", None), ("-", None), ("—", None), (None, None), ("n/a", None),
        ("K 5", 5000), ("1d", None), ("1.13M", int(1.13 * 1_000_000)), (" 7 ", 7),
    ],
)
def test_volume(spark, cell, want):
    assert parse(spark, text.parse_volume, [cell]) == [want]


def test_clean_numeric(spark):
    cells = ["EGP 12.5", "+3%", "−3.25%", "-1", "1,234.5", "", "-", "—", None, "x", "NaN",
             f"5{U}%"]
    want = [12.5, 3.0, -3.25, -1.0, 1234.5, None, None, None, None, None, None, 5.0]
    assert parse(spark, text.clean_numeric, cells) == want


def test_change_percent(spark):
    cells = ["-1.25 (-2.5%)", "+1 (+.5%)", "−1 (−2.5%)", "3%", "3", "", "∅", None]
    assert parse(spark, text.change_percent, cells) == [-2.5, 0.5, -2.5, 3.0] + [None] * 4


def test_trade_day(spark):
    cells = ["Sun 07 Dec '25", "Mon 1 Jan '24", "Thu 05 Nov '98", "2025-12-07", "", "∅", None,
             "Sun 31 Feb '25"]
    want = [date(2025, 12, 7), date(2024, 1, 1), date(1998, 11, 5)] + [None] * 5
    assert parse(spark, text.trade_day, cells) == want


def test_quarters(spark):
    cells = ["Q4 '24", " Q1 '09 ", "Q5 '24", "TTM", "", None, "Q2 24"]
    want = [date(2024, 10, 1), date(2009, 1, 1), None, None, None, None, date(2024, 4, 1)]
    assert parse(spark, text.quarter_start, cells) == want
    assert parse(spark, text.fiscal_quarter_label, cells)[:3] == ["Q4", "Q1", None]
    assert parse(spark, text.fiscal_year_number, cells)[:4] == [2024, 2009, 2024, None]


def test_scraped_value(spark):
    cells = ["‪1.5‬", f"2{U}B", "—", "–", "-", None]
    assert parse(spark, text.scraped_value, cells) == ["1.5", "2B", None, None, None, None]


def test_names(spark):
    assert parse(spark, text.location_key, [" Cairo, New-City. "]) == ["CAIRO  NEW CITY"]
    assert parse(spark, text.not_blank, ["", "  ", "a", None]) == [False, False, True, False]


def test_generated_code_of_volumes_is_short_enough_to_be_compiled(spark):
    """The virtual machine never compiles a method of more than 8,000 bytes."""
    cells = [F.concat(F.col("id").cast("string"), F.lit(f" M{i}")) for i in range(5)]
    plan = spark.range(9).select(*[text.parse_volume(c) for c in cells])
    debug = spark.sparkContext._jvm.java.lang.Class.forName(
        "org.apache.spark.sql.execution.debug.package$"
    ).getField("MODULE$").get(None)
    parts = debug.codegenStringSeq(plan._jdf.queryExecution().executedPlan())
    sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
    assert 0 < max(sizes) < 8000
