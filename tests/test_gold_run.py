"""Stored gold runs: repeated, broken, late and empty ones."""

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from test_prices import as_set, bars

from quotelake.plans import gold_run, indices, prices


def members(spark):
    return spark.createDataFrame(
        [("A", "Index A", "HOT", 50.0, date(2019, 1, 1)), ("A", "Index A", "GAPS", 2.0, None)],
        "index_code string, index_name string, symbol string, weight double, effective_date date",
    ).withColumn("weight", F.col("weight").cast("decimal(8,4)"))


def until(rows, day):
    return rows.filter(F.col("trade_date") <= F.lit(day))


def test_runs_equal_one_run_over_all_days(spark, tmp_path):
    rows, held, root = bars(spark), members(spark), str(tmp_path / "gold")
    cuts = [date(2020, 2, 10), date(2020, 2, 10), date(2021, 6, 1), date(2035, 1, 1)]
    for batch, cut in enumerate(cuts, 1):
        assert gold_run.run_gold(spark, root, batch, until(rows, cut), held)
    assert as_set(gold_run.read_prices(spark, root)) == as_set(prices.daily_prices(rows))
    full = indices.index_performance(held, prices.price_input(rows))
    assert as_set(gold_run.read_index(spark, root)) == as_set(full)
    # Only the state of the last two runs is kept, and no arrived rows.
    assert sorted(os.listdir(f"{root}/carry")) == ["batch_id=3", "batch_id=4"]
    assert os.listdir(f"{root}/arrived") == []


def test_a_repeated_run_changes_nothing(spark, tmp_path):
    rows, held, root = bars(spark), members(spark), str(tmp_path / "gold")
    first = date(2020, 3, 1)
    assert gold_run.run_gold(spark, root, 1, until(rows, first), held)
    before = as_set(gold_run.read_prices(spark, root))
    # The same run later, when the source has more days and changed ones.
    changed = rows.withColumn("close_price", F.col("close_price") + 1)
    assert not gold_run.run_gold(spark, root, 1, changed, held)
    assert as_set(gold_run.read_prices(spark, root)) == before


def test_a_broken_run_is_done_anew(spark, tmp_path):
    rows, held, root = bars(spark), members(spark), str(tmp_path / "gold")
    gold_run.run_gold(spark, root, 1, until(rows, date(2020, 3, 1)), held)
    half = as_set(gold_run.read_prices(spark, root))
    # Run 2 wrote facts and state, then was lost before it noted itself.
    wrong = spark.read.parquet(f"{root}/prices/batch_id=1").limit(5)
    wrong.write.parquet(f"{root}/prices/batch_id=2")
    spark.read.parquet(f"{root}/carry/batch_id=1").limit(1).write.parquet(f"{root}/carry/batch_id=2")
    assert as_set(gold_run.read_prices(spark, root)) == half
    gold_run.run_gold(spark, root, 2, rows, held)
    assert as_set(gold_run.read_prices(spark, root)) == as_set(prices.daily_prices(rows))


def test_runs_go_forward_and_may_bring_nothing(spark, tmp_path):
    rows, held, root = bars(spark), members(spark), str(tmp_path / "gold")
    day = date(2020, 3, 1)
    assert gold_run.run_gold(spark, root, 5, until(rows, day - timedelta(days=90)), held)
    assert gold_run.run_gold(spark, root, 6, until(rows, day), held)
    assert gold_run.run_gold(spark, root, 7, until(rows, day), held)
    with pytest.raises(ValueError, match="run 7 has followed run 3"):
        gold_run.run_gold(spark, root, 3, rows, held)
    gold_run.run_gold(spark, root, 8, rows, held)
    assert as_set(gold_run.read_prices(spark, root)) == as_set(prices.daily_prices(rows))


def test_state_is_slim_and_stays_with_its_symbol(spark, tmp_path):
    rows, held, root = bars(spark), members(spark), str(tmp_path / "gold")
    gold_run.run_gold(spark, root, 1, until(rows, date(2020, 3, 1)), held)
    stored = spark.read.parquet(f"{root}/carry/batch_id=1")
    assert tuple(stored.columns) == prices.CARRY_COLUMNS
    buckets = gold_run.runs(spark, root).first()["buckets"]
    carried = gold_run._carried(spark, root, 1, stored.schema, buckets)
    assert as_set(carried) == as_set(stored)
    plan = prices.carry_rows(rows.limit(0)).select(*prices.CARRY_COLUMNS)
    assert plan.columns == carried.columns
    alone = carried.groupBy("symbol").count()
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()
