"""Gold prices: slices, increments, hot keys."""

from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from quotelake.operators.series import consecutive_difference, range_slices, with_lookback
from quotelake.plans import indices, prices

SCHEMA = (
    "symbol string, trade_date date, open_price decimal(18,4), high_price decimal(18,4),"
    " low_price decimal(18,4), close_price decimal(18,4), volume bigint, data_source string"
)


def bars(spark):
    """One symbol holds most rows, one has gaps of many months, one has a single row."""
    rows = []
    for symbol, days, step in (("HOT", 900, 1), ("GAPS", 60, 40), ("ONE", 1, 1)):
        for i in range(days):
            price = Decimal((i * 37) % 101 + 1) / 4
            day = date(2020, 1, 1) + timedelta(days=i * step)
            rows.append((symbol, day, None, price + 1, price - 1, price, (i * 13) % 29, "T"))
    return spark.createDataFrame(rows, SCHEMA)


def as_set(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_slices_change_nothing(spark):
    rows = bars(spark)
    whole = as_set(prices.daily_prices(rows))
    for slice_of in (F.year("trade_date"), F.trunc("trade_date", "month"), F.col("trade_date")):
        assert as_set(prices.daily_prices(rows, slice_of)) == whole
    assert as_set(prices.daily_prices(rows, by_range=True)) == whole


def test_range_slices_split_a_hot_key_evenly(spark):
    rows = bars(spark).select("symbol", "trade_date", "close_price")
    ranged = range_slices(rows, ["symbol"], ["trade_date"], slices=12)
    sizes = [r["n"] for r in ranged.groupBy("_slice").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * sum(sizes) / 12
    steps = consecutive_difference(rows, "symbol", ["trade_date"], "close_price")
    assert steps.count() == rows.count() - 3


def test_chain_of_increments_equals_full_run(spark):
    rows = bars(spark)
    full = prices.daily_prices(rows)
    cuts = [date(2020, 2, 10), date(2020, 2, 11), date(2021, 6, 1), date(2035, 1, 1)]
    first = rows.filter(F.col("trade_date") <= cuts[0])
    done, carry = as_set(prices.daily_prices(first)), prices.carry_rows(first)
    for start, end in zip(cuts, cuts[1:]):
        fresh = rows.filter((F.col("trade_date") > start) & (F.col("trade_date") <= end))
        done += as_set(prices.daily_prices_increment(fresh, carry))
        carry = prices.next_carry(fresh, carry)
    assert sorted(done, key=str) == as_set(full)


def test_first_row_and_gaps_are_filled_from_close(spark):
    row = prices.daily_prices(bars(spark)).filter("symbol = 'ONE'").collect()[0]
    assert row["open_price"] == row["close_price"]
    assert row["price_change"] is None and row["price_change_pct"] is None
    assert row["trend_signal"] == "NEUTRAL"


def test_zero_previous_close_gives_no_percent(spark):
    rows = bars(spark).filter("symbol = 'GAPS'").withColumn(
        "close_price", F.lit(0).cast("decimal(18,4)")
    )
    assert prices.daily_prices(rows).filter("price_change_pct IS NOT NULL").count() == 0


def test_lookback_carries_exactly_the_rows_before_a_slice(spark):
    rows = bars(spark).select("symbol", "trade_date", "close_price")
    carried = with_lookback(rows, ["symbol"], ["trade_date"], F.year("trade_date"), 3)
    counts = {
        (r["symbol"], r["_slice"]): r["n"]
        for r in carried.filter("_carried").groupBy("symbol", "_slice")
        .agg(F.count("*").alias("n")).collect()
    }
    assert counts[("HOT", 2021)] == 3 and ("HOT", 2020) not in counts
    assert ("ONE", 2020) not in counts


def test_differences_add_up_to_last_minus_first(spark):
    rows = bars(spark).select("symbol", "trade_date", "close_price")
    steps = consecutive_difference(
        rows, "symbol", ["trade_date"], "close_price", F.trunc("trade_date", "month")
    )
    sums = {r["symbol"]: r["s"] for r in
            steps.groupBy("symbol").agg(F.sum("difference").alias("s")).collect()}
    ends = rows.groupBy("symbol").agg(
        (F.max_by("close_price", "trade_date") - F.min_by("close_price", "trade_date")).alias("s")
    )
    want = {r["symbol"]: r["s"] for r in ends.collect() if r["symbol"] != "ONE"}
    assert sums == want
    assert steps.count() == rows.count() - 3


def test_views_keep_one_row_per_symbol(spark):
    gold = prices.daily_prices(bars(spark))
    assert prices.volume_leaders(gold).count() == 3
    movers = prices.top_movers(gold).collect()
    assert [r["symbol"] for r in movers] and len(movers) == 2
    sizes = [abs(r["price_change_pct"]) for r in movers]
    assert sizes == sorted(sizes, reverse=True)
    history = prices.price_history(gold, date(2022, 6, 18))
    assert history.agg(F.min("trade_date")).first()[0] >= date(2021, 12, 18)


def test_index_increment_equals_full_run(spark):
    members = spark.createDataFrame(
        [("I", "Index", "HOT", Decimal("2.5"), date(2020, 1, 3)),
         ("I", "Index", "GAPS", None, date(2020, 1, 1))],
        "index_code string, index_name string, symbol string, weight decimal(8,4),"
        " effective_date date",
    )
    rows = bars(spark)
    cut = date(2021, 1, 1)
    full = indices.index_performance(members, rows).filter(F.col("trade_date") > cut)
    last = indices.index_days(members, rows.filter(F.col("trade_date") == cut))
    fresh = rows.filter(F.col("trade_date") > cut)
    assert as_set(indices.index_performance(members, fresh, last)) == as_set(full)
    first_day = indices.index_days(members, rows).agg(F.min("trade_date")).first()[0]
    assert first_day == date(2020, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_and_series_share_one_shuffle(spark):
    from quotelake.workload import inputs

    rows = inputs.part_prices(spark, "/root/testdata/sf0.001")
    assert plan_of(prices.daily_prices(rows)).count("Exchange hashpartitioning") == 1


def test_bars_stored_by_symbol_need_no_shuffle(spark, tmp_path):
    from quotelake.sources.sinks import store_by_key

    tables = {t.name for t in spark.catalog.listTables()}
    rows = bars(spark)
    stored = store_by_key(rows, f"{tmp_path}/bars", "symbol", ["trade_date", "data_source"])
    gold = prices.daily_prices(stored)
    latest = gold.groupBy("symbol").agg(F.max("trade_date").alias("d"))
    span = stored.groupBy("symbol").agg(F.min("trade_date").alias("first"))
    for plan in (gold, latest.join(span.hint("merge"), "symbol")):
        assert "Exchange" not in plan_of(plan)
    assert as_set(gold) == as_set(prices.daily_prices(rows))
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_stored_history_reads_its_months_only(spark, tmp_path):
    gold, path = prices.daily_prices(bars(spark)), f"{tmp_path}/gold"
    prices.store_gold(gold, path)
    stored = spark.read.parquet(path)
    newest = gold.agg(F.max("trade_date")).first()[0]
    for as_of in (None, date(2021, 5, 17)):
        history = prices.stored_history(stored, 6, as_of)
        assert as_set(history) == as_set(prices.price_history(gold, as_of or newest, 6))
        text = plan_of(history)
        assert "PartitionFilters: [isnotnull(trade_month" in text
    # A month that comes again is replaced.
    prices.store_gold(gold.filter(F.col("trade_date") >= F.trunc(F.lit(newest), "month")), path)
    assert spark.read.parquet(path).count() == gold.count()
