"""Daily prices: staging, the gold fact with technical indicators, and its views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.functions.measures import (
    mover_type,
    percent_change,
    trend_signal,
    typical_price,
    volume_signal,
)
from quotelake.functions.text import change_percent, parse_magnitude, strip_signs, trade_day, try_decimal
from quotelake.operators.incremental import newer_than_target, write_partitions
from quotelake.operators.latest import latest_by, latest_of_few
from quotelake.operators.lookups import enrich
from quotelake.operators.ranges import Clock, moment, since_months
from quotelake.operators.series import CARRIED, SLICE, drop_carried, last_rows, with_lookback
from quotelake.sources.bronze import INGEST_SYMBOL, members
from quotelake.sources.loaders import BATCH_SOURCE

SHORT_ROWS = 7
LONG_ROWS = 30
LOOKBACK_ROWS = LONG_ROWS - 1
# What the averages and the change of later days need of a row.
CARRY_COLUMNS = ("symbol", "trade_date", "close_price", "volume", "data_source")
MONEY = "decimal(18,4)"
MONTH = "trade_month"


def unified_prices(
    prices_raw: DataFrame, companies: DataFrame, target: DataFrame | None = None,
    source: str = BATCH_SOURCE,
) -> DataFrame:
    """Typed prices from bronze rows, with company name and sector.

    One row per (symbol, trade_date, data_source): the latest load wins.
    """
    quotes = ("open", "high", "low", "close")
    text = members(
        prices_raw, [INGEST_SYMBOL, "trade_date", *quotes, "volume"], keep=["load_ts"]
    )
    typed = text.select(
        F.col(INGEST_SYMBOL).alias("symbol"),
        F.col("trade_date").try_cast("date").alias("trade_date"),
        *[F.col(name).try_cast(MONEY).alias(f"{name}_price") for name in quotes],
        F.col("volume").try_cast("bigint").alias("volume"),
        F.col("load_ts").alias("ingested_at"),
    ).filter(F.col("trade_date").isNotNull() & F.col("close_price").isNotNull())
    if target is not None:
        typed = newer_than_target(typed, target, "ingested_at")
    single = latest_of_few(typed, ["symbol", "trade_date"], ["ingested_at"])
    close = F.col("close_price")
    return enrich(single, companies, "symbol", ["company_name", "sector"]).select(
        "symbol",
        "company_name",
        "sector",
        "trade_date",
        F.coalesce("open_price", close).alias("open_price"),
        F.coalesce("high_price", close).alias("high_price"),
        F.coalesce("low_price", close).alias("low_price"),
        "close_price",
        F.coalesce("volume", F.lit(0)).alias("volume"),
        F.lit(source).alias("data_source"),
        "ingested_at",
    )


def latest_stock_prices(stock_price: DataFrame, along: str | None = None) -> DataFrame:
    """One row per company and day: the row created last, then the greatest id.

    With ``along``, a column that names the company, the rows of a company stay
    together, ready for its series.
    """
    cleaned = stock_price.withColumn("data_source", F.upper(F.trim("data_source")))
    keys = ["company_id", "trade_date"]
    single = latest_of_few(
        cleaned, [along, *keys] if along else keys, ["created_at", "price_id"], along
    )
    day = F.col("trade_date")
    return single.withColumns(
        {
            "trade_year": F.year(day),
            "trade_month": F.month(day),
            "trade_yearmonth": F.date_format(day, "yyyyMM"),
        }
    )


def text_prices(prices_raw: DataFrame) -> DataFrame:
    """Prices whose cells are display text, cleaned; one row per (symbol, date)."""
    quotes = ("open", "high", "low", "close")
    text = members(
        prices_raw,
        ["symbol", INGEST_SYMBOL, "date", *quotes, "change", "volume", "last_day"],
        keep=["file_name", "load_ts"],
        also={"date": "Date"},
    )
    typed = text.select(
        F.coalesce("symbol", INGEST_SYMBOL).alias("symbol"),
        trade_day("date").alias("date"),
        *[try_decimal(strip_signs(name)).cast("double").alias(name) for name in quotes],
        change_percent("change").alias("change_pct"),
        parse_magnitude("volume").cast("double").alias("volume"),
        F.col("last_day").alias("last_day_raw"),
        "file_name",
        "load_ts",
    )
    return latest_of_few(typed, ["symbol", "date"], ["load_ts", "file_name"])


def price_input(prices: DataFrame) -> DataFrame:
    """Prices the gold fact starts from: close known, gaps filled from the close."""
    close = F.col("close_price")
    return prices.filter(close.isNotNull()).select(
        "symbol",
        "trade_date",
        F.coalesce("open_price", close).alias("open_price"),
        F.coalesce("high_price", close).alias("high_price"),
        F.coalesce("low_price", close).alias("low_price"),
        "close_price",
        F.coalesce("volume", F.lit(0)).alias("volume"),
        "data_source",
    )


def _indicators(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Previous close and trailing averages from one sort per series."""
    along = Window.partitionBy(*keys).orderBy("trade_date", "data_source")
    short = along.rowsBetween(-(SHORT_ROWS - 1), 0)
    long = along.rowsBetween(-(LONG_ROWS - 1), 0)
    return rows.withColumns(
        {
            "_previous": F.lag("close_price").over(along),
            "ma_7d": F.round(F.avg("close_price").over(short), 2),
            "ma_30d": F.round(F.avg("close_price").over(long), 2),
            "volume_ma_7d": F.round(F.avg("volume").over(short), 0),
        }
    )


def _gold_columns(rows: DataFrame) -> DataFrame:
    close, previous = F.col("close_price"), F.col("_previous")
    high, low = F.col("high_price"), F.col("low_price")
    return rows.select(
        "symbol",
        "trade_date",
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        (close - previous).alias("price_change"),
        percent_change(close, previous, 4).alias("price_change_pct"),
        (high - low).alias("price_range"),
        typical_price(high, low, close).alias("typical_price"),
        "ma_7d",
        "ma_30d",
        "volume_ma_7d",
        trend_signal(close, F.col("ma_7d"), F.col("ma_30d")).alias("trend_signal"),
        volume_signal(F.col("volume"), F.col("volume_ma_7d")).alias("volume_signal"),
        "data_source",
    )


def daily_prices(
    prices: DataFrame, slice_of: Column | None = None, by_range: bool = False
) -> DataFrame:
    """The gold daily fact.

    The input holds one row per symbol, day and source, so a symbol's series is
    as long as the calendar and one window per symbol is the plan with the
    fewest shuffles. For series without that bound, ``slice_of`` (for example
    ``F.year("trade_date")``) or ``by_range`` (slices of even size) cuts each
    symbol into slices that run apart, with the same result.
    """
    rows = price_input(prices)
    if slice_of is None and not by_range:
        return _gold_columns(_indicators(rows, ["symbol"]))
    sliced = with_lookback(rows, ["symbol"], ["trade_date", "data_source"], slice_of, LOOKBACK_ROWS)
    computed = _indicators(sliced, ["symbol", SLICE])
    return _gold_columns(drop_carried(computed))


def carry_rows(prices: DataFrame) -> DataFrame:
    """The last 29 rows per symbol: all an incremental run has to know of the past."""
    return last_rows(
        price_input(prices), ["symbol"], ["trade_date", "data_source"], LOOKBACK_ROWS
    )


def daily_prices_increment(
    new_prices: DataFrame, carried: DataFrame, by_symbol: bool = False
) -> DataFrame:
    """Gold rows for new days only, equal to those of a full recompute.

    ``carried`` is ``carry_rows`` of everything loaded before; store it next to
    the fact and replace it with ``next_carry`` after each run. Cost grows with
    the new rows and the number of symbols, not with the history. Of carried rows
    only ``CARRY_COLUMNS`` are used. With ``by_symbol`` both are stored in buckets
    of their symbol: all carried rows then stay where they are, which takes no
    shuffle, while picking those of new symbols would take two.
    """
    fresh = price_input(new_prices).withColumn(CARRIED, F.lit(False))
    if by_symbol:
        needed = carried.filter(F.col("symbol").isNotNull())
    else:
        needed = carried.join(fresh.select("symbol").distinct(), "symbol", "left_semi")
    needed = needed.withColumn(CARRIED, F.lit(True))
    rows = fresh.unionByName(needed, allowMissingColumns=True)
    computed = _indicators(rows, ["symbol"]).filter(~F.col(CARRIED))
    return _gold_columns(computed)


def next_carry(new_prices: DataFrame, carried: DataFrame) -> DataFrame:
    return last_rows(
        carried.unionByName(price_input(new_prices).select(*carried.columns)),
        ["symbol"],
        ["trade_date", "data_source"],
        LOOKBACK_ROWS,
    )


def new_days(prices: DataFrame, gold: DataFrame) -> DataFrame:
    """Prices of days past the fact's last day."""
    return newer_than_target(prices, gold, "trade_date")


def _latest_gold(gold: DataFrame) -> DataFrame:
    return latest_by(gold, ["symbol"], ["trade_date"])


def market_snapshot(gold: DataFrame, companies: DataFrame) -> DataFrame:
    """The last day of every known symbol, with company attributes.

    Rows are cut to one per symbol before the join; the join drops whole
    symbols, so the result is that of joining first.
    """
    latest = _latest_gold(
        gold.select(
            "symbol", "trade_date", "close_price", "price_change", "price_change_pct", "volume",
            "high_price", "low_price", "ma_7d", "ma_30d", "trend_signal", "volume_signal",
            "data_source",
        )
    )
    attributes = companies.select(
        "symbol", "company_name", "sector", "pe_ratio", "market_cap", "analyst_rating"
    )
    return latest.join(attributes, "symbol").select(
        "symbol",
        "company_name",
        "sector",
        "trade_date",
        F.col("close_price").alias("current_price"),
        "price_change",
        "price_change_pct",
        "volume",
        F.col("high_price").alias("day_high"),
        F.col("low_price").alias("day_low"),
        "ma_7d",
        "ma_30d",
        "trend_signal",
        "volume_signal",
        "pe_ratio",
        "market_cap",
        "analyst_rating",
        "data_source",
    )


def price_history(gold: DataFrame, as_of: Clock, months: int = 6) -> DataFrame:
    """The last months of every symbol, for charts."""
    return (
        since_months(gold, "trade_date", as_of, months)
        .select(
            "symbol", "trade_date", "open_price", "high_price", "low_price", "close_price",
            "volume", "ma_7d", "ma_30d", "trend_signal", "data_source",
        )
        .orderBy("symbol", "trade_date")
    )


def store_gold(gold: DataFrame, path: str) -> None:
    """The gold fact by month, which months that are there again replace."""
    by_month = gold.withColumn(MONTH, F.trunc("trade_date", "month"))
    write_partitions(by_month, path, MONTH, ["symbol", "trade_date"])


def newest_day(gold: DataFrame) -> DataFrame:
    """The last day of a stored fact, looked for in its last month alone."""
    last = gold.agg(F.max(MONTH)).scalar()
    return gold.filter(F.col(MONTH) == last).agg(F.max("trade_date").alias("now"))


def stored_history(gold: DataFrame, months: int = 6, as_of: Clock | None = None) -> DataFrame:
    """As ``price_history`` from a stored fact: only the months in question are read.

    Averages are stored with the fact, so no rows before these months are needed.
    """
    clock = newest_day(gold) if as_of is None else as_of
    first = moment(
        gold, MONTH, clock, lambda now: F.trunc(F.add_months(now.cast("date"), -months), "month")
    )
    return price_history(gold.filter(F.col(MONTH) >= first), clock, months)


def top_movers(gold: DataFrame) -> DataFrame:
    """The last day with a known change per symbol, the largest moves first."""
    known = gold.filter(F.col("price_change_pct").isNotNull()).select(
        "symbol", "trade_date", "close_price", "price_change", "price_change_pct", "volume",
        "trend_signal",
    )
    latest = _latest_gold(known).drop("trade_date")
    return latest.withColumn("mover_type", mover_type(F.col("price_change_pct"))).orderBy(
        F.abs("price_change_pct").desc(), "symbol"
    )


def volume_leaders(gold: DataFrame) -> DataFrame:
    """The last day per symbol with volume against its average, the largest first."""
    latest = _latest_gold(
        gold.select(
            "symbol", "trade_date", "close_price", "volume", "volume_ma_7d", "volume_signal"
        )
    )
    whole = "decimal(20,0)"
    share = F.round(
        F.try_divide(F.col("volume").cast(whole), F.col("volume_ma_7d").cast(whole)) * 100, 2
    )
    return latest.select(
        "symbol", "close_price", "volume", "volume_ma_7d", share.alias("volume_vs_avg_pct"),
        "volume_signal",
    ).orderBy(F.col("volume").desc(), "symbol")
