"""Indices: membership, weighted daily performance, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.functions.measures import positive_ratio
from quotelake.operators.latest import first_rows_per
from quotelake.operators.lookups import effective_join


def cleaned_index(index: DataFrame) -> DataFrame:
    return index.select(
        "index_id",
        F.trim("index_code").alias("index_code"),
        F.trim("index_name").alias("index_name"),
        F.trim("description").alias("description"),
        "is_active",
    )


def current_membership(membership: DataFrame, index: DataFrame, company: DataFrame) -> DataFrame:
    """Current members with index and company attributes."""
    indices = index.select(
        "index_id", "index_code", "index_name", F.col("description").alias("index_description")
    )
    companies = company.select("company_id", "symbol", "company_name", "sector")
    return (
        membership.filter("is_current")
        .join(companies, "company_id")
        .join(indices, "index_id")
        .select(
            "membership_id", "index_id", "index_code", "index_name", "index_description",
            "company_id", "symbol", "company_name", "sector", "weight", "effective_date",
            "is_current",
        )
    )


def index_days(members: DataFrame, prices: DataFrame) -> DataFrame:
    """Weighted index values per index and day.

    Open and close are sums over members, high and low the extremes of single
    weighted prices. A member without a weight adds nothing. Rows are reduced to
    (index, day, symbol) first, so a symbol with several prices a day is one
    constituent whatever the prices hold.
    """
    columns = members.select("index_code", "index_name", "symbol", "weight", "effective_date")
    quotes = prices.select(
        "symbol", "trade_date", "open_price", "high_price", "low_price", "close_price", "volume"
    )
    joined = effective_join(columns, quotes, "symbol", "trade_date", "effective_date")
    weighted = {n: F.col(f"{n}_price") * F.col("weight") for n in ("open", "high", "low", "close")}
    members_days = joined.groupBy("index_code", "index_name", "trade_date", "symbol").agg(
        F.sum(weighted["open"]).alias("index_open"),
        F.max(weighted["high"]).alias("index_high"),
        F.min(weighted["low"]).alias("index_low"),
        F.sum(weighted["close"]).alias("index_close"),
        F.sum("volume").alias("total_volume"),
    )
    kinds = {f.name: f.dataType for f in joined.select(
        F.sum(weighted["open"]).alias("index_open"), F.sum(weighted["close"]).alias("index_close")
    ).schema.fields}
    return members_days.groupBy("index_code", "index_name", "trade_date").agg(
        F.sum("index_open").cast(kinds["index_open"]).alias("index_open"),
        F.max("index_high").alias("index_high"),
        F.min("index_low").alias("index_low"),
        F.sum("index_close").cast(kinds["index_close"]).alias("index_close"),
        F.sum("total_volume").alias("total_volume"),
        F.count("symbol").alias("constituents_count"),
    )


def index_performance(
    members: DataFrame,
    prices: DataFrame,
    previous: DataFrame | None = None,
) -> DataFrame:
    """Daily index values with change against the day before.

    For an incremental run ``prices`` holds the new days and ``previous`` the
    last index day already loaded, which is used and not repeated. One index has
    one row per day, so its window is bounded by the calendar.
    """
    days = index_days(members, prices).withColumn("_new", F.lit(True))
    if previous is not None:
        known = previous.select(*[c for c in days.columns if c != "_new"])
        days = days.unionByName(known.withColumn("_new", F.lit(False)))
    along = Window.partitionBy("index_code").orderBy("trade_date")
    close, before = F.col("index_close"), F.col("prev_close")
    spread = F.col("index_high") - F.col("index_low")
    return (
        days.withColumn("prev_close", F.lag("index_close").over(along))
        .filter("_new")
        .drop("_new")
        .withColumns(
            {
                "daily_change": close - before,
                "daily_change_pct": positive_ratio(close - before, before, 100),
                "intraday_range": spread,
                "intraday_range_pct": positive_ratio(spread, F.col("index_low"), 100),
            }
        )
    )


def member_counts(membership: DataFrame, index: DataFrame) -> DataFrame:
    """Current members per index, the largest first; members are counted before the join."""
    counts = membership.filter("is_current").groupBy("index_id").agg(F.count("*").alias("members"))
    return (
        counts.join(index.select("index_id", "index_code", "index_name"), "index_id")
        .groupBy("index_code", "index_name")
        .agg(F.sum("members").alias("members"))
        .orderBy(F.col("members").desc(), "index_code")
    )


def first_members(
    membership: DataFrame, index: DataFrame, company: DataFrame, n: int = 10
) -> DataFrame:
    """The first members of every index by symbol."""
    named = current_membership(membership, index, company).select(
        "index_code", "symbol", "company_name"
    )
    return first_rows_per(named, ["index_code"], ["symbol"], n)
