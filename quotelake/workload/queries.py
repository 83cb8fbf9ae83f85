"""Every registered query: a callable of (spark, sf_dir) over the whole supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.functions import calendar, text
from quotelake.operators import declared, incremental, latest, lookups, quality, series
from quotelake.plans import (
    companies, dimensions, financials, gold_run, indices, panels, points, prices,
)
from quotelake.session import scratch_path, tune
from quotelake.sources import batch_job, bronze, files, ingest, loaders, messages, sinks
from quotelake.streaming import live
from quotelake.streaming import ticks as tick_stream
from quotelake.workload import inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RUNS = (datetime(2024, 2, 1), datetime(2024, 2, 2), datetime(2024, 2, 3))


def portable(df: DataFrame) -> DataFrame:
    """Result types both engines print alike: text, BIGINT, DOUBLE and BOOLEAN."""
    columns: list[Column] = []
    for field in df.schema.fields:
        value, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            value = value.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            value = value.cast("bigint")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return portable(fn(spark, sf_dir))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# --- daily prices -----------------------------------------------------------


@query
def daily_prices_gold(spark, sf):
    """Gold daily fact over the large price table."""
    return prices.daily_prices(inputs.part_prices(spark, sf))


@query
def daily_prices_sliced(spark, sf):
    """The same fact with each symbol's series cut into yearly slices."""
    return prices.daily_prices(inputs.part_prices(spark, sf), F.year("trade_date"))


@query
def daily_prices_ranged(spark, sf):
    """The same fact with all rows cut into ranges of even size."""
    return prices.daily_prices(inputs.part_prices(spark, sf), by_range=True)


def _bars_by_symbol(spark, sf):
    """The price bars, stored in buckets of their symbol."""
    path = scratch_path(spark, "bars-by-symbol")
    return sinks.store_by_key(
        inputs.part_prices(spark, sf), path, "symbol", ["trade_date", "data_source"]
    )


@query
def daily_prices_stored(spark, sf):
    """The same fact from bars stored by symbol: no shuffle."""
    return prices.daily_prices(_bars_by_symbol(spark, sf))


@query
def daily_prices_ticks(spark, sf):
    """Gold daily fact over bars built from ticks."""
    return prices.daily_prices(inputs.tick_bars(spark, sf))


@query
def daily_prices_incremental(spark, sf):
    """Gold rows of the last five days, from these days and the carried rows."""
    bars = inputs.stored(inputs.tick_bars(spark, sf), "bars")
    cut = bars.select(F.date_sub(F.max("trade_date"), 5)).scalar()
    history = bars.filter(F.col("trade_date") <= cut)
    gold = inputs.stored(prices.daily_prices(history), "gold")
    carried = inputs.stored(prices.carry_rows(history), "carry")
    return prices.daily_prices_increment(prices.new_days(bars, gold), carried)


@query
def top_movers(spark, sf):
    return prices.top_movers(prices.daily_prices(inputs.part_prices(spark, sf)))


@query
def volume_leaders(spark, sf):
    return prices.volume_leaders(prices.daily_prices(inputs.part_prices(spark, sf)))


def _company_dimension(spark, sf, bars=None):
    company = inputs.company(spark, sf)
    stats = companies.market_stats(inputs.market_stat(spark, sf), company)
    bars = inputs.part_prices(spark, sf) if bars is None else bars
    return companies.company_dimension(company, stats, bars)


@query
def market_snapshot(spark, sf):
    bars = _bars_by_symbol(spark, sf)
    return prices.market_snapshot(prices.daily_prices(bars), _company_dimension(spark, sf, bars))


@query
def price_history(spark, sf):
    """Six months of the gold fact before its newest day, from the fact stored by month."""
    path = scratch_path(spark, "gold-by-month")
    prices.store_gold(prices.daily_prices(inputs.part_prices(spark, sf)), path)
    return prices.stored_history(spark.read.parquet(path))


@query
def dedup_latest_two_key(spark, sf):
    """One price per company and day by creation time, then id."""
    return prices.latest_stock_prices(inputs.stock_price(spark, sf))


@query
def unified_prices(spark, sf):
    """Typed prices from raw JSON rows with company attributes."""
    raw = inputs.prices_raw(spark, sf)
    known = inputs.company(spark, sf).select("symbol", "company_name", "sector")
    return prices.unified_prices(raw, known)


@query
def unified_prices_increment(spark, sf):
    """Only raw rows loaded after the newest load of the target."""
    raw = inputs.prices_raw(spark, sf)
    known = inputs.company(spark, sf).select("symbol", "company_name", "sector")
    target = raw.select(F.col("load_ts").alias("ingested_at")).filter("load_ts < '2001-01-01'")
    return prices.unified_prices(raw, known, target)


def _text_prices_raw(spark, sf):
    """Raw display-text prices, one per lineitem."""
    base = inputs.money("l_extendedprice")
    kind = F.col("l_linenumber") % 5 + 1
    day = F.to_date("l_shipdate")
    cells = inputs.table(spark, sf, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"),
        F.date_format(day, "E dd MMM ''yy").alias("date"),
        base.cast("string").alias("open"),
        F.when(kind != 1, base.cast("string")).otherwise(text.MISSING_SIGN).alias("high"),
        F.concat(F.lit(text.NARROW_SPACE), base.cast("string")).alias("low"),
        base.cast("string").alias("close"),
        F.concat(
            F.lit("+1.5 ("),
            F.when(kind == 2, text.MINUS_SIGN).otherwise(""),
            F.col("l_linenumber").cast("string"),
            F.lit(".5%)"),
        ).alias("change"),
        inputs.magnitude_text(F.col("l_quantity"), kind).alias("volume"),
        F.lit("no").alias("last_day"),
        F.col("l_orderkey").alias("_meta_order"),
        F.col("l_linenumber").alias("_meta_line"),
    )
    loaded = F.timestamp_add(
        "HOUR", F.col("_meta_line").cast("int"), F.lit(inputs.BATCH_TS).cast("timestamp")
    )
    name = F.concat(F.lit("prices/"), F.lpad(F.col("_meta_order").cast("string"), 12, "0"))
    return inputs.bronze_table(cells, name, loaded)


@query
def price_text_clean(spark, sf):
    """Display-text prices cleaned, the latest load per symbol and date."""
    return prices.text_prices(_text_prices_raw(spark, sf)).drop("load_ts")


@query
def fact_surrogate_key(spark, sf):
    """Dated prices with their md5 key."""
    facts = financials.price_facts(prices.text_prices(_text_prices_raw(spark, sf)))
    return facts.select("symbol", "date", "close", "volume", "price_id")


# --- indices ----------------------------------------------------------------


def _members(spark, sf):
    return indices.current_membership(
        inputs.membership(spark, sf),
        indices.cleaned_index(inputs.index_table(spark, sf)),
        inputs.company(spark, sf),
    )


@query
def index_staging(spark, sf):
    return indices.cleaned_index(inputs.index_table(spark, sf))


@query
def index_membership(spark, sf):
    return _members(spark, sf)


@query
def index_performance(spark, sf):
    return indices.index_performance(_members(spark, sf), inputs.part_prices(spark, sf))


@query
def index_performance_incremental(spark, sf):
    """Index days past the newest loaded one, using only that day of the past."""
    bars = inputs.stored(inputs.part_prices(spark, sf), "bars")
    members = _members(spark, sf)
    loaded = bars.select(F.date_sub(F.max("trade_date"), 30)).scalar()
    old = indices.index_days(members, bars.filter(F.col("trade_date") <= loaded))
    last = inputs.stored(
        latest.latest_by(old, ["index_code", "index_name"], ["trade_date"]), "index_days"
    )
    fresh = bars.filter(F.col("trade_date") > loaded)
    return indices.index_performance(members, fresh, last)


def _gold_runs(spark, sf):
    """Three stored runs over growing prices, the second called twice."""
    # A run reads its own days alone, so the bars are made per run and not stored before.
    bars, source = inputs.part_prices(spark, sf), inputs.stock_price(spark, sf)
    members = inputs.stored(_members(spark, sf), "members")
    root = scratch_path(spark, "gold-runs")
    newest = F.max("trade_date")
    for batch, back in ((1, 400), (2, 40), (2, 20), (3, 0)):
        known = source.select(F.date_sub(newest, back)).scalar()
        gold_run.run_gold(spark, root, batch, bars.filter(F.col("trade_date") <= known), members)
    return root


@query
def gold_incremental_run(spark, sf):
    """The gold daily fact after stored runs: what one run over all days gives."""
    return gold_run.read_prices(spark, _gold_runs(spark, sf))


@query
def index_incremental_run(spark, sf):
    """Index performance after stored runs."""
    return gold_run.read_index(spark, _gold_runs(spark, sf))


@query
def member_counts(spark, sf):
    return indices.member_counts(
        inputs.membership(spark, sf), indices.cleaned_index(inputs.index_table(spark, sf))
    )


@query
def members_top_n(spark, sf):
    return indices.first_members(
        inputs.membership(spark, sf),
        indices.cleaned_index(inputs.index_table(spark, sf)),
        inputs.company(spark, sf),
    )


@query
def last_index_rows(spark, sf):
    """The last ten ticks of every index ticker."""
    rows = inputs.ticks(spark, sf).filter(panels.is_index()).select("ticker", "time", "price")
    return latest.first_rows_per(rows, ["ticker"], [F.col("time").desc()], 10)


def _listed(spark, sf):
    """A list of symbols, some of them not companies."""
    return inputs.table(spark, sf, "lineitem").select(
        F.concat(F.lit(" p"), (F.col("l_partkey") + F.col("l_linenumber")).cast("string")).alias(
            "Symbol"
        )
    ).distinct()


@query
def equal_weight(spark, sf):
    """Equally weighted members from a list of symbols."""
    return loaders.load_membership(
        _listed(spark, sf), inputs.company(spark, sf), 2, F.lit("2024-01-01"), loaders.EQUAL
    )


@query
def derived_index_union(spark, sf):
    """Index over the distinct companies of two memberships."""
    company = inputs.company(spark, sf)
    day = F.lit("2024-01-01")
    first = loaders.load_membership(_listed(spark, sf), company, 1, day)
    second = inputs.membership(spark, sf).filter("is_current").select(*first.columns)
    return loaders.derive_index(first.unionByName(second), 3, day)


@query
def membership_table_runs(spark, sf):
    """The membership table after two lists and the index derived from them."""
    company, path = inputs.company(spark, sf), scratch_path(spark, "membership-table")
    day = F.lit("2024-01-01")
    listed = _listed(spark, sf)
    few = loaders.load_membership(listed.filter(F.length("Symbol") < 5), company, 1, day)
    loaders.append_memberships(path, 1, few)
    equal = loaders.load_membership(listed, company, 2, day, loaders.EQUAL)
    stored = loaders.append_memberships(path, 2, equal)
    derived = loaders.derive_index(stored, 3, day)
    return loaders.append_memberships(path, 3, derived.unionByName(few.select(*derived.columns)))


@query
def anti_unmatched(spark, sf):
    """Listed symbols that no company carries."""
    return loaders.unlisted_symbols(_listed(spark, sf), inputs.company(spark, sf))


# --- companies --------------------------------------------------------------


@query
def staged_companies(spark, sf):
    return companies.staged_companies(inputs.companies_raw(spark, sf))


@query
def completed_companies(spark, sf):
    return companies.completed_companies(inputs.company(spark, sf))


@query
def json_extract(spark, sf):
    """Company attributes out of raw JSON rows."""
    return companies.company_attributes(inputs.companies_raw(spark, sf))


@query
def market_stats(spark, sf):
    return companies.market_stats(inputs.market_stat(spark, sf), inputs.company(spark, sf))


@query
def market_stats_increment(spark, sf):
    """Statistics created after the newest one of the target."""
    stats = inputs.market_stat(spark, sf)
    target = stats.select(F.col("created_at").alias("ingested_at")).filter(
        "ingested_at < TIMESTAMP_NTZ '2000-01-01'"
    )
    return companies.market_stats(stats, inputs.company(spark, sf), target)


@query
def market_stats_latest(spark, sf):
    """The newest statistics per company."""
    stats = inputs.market_stat(spark, sf).select(
        "company_id", "snapshot_datetime", "stat_id", "price", "sector", "analyst_rating"
    )
    return latest.latest_by(stats, ["company_id"], ["snapshot_datetime", "stat_id"])


@query
def company_dim(spark, sf):
    return _company_dimension(spark, sf)


def _attributes(spark, sf):
    return companies.company_attributes(inputs.companies_raw(spark, sf))


@query
def company_star(spark, sf):
    """Companies with the ids of currency, sector, industry and location."""
    rows = _attributes(spark, sf)
    return companies.company_star(
        rows,
        dimensions.currency_dimension(spark),
        dimensions.numbered_dimension(rows, "sector"),
        dimensions.numbered_dimension(rows, "industry"),
        dimensions.location_dimension(rows),
    )


def _company_updates(spark, sf):
    return inputs.table(spark, sf, "supplier").select(
        F.concat(F.lit("P"), (F.col("s_suppkey") * 30).cast("string")).alias("symbol"),
        F.col("s_name").alias("company_name"),
        F.when(F.col("s_acctbal") > 5000, "Banks").alias("sector"),
        F.col("s_acctbal").cast("decimal(20,2)").alias("market_cap"),
        F.col("s_suppkey").alias("seq"),
    )


def _load_time():
    return F.lit(inputs.BATCH_TS).cast("timestamp_ntz")


@query
def merge_company(spark, sf):
    """Companies upserted by symbol with name, sector and market cap."""
    merged = loaders.upsert_companies(
        inputs.company(spark, sf), _company_updates(spark, sf), ["seq"], _load_time()
    )
    return merged.select(
        "company_id", "symbol", "company_name", "sector", "market_cap", "industry", "is_active",
        "created_at",
    )


@query
def company_ids_kept(spark, sf):
    """Ids after two loads: the second repeats the first one's companies and adds some."""
    updates = _company_updates(spark, sf)
    first = loaders.upsert_companies(
        inputs.company(spark, sf), updates.filter(F.col("seq") % 3 == 0), ["seq"], _load_time()
    )
    second = loaders.upsert_companies(
        inputs.stored(first, "company"), updates, ["seq"], _load_time()
    )
    return second.select("company_id", "symbol", "company_name")


@query
def merge_sector(spark, sf):
    """Companies with the sector of their newest statistics that name one."""
    merged = loaders.apply_latest_sector(
        inputs.company(spark, sf), inputs.market_stat(spark, sf).drop("stat_id")
    )
    return merged.select("company_id", "symbol", "sector")


@query
def semi_active(spark, sf):
    """Companies that have prices or statistics."""
    active = lookups.distinct_union(
        "company_id",
        inputs.stock_price(spark, sf),
        inputs.market_stat(spark, sf),
    )
    rows = inputs.company(spark, sf)
    return lookups.active_only(rows, active, F.col("company_id"), "company_id").select(
        "company_id", "symbol"
    )


def _price_rows(spark, sf):
    return inputs.stock_price(spark, sf).select(
        F.concat(F.lit("P"), (F.col("company_id") + F.col("volume")).cast("string")).alias(
            "symbol"
        ),
        "trade_date",
        F.when(F.col("volume") > 20, F.col("open_price")).alias("open"),
        F.col("close_price").alias("close"),
        F.when(F.col("volume") > 5, F.col("volume")).alias("volume"),
    )


@query
def price_load(spark, sf):
    """Daily price rows with their company id; unknown symbols drop out."""
    loaded = loaders.load_prices(
        _price_rows(spark, sf), inputs.company(spark, sf), F.lit(inputs.BATCH_TS).cast("timestamp")
    )
    return loaded.drop("created_at")


@query
def price_table_runs(spark, sf):
    """The price table after two loads, the second repeated and with the first one's days."""
    rows, company = _price_rows(spark, sf), inputs.company(spark, sf)
    path = scratch_path(spark, "price-table")
    early = rows.filter(F.col("trade_date") < F.lit("1998-01-01").cast("date"))
    for batch, arrived in ((1, early), (2, rows), (2, rows)):
        table = loaders.append_prices(
            path, batch, arrived, company, _load_time(),
            latest=["close_price", "volume", "open_price"],
        )
    return table


def _snapshot_rows(spark, sf):
    kind = inputs.priority_kind()
    total = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    # Few row groups would mean few tasks for the cleaning of the text.
    narrow = inputs.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    return narrow.repartition("o_orderkey").select(
        F.concat(
            F.lit(" p"), F.col("o_custkey").cast("string"), F.lit(" Some Company")
        ).alias("Symbol"),
        F.concat(total, F.lit(" EGP")).alias("Price"),
        F.concat(F.when(kind < 3, text.MINUS_SIGN).otherwise("+"), F.lit("2.5%")).alias(
            "Change %"
        ),
        F.when(kind == 5, text.EM_DASH).otherwise(F.concat(total, F.lit(" K"))).alias("Volume"),
        F.lit("1,250.5").alias("Rel Volume"),
        F.concat(total, F.lit(" M")).alias("Market cap"),
        F.when(kind == 1, "-").otherwise(total).alias("P/E"),
        F.lit("n/a").alias("EPS dil TTM"),
        F.lit("").alias("EPS dil growth TTM YoY"),
        F.lit("3.25%").alias("Div yield % TTM"),
        F.concat(F.col("o_orderpriority"), F.lit(" ")).alias("Sector"),
        F.lit(None).cast("string").alias("Analyst Rating"),
    )


@query
def market_stat_load(spark, sf):
    """Market snapshot rows with text numbers cleaned."""
    return loaders.load_market_stats(
        _snapshot_rows(spark, sf), inputs.company(spark, sf), F.lit(inputs.BATCH_TS).cast("timestamp")
    ).drop("snapshot_datetime")


@query
def market_stat_table_runs(spark, sf):
    """The statistics table after two snapshots, the second one loaded twice."""
    rows, company = _snapshot_rows(spark, sf), inputs.company(spark, sf)
    path = scratch_path(spark, "stat-table")
    for batch, ts in ((1, RUNS[0]), (2, RUNS[1]), (2, RUNS[1])):
        table = loaders.append_market_stats(
            path, batch, rows, company, F.lit(ts).cast("timestamp_ntz"), _load_time()
        )
    return table.select("stat_id", "company_id", "snapshot_datetime", "price", "volume", "sector")


# --- statements and text ----------------------------------------------------


@query
def financial_ratios(spark, sf):
    """Margins and ratios per customer and quarter."""
    rows = inputs.statements(spark, sf).select(
        "*",
        F.lit(None).cast("string").alias("company_name"),
        F.lit(None).cast("string").alias("sector"),
        F.year("quarter").alias("fiscal_year"),
        F.quarter("quarter").alias("fiscal_quarter"),
        F.lit(inputs.BATCH_TS).cast("timestamp").alias("ingested_at"),
    )
    return financials.financial_ratios(rows).drop("ingested_at", "company_name", "sector")


@query
def staged_financials(spark, sf):
    """Typed statements from raw rows with company attributes, key (symbol, quarter)."""
    rows = inputs.statements(spark, sf).select(
        F.col("symbol").alias("_ingest_symbol"),
        inputs.quarter_text(F.col("quarter")).alias("quarter"),
        F.year("quarter").cast("string").alias("fiscal_year"),
        *[
            F.col(m).cast("decimal(20,2)").cast("string").alias(m)
            for m in ("total_revenue", "gross_profit", "net_income", "total_assets",
                      "total_liabilities")
        ],
    )
    raw = inputs.raw_rows(rows, "finances/all", F.lit(inputs.BATCH_TS).cast("timestamp"))
    known = inputs.table(spark, sf, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("sector"),
    )
    return financials.staged_financials(raw, known).drop("ingested_at")


@query
def staged_financials_text(spark, sf):
    """Typed statements from display text of all eight metrics, the latest load per quarter."""
    kind, total = inputs.priority_kind(), F.col("o_totalprice")
    cells = inputs.table(spark, sf, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("_ingest_symbol"),
        F.when(F.col("o_orderstatus") != "P", inputs.quarter_text(F.col("o_orderdate")))
        .otherwise("TTM")
        .alias("Quarter"),
        inputs.magnitude_text(total, kind).alias("total_revenue"),
        inputs.magnitude_text(total, kind % 5 + 1).alias("gross_profit"),
        inputs.magnitude_text(total * 2, F.lit(1)).alias("net_income"),
        F.concat(
            F.when(kind == 2, text.MINUS_SIGN).otherwise(""),
            F.col("o_custkey").cast("string"),
            F.lit(".25"),
        ).alias("eps"),
        inputs.magnitude_text(total, (kind + 1) % 5 + 1).alias("operating_expense"),
        inputs.magnitude_text(total, F.lit(2)).alias("total_assets"),
        F.when(kind != 5, inputs.magnitude_text(total, F.lit(5)))
        .otherwise("n/a")
        .alias("total_liabilities"),
        F.when(kind != 3, inputs.magnitude_text(total, kind)).alias("free_cash_flow"),
        F.col("o_orderdate").alias("_meta_loaded"),
    )
    known = inputs.table(spark, sf, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("sector"),
    )
    raw = inputs.raw_rows(cells, "finances/all", F.col("_meta_loaded"))
    return financials.staged_financials(raw, known).drop("ingested_at")


@query
def magnitude_parse(spark, sf):
    """Display-text statements as numbers."""
    return financials.text_financials(inputs.finance_raw(spark, sf)).drop("load_ts")


@query
def financial_facts(spark, sf):
    """Dated statements with their md5 key."""
    facts = financials.financial_facts(financials.text_financials(inputs.finance_raw(spark, sf)))
    return facts.select("symbol", "quarter_date", "total_revenue", "file_name", "financial_id")


@query
def trimmed_statements(spark, sf):
    """Statement text trimmed, with fiscal year and quarter."""
    rows = inputs.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("company_id"),
        F.concat(F.lit(" c"), F.col("o_custkey").cast("string"), F.lit(" ")).alias("symbol"),
        F.concat(F.lit(" "), inputs.quarter_text(F.col("o_orderdate"))).alias("quarter"),
        *[
            F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit(name), F.lit(" ")).alias(name)
            for name in ("total_revenue", "gross_profit", "net_income", "eps",
                         "operating_expense", "total_assets", "total_liabilities",
                         "free_cash_flow")
        ],
    )
    return financials.trimmed_statements(rows)


@query
def quarter_parse(spark, sf):
    """First day of the quarter from texts such as Q4 '24."""
    label = F.when(
        F.col("o_orderstatus") == "P", F.concat(F.lit("H1 "), F.date_format("o_orderdate", "yy"))
    ).otherwise(inputs.quarter_text(F.col("o_orderdate")))
    return inputs.table(spark, sf, "orders").select(
        "o_orderkey", label.alias("quarter"), text.quarter_start(label).alias("quarter_date")
    )


@query
def volume_parse(spark, sf):
    """Volume and number cells with units, signs, dashes and commas."""
    kind = inputs.priority_kind()
    total = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    volume = (
        F.when(kind == 1, F.concat(total, F.lit(" m")))
        .when(kind == 2, F.concat(F.lit("K "), total))
        .when(kind == 3, F.concat(F.lit("1,"), total))
        .when(kind == 4, text.EM_DASH)
        .otherwise(F.concat(total, F.lit("B")))
    )
    number = (
        F.when(kind == 1, F.concat(F.lit("EGP "), total))
        .when(kind == 2, F.concat(F.lit(text.MINUS_SIGN), total, F.lit("%")))
        .when(kind == 3, F.concat(F.lit("+1,"), total))
        .when(kind == 4, "-")
        .otherwise(F.concat(total, F.lit("x")))
    )
    return inputs.table(spark, sf, "orders").select(
        "o_orderkey",
        text.parse_volume(volume).alias("volume"),
        text.clean_numeric(number).alias("number"),
    )


@query
def change_pct_parse(spark, sf):
    """The percent part of change cells."""
    cell = F.concat(
        F.when(F.col("l_returnflag") == "R", "-").otherwise("+"),
        F.col("l_quantity").cast("int").cast("string"),
        F.lit(" ("),
        F.when(F.col("l_returnflag") == "R", text.MINUS_SIGN)
        .when(F.col("l_returnflag") == "A", "+")
        .otherwise(""),
        F.col("l_tax").cast("decimal(18,2)").cast("string"),
        F.when(F.col("l_linenumber") == 3, ")").otherwise("%)"),
    )
    return inputs.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", text.change_percent(cell).alias("change_pct")
    )


@query
def unit_convert(spark, sf):
    """B/M/K units in either case."""
    kind = inputs.priority_kind()
    plain = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    cell = (
        F.when(kind == 1, F.concat(plain, F.lit("b")))
        .when(kind == 2, F.concat(plain, F.lit("M")))
        .when(kind == 3, F.concat(plain, F.lit(" k")))
        .when(kind == 4, F.concat(F.lit("USD"), plain))
        .otherwise("none")
    )
    return inputs.table(spark, sf, "orders").select(
        "o_orderkey", text.convert_units(cell).alias("value")
    )


# --- dimensions -------------------------------------------------------------


@query
def dim_sector_dense(spark, sf):
    return dimensions.numbered_dimension(_attributes(spark, sf), "sector")


@query
def dim_industry_dense(spark, sf):
    """Customer names numbered in name order; cut into ranges once there are many."""
    rows = inputs.table(spark, sf, "customer").select(F.col("c_name").alias("industry"))
    return dimensions.numbered_dimension(rows, "industry")


@query
def dim_sector_hash(spark, sf):
    return dimensions.hashed_dimension(
        companies.completed_companies(inputs.company(spark, sf)), "sector"
    )


@query
def dim_industry_hash(spark, sf):
    return dimensions.hashed_dimension(
        companies.completed_companies(inputs.company(spark, sf)), "industry"
    )


@query
def dim_location(spark, sf):
    return dimensions.location_dimension(_attributes(spark, sf))


@query
def dim_date(spark, sf):
    """Calendar from the first to the last order."""
    bounds = inputs.table(spark, sf, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"),
        F.to_date(F.max("o_orderdate")).alias("last"),
    )
    return dimensions.date_dimension(dimensions.days_between(bounds, "first", "last"))


# --- live panels ------------------------------------------------------------


@query
def market_status_latest(spark, sf):
    return panels.market_status(inputs.ticks(spark, sf))


@query
def index_panel(spark, sf):
    return panels.index_panel(inputs.ticks(spark, sf))


@query
def price_series_30m(spark, sf):
    return panels.price_series(inputs.ticks(spark, sf), inputs.clock(spark, sf))


@query
def gainers_top10(spark, sf):
    return panels.movers(inputs.ticks(spark, sf))


@query
def losers_top10(spark, sf):
    return panels.movers(inputs.ticks(spark, sf), losers=True)


@query
def volume_top10(spark, sf):
    """The volume panel over six hours, as five minutes hold few ticks here."""
    return panels.volume_ranking(inputs.ticks(spark, sf), inputs.clock(spark, sf), "6 hours")


@query
def active_count_5m(spark, sf):
    return panels.active_tickers(inputs.ticks(spark, sf), inputs.clock(spark, sf))


@query
def avg_price_5m(spark, sf):
    return panels.average_price(inputs.ticks(spark, sf), inputs.clock(spark, sf))


@query
def total_volume_5m(spark, sf):
    return panels.total_volume(inputs.ticks(spark, sf), inputs.clock(spark, sf))


@query
def index_values_24h(spark, sf):
    """Last close of the index symbols over the whole series."""
    return points.index_values(
        inputs.points(spark, sf), inputs.midnight(spark, sf), "30 days"
    )


@query
def volume_top10_24h(spark, sf):
    return points.volume_top(inputs.points(spark, sf), inputs.midnight(spark, sf))


@query
def net_gainers_7d(spark, sf):
    return points.net_movers(inputs.points(spark, sf), inputs.midnight(spark, sf))


@query
def net_losers_7d(spark, sf):
    return points.net_movers(inputs.points(spark, sf), inputs.midnight(spark, sf), losers=True)


@query
def net_change_7d(spark, sf):
    return points.net_change(inputs.points(spark, sf), inputs.midnight(spark, sf))


@query
def volatility_7d(spark, sf):
    return points.volatility(inputs.points(spark, sf), inputs.midnight(spark, sf))


@query
def latest_pivot(spark, sf):
    """Last close and volume per symbol, as columns."""
    rows = messages.field_rows(inputs.points(spark, sf), ["close", "volume"])
    return points.latest_fields(rows, inputs.midnight(spark, sf), ["close", "volume"])


@query
def daily_last_downsample(spark, sf):
    return points.daily_last(inputs.points(spark, sf), inputs.midnight(spark, sf))


@query
def volume_share_24h(spark, sf):
    return points.volume_share(inputs.points(spark, sf), inputs.midnight(spark, sf))


@query
def consecutive_difference(spark, sf):
    """Each tick's price against the one before it, in slices of even size."""
    rows = inputs.ticks(spark, sf).select("ticker", "time", "price")
    return series.consecutive_difference(rows, "ticker", ["time"], "price")


@query
def market_hours(spark, sf):
    """Ticks by market state and hour."""
    rows = inputs.table(spark, sf, "events")
    return rows.groupBy(
        calendar.market_state(F.col("ts")).alias("state"), F.hour("ts").alias("utc_hour")
    ).agg(F.count("*").alias("ticks"))


# --- quality ----------------------------------------------------------------


@query
def load_verify(spark, sf):
    rows = inputs.stock_price(spark, sf)
    return quality.load_verification(
        rows, "created_at", F.upper(F.trim("data_source")), "company_id"
    )


@query
def ohlc_quality(spark, sf):
    """Rows with high below low and rows without close on the latest load day."""
    rows = inputs.stock_price(spark, sf).select(
        (F.col("high_price") - F.col("volume") * 2).alias("high"),
        F.col("low_price").alias("low"),
        F.when(F.col("volume") < 40, F.col("close_price")).alias("close"),
        "created_at",
    )
    return quality.ohlc_gate(rows, "created_at")


@query
def freshness(spark, sf):
    rows = inputs.ticks(spark, sf)
    return quality.freshness(rows, "time", "ticker", inputs.clock(spark, sf), "24 hours")


@query
def dq_report(spark, sf):
    """Not-null, unique, accepted-values, relationship and range checks."""
    company = inputs.company(spark, sf)
    price = declared.Checks("stock_price").holds("open_price", F.col("open_price") >= 1000)
    price.at_least(100).unique("company_id", "trade_date")
    price.related("company_id", company, "company_id")
    stats = declared.Checks("market_stat").accepted("sector", ["1-URGENT", "2-HIGH"], "warn")
    stats.related("company_id", company, "company_id", "warn")
    names = declared.Checks("company").not_null("symbol", "sector", "is_active").unique("symbol")
    return quality.combine(
        names.report(company),
        price.report(inputs.stock_price(spark, sf)),
        stats.report(inputs.market_stat(spark, sf)),
        quality.freshness_check(
            inputs.ticks(spark, sf), "ticks", "time", inputs.clock(spark, sf)
        ),
    )


@query
def gold_checks(spark, sf):
    """The declared checks of the gold price fact, taken while it is written."""
    bounds = inputs.table(spark, sf, "lineitem").agg(
        F.to_date(F.min("l_shipdate")).alias("first"), F.to_date(F.max("l_shipdate")).alias("last")
    )
    days = dimensions.date_dimension(dimensions.days_between(bounds, "first", "last"))
    checks = (
        declared.Checks("gold_daily_prices")
        .not_null("symbol", "trade_date", "close_price", "price_change")
        .accepted("trend_signal", ["BULLISH", "BEARISH", "NEUTRAL"])
        .accepted("volume_signal", ["HIGH", "NORMAL", "LOW"])
        .accepted("data_source", ["A", "N"], "warn")
        .holds("volume", F.col("volume") >= 0)
        .unique("symbol", "trade_date")
        .related("trade_date", days, "date")
    )
    gold = prices.daily_prices(inputs.part_prices(spark, sf))
    return checks.write(gold, scratch_path(spark, "gold"))


@query
def gold_table_checks(spark, sf):
    """The declared checks of the other gold tables, each taken while it is written."""
    out = scratch_path(spark, "checked")
    company = declared.Checks("gold_dim_company").unique("company_id").unique("symbol")
    company.not_null("company_id", "symbol", "company_name", "sector")
    index = declared.Checks("gold_fct_index_performance").not_null("index_code", "trade_date")
    index.not_null("prev_close", "index_open", severity="warn")
    days = declared.Checks("dim_date").unique("date").not_null("date")
    calendar_days = dim_date(spark, sf)
    parts = [
        company.write(_company_dimension(spark, sf), f"{out}/company"),
        index.write(
            indices.index_performance(_members(spark, sf), inputs.part_prices(spark, sf)),
            f"{out}/index",
        ),
        days.write(calendar_days, f"{out}/days"),
    ]
    listed = companies.completed_companies(inputs.company(spark, sf))
    for name in ("sector", "industry"):
        dimension = dimensions.hashed_dimension(listed, name)
        checks = declared.Checks(f"dim_{name}").unique(f"{name}_id")
        parts.append(checks.not_null(f"{name}_id", name).write(dimension, f"{out}/{name}"))
    facts = financials.financial_facts(financials.text_financials(inputs.finance_raw(spark, sf)))
    customers = inputs.table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol")
    )
    statements = (
        declared.Checks("fct_financials")
        .not_null("financial_id", "symbol", "quarter_date", "total_revenue")
        .holds("total_revenue", F.col("total_revenue") >= 0)
        .unique("financial_id")
        .related("symbol", customers, "symbol")
        .related("quarter_date", spark.read.parquet(f"{out}/days"), "date", "warn")
    )
    return quality.combine(
        *parts,
        statements.write(
            facts.select(
                "financial_id", "symbol",
                F.date_format("quarter_date", "yyyy-MM-dd").alias("quarter_date"),
                "total_revenue",
            ),
            f"{out}/statements",
        ),
    )


@query
def row_counts(spark, sf):
    return quality.row_counts(
        {
            "company": inputs.company(spark, sf),
            "market_stat": inputs.market_stat(spark, sf),
            "stock_price": inputs.stock_price(spark, sf),
            "ticks": inputs.ticks(spark, sf),
        }
    )


@query
def sector_coverage(spark, sf):
    return quality.coverage(inputs.company(spark, sf), "sector")


@query
def orphan_report(spark, sf):
    """Statistics whose company is unknown, per company id."""
    rows = inputs.market_stat(spark, sf).select("stat_id", "company_id")
    lost = lookups.unmatched(
        rows, inputs.company(spark, sf), F.col("company_id"), "company_id"
    )
    return lost.agg(F.count("*").alias("orphans"))


# --- incremental ------------------------------------------------------------


@query
def watermark_filter(spark, sf):
    """Statistics newer than the target's newest one."""
    stats = inputs.market_stat(spark, sf).select("stat_id", "created_at")
    target = stats.filter("created_at < TIMESTAMP_NTZ '2001-01-01'")
    return incremental.newer_than_target(stats, target, "created_at")


@query
def latest_load_day(spark, sf):
    rows = inputs.stock_price(spark, sf).select("price_id", "company_id", "created_at")
    return incremental.latest_day_only(rows, "created_at")


@query
def merge_prices(spark, sf):
    """Whole price rows replaced or added by (company, day)."""
    rows = prices.latest_stock_prices(inputs.stock_price(spark, sf)).select(
        "company_id", "trade_date", "close_price", "volume"
    )
    base = rows.filter("volume <= 40")
    updates = rows.filter("volume > 25").withColumn("close_price", F.col("close_price") * 2)
    return incremental.merge_upsert(
        base, updates.withColumn("close_price", F.col("close_price").cast(inputs.MONEY)),
        ["company_id", "trade_date"],
    )


@query
def archive_split(spark, sf):
    """Rows and dates on either side of the retention limit."""
    rows = inputs.stock_price(spark, sf).select("price_id", "trade_date")
    newest = rows.agg(F.max("trade_date").alias("now"))
    due = incremental.archive_due(rows, "trade_date", newest, 360)
    return due.groupBy(F.when(F.col("due"), "archived").otherwise("kept").alias("side")).agg(
        F.count("*").alias("rows"),
        F.min("trade_date").alias("first"),
        F.max("trade_date").alias("last"),
    )


@query
def archive_repeated(spark, sf):
    """A table and its archive after two runs on different days and a late row's run."""
    path, archive = scratch_path(spark, "bars"), scratch_path(spark, "archive")
    bars = inputs.tick_bars(spark, sf).select("symbol", "trade_date", "volume")
    incremental.write_partitions(bars, path, "trade_date", ["symbol"])
    last = spark.read.parquet(path).agg(F.max("trade_date")).first()[0]
    if last is None:
        return bars.withColumn("side", F.lit("live"))
    for ahead in (0, 0, 2):
        incremental.archive_table(
            spark, path, archive, "trade_date", last + timedelta(days=ahead), 10
        )
    live, old = spark.read.parquet(path), spark.read.parquet(archive)
    return live.withColumn("side", F.lit("live")).unionByName(
        old.drop(incremental.ARCHIVED_FILE).withColumn("side", F.lit("archived"))
    )


@query
def schema_sync(spark, sf):
    """A table brought to the columns of its updates: one added, one dropped."""
    rows = inputs.company(spark, sf).select("company_id", "symbol", "sector")
    updates = inputs.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("company_id"),
        F.col("s_name").alias("symbol"),
        F.col("s_acctbal").alias("balance"),
    )
    return incremental.sync_schema(rows, updates)


@query
def partition_upsert(spark, sf):
    """A day-partitioned table after an upsert that touches some of its days."""
    rows = prices.latest_stock_prices(inputs.stock_price(spark, sf)).select(
        "company_id", F.trunc("trade_date", "year").alias("trade_year_start"), "trade_date",
        "close_price", "volume",
    )
    path = scratch_path(spark, "prices")
    incremental.write_partitions(rows, path, "trade_year_start", ["company_id", "trade_date"])
    updates = rows.filter("trade_date >= DATE '2001-01-01' AND volume > 25").withColumn(
        "close_price", F.col("close_price") + 1
    )
    incremental.upsert_table(
        spark,
        path,
        updates.withColumn("close_price", F.col("close_price").cast(inputs.MONEY)),
        ["company_id", "trade_year_start", "trade_date"],
        "trade_year_start",
    )
    return spark.read.parquet(path).drop("trade_year_start")


# --- sources ----------------------------------------------------------------


@query
def bar_messages(spark, sf):
    bars = inputs.tick_bars(spark, sf).select(
        "symbol",
        F.col("trade_date").alias("date"),
        F.col("open_price").alias("open"),
        F.col("high_price").alias("high"),
        F.col("low_price").alias("low"),
        F.col("close_price").alias("close"),
        "volume",
    )
    return messages.bar_messages(bars, F.lit(inputs.BATCH_TS).cast("timestamp"))


@query
def tagged_points(spark, sf):
    """Event messages as points; some lack a symbol, numbers or a readable time."""
    rows = inputs.table(spark, sf, "events")
    kind = F.col("event_type")
    sent = rows.select(
        F.when(kind != "error", F.concat(F.lit("S"), F.col("user_id").cast("string"))).alias(
            "symbol"
        ),
        F.when(kind != "view", F.col("value")).alias("close"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        F.when(kind == "click", "soon")
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .alias("datetime"),
    )
    return messages.tagged_points(sent, F.lit(inputs.BATCH_TS).cast("timestamp"))


@query
def first_links(spark, sf):
    """The first row of every URL by position."""
    rows = inputs.table(spark, sf, "events").select(
        F.col("event_id").alias("position"),
        F.col("event_type").alias("text"),
        F.concat(F.lit("/symbols/"), F.col("user_id").cast("string")).alias("url"),
    )
    return messages.first_links(rows)


@query
def statement_rows(spark, sf):
    """Arrays of quarters and metrics as one row per quarter."""
    count = F.col("p_size") % 11 + 1
    scraped = inputs.table(spark, sf, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"),
        F.transform(
            F.sequence(F.lit(1), count), lambda i: F.concat(F.lit("Q"), i.cast("string"))
        ).alias("quarters"),
        F.transform(
            F.sequence(F.lit(1), F.least(count, F.lit(8)) + F.col("p_size") % 2),
            lambda i: F.when(i == 2, text.EM_DASH).otherwise(
                F.concat(F.lit(text.BIDI_MARKS[0]), (i + F.col("p_size")).cast("string"))
            ),
        ).alias("net_income"),
        F.array().cast("array<string>").alias("eps"),
    )
    return messages.statement_rows(scraped, ["symbol"], ["net_income", "eps"])


@query
def route_files(spark, sf):
    """Target table by words in a path."""
    path = F.concat(F.lit("batch/"), F.col("p_type"), F.lit("/"), F.col("p_name"), F.lit(".csv"))
    mapped = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(path, "PROMO", "Company"), "SMALL", "OHLC"),
        "LARGE", "Financials",
    )
    return inputs.table(spark, sf, "part").select(
        "p_partkey", mapped.alias("path"), files.route(mapped).alias("target")
    )


def _price_landing(spark, sf, folder):
    """Lineitems as one price file per symbol."""
    rows = inputs.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("l_quantity"),
    )
    symbol = F.concat(F.lit("P"), (F.col("l_partkey") % 40).cast("string"))
    inputs.landing_files(rows, symbol, folder)


def _statement_landing(spark, sf, folder, where):
    """Orders as one statement file per symbol; the columns differ between files."""
    rows = inputs.table(spark, sf, "orders").filter(where)
    narrow = rows.select("o_orderkey", "o_totalprice", "o_custkey")
    wide = rows.select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")
    symbol = F.concat(F.lit("c"), (F.col("o_custkey") % 30).cast("string"))
    odd = F.col("o_custkey") % 2 == 1
    inputs.landing_files(narrow.filter(odd), symbol, folder, "_finance.csv")
    inputs.landing_files(wide.filter(~odd), symbol, folder, "_finance.csv")


def _bronze_rows(spark, path, names, numbers):
    """Members of the stored raw rows with the symbol of their file and their load."""
    text_rows = bronze.members(
        ingest.read_bronze(spark, path), [*names, bronze.INGEST_SYMBOL], ["load_ts"]
    )
    return text_rows.withColumns({n: F.col(n).cast(kind) for n, kind in numbers.items()})


@query
def bronze_load(spark, sf):
    """Suppliers written as CSV files, loaded as raw rows and read back typed."""
    out = scratch_path(spark, "bronze")
    rows = inputs.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    inputs.landing_files(rows, F.concat(F.lit("s"), F.col("s_suppkey") % 10), f"{out}/landing")
    ingest.ingest(spark, f"{out}/landing", f"{out}/table", f"{out}/ledger", RUNS[0])
    return _bronze_rows(
        spark, f"{out}/table", ["s_suppkey", "s_name", "s_acctbal", "absent"],
        {"s_suppkey": "bigint", "s_acctbal": "double"},
    )


@query
def bronze_prices(spark, sf):
    """The price load: one file per symbol, all lineitems."""
    out = scratch_path(spark, "bronze-prices")
    _price_landing(spark, sf, f"{out}/landing")
    ingest.ingest(spark, f"{out}/landing", f"{out}/table", f"{out}/ledger", RUNS[0])
    return _bronze_rows(
        spark, f"{out}/table", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"],
        {"l_orderkey": "bigint", "l_linenumber": "bigint", "l_extendedprice": "double",
         "l_quantity": "double"},
    )


@query
def bronze_statements(spark, sf):
    """The statement load: files whose columns differ, all orders."""
    out = scratch_path(spark, "bronze-statements")
    _statement_landing(spark, sf, f"{out}/landing", F.lit(True))
    ingest.ingest(
        spark, f"{out}/landing", f"{out}/table", f"{out}/ledger", RUNS[0], "_finance.csv",
        files_per_batch=7,
    )
    return _bronze_rows(
        spark, f"{out}/table", ["o_orderkey", "o_totalprice", "o_orderstatus"],
        {"o_orderkey": "bigint", "o_totalprice": "double"},
    )


@query
def bronze_companies(spark, sf):
    """The company load: rows of symbols that have a price or a statement file."""
    out = scratch_path(spark, "bronze-companies")
    _price_landing(spark, sf, f"{out}/prices")
    _statement_landing(spark, sf, f"{out}/finances", F.col("o_custkey") % 30 < 12)
    rows = inputs.table(spark, sf, "part").select(
        F.concat(
            F.when(F.col("p_size") % 2 == 0, " p").otherwise("C"),
            (F.col("p_partkey") % 60).cast("string"),
            F.lit(" "),
        ).alias("Symbol"),
        "p_partkey", "p_name",
    )
    inputs.landing_files(rows, F.lit("company_meta"), f"{out}/companies")
    symbols = bronze.real_symbols(
        files.list_files(spark, f"{out}/prices", "*.csv"),
        files.list_files(spark, f"{out}/finances", "*.csv"),
    )
    ingest.ingest(
        spark, f"{out}/companies", f"{out}/table", f"{out}/ledger", RUNS[0], symbols=symbols
    )
    return _bronze_rows(
        spark, f"{out}/table", ["Symbol", "p_partkey", "p_name"], {"p_partkey": "bigint"}
    )


def _three_runs(spark, sf, out, last_refreshes):
    """Two lots of files and a run after each, then one without new files; the batches of each."""
    early = F.col("o_custkey") % 30 < 18
    batches = []
    for run, (ts, lot) in enumerate(zip(RUNS, (early, ~early, None))):
        if lot is not None:
            _statement_landing(spark, sf, f"{out}/landing", lot)
            inputs.touch(spark, f"{out}/landing/void{run}_finance.csv")
            inputs.touch(spark, f"{out}/landing/head{run}_finance.csv", "o_orderkey,o_custkey")
        batches.append(
            ingest.ingest(
                spark, f"{out}/landing", f"{out}/table", f"{out}/ledger", ts, "_finance.csv",
                full_refresh=last_refreshes and run == 2,
            )
        )
    return batches


def _loaded_orders(spark, out):
    return _bronze_rows(spark, f"{out}/table", ["o_orderkey"], {"o_orderkey": "bigint"})


@query
def bronze_second_run(spark, sf):
    """Files that came after the first run are loaded by the second, and no file twice."""
    out = scratch_path(spark, "bronze-runs")
    _three_runs(spark, sf, out, False)
    return _loaded_orders(spark, out)


@query
def bronze_full_refresh(spark, sf):
    """A refresh after two runs loads all files again, once."""
    out = scratch_path(spark, "bronze-refresh")
    _three_runs(spark, sf, out, True)
    return _loaded_orders(spark, out)


@query
def bronze_status(spark, sf):
    """Files skipped, processed and empty as each of three runs saw them."""
    out = scratch_path(spark, "bronze-status")
    parts = [
        ingest.load_status(spark, f"{out}/table", f"{out}/ledger", batches).withColumn(
            "run", F.lit(run)
        )
        for run, batches in enumerate(_three_runs(spark, sf, out, False))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _drop_folder(spark, sf):
    """Company, price and other files of a drop folder; some price files have no close."""
    folder = scratch_path(spark, "drop")
    part = inputs.table(spark, sf, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"),
        F.col("p_name").alias("company_name"),
        F.when(F.col("p_size") > 10, F.col("p_type")).alias("sector"),
    )
    inputs.landing_files(part, F.lit("company_list"), folder)
    lines = inputs.stock_price(spark, sf).select(
        F.concat(F.lit("P"), (F.col("company_id") + F.col("volume")).cast("string")).alias("symbol"),
        F.when(F.col("volume") != 7, F.col("trade_date").cast("string"))
        .otherwise("soon")
        .alias("trade_date"),
        F.col("close_price").alias("close"),
        "volume",
    )
    name = F.concat(F.lit("ohlc"), (F.col("volume") % 5).cast("string"))
    inputs.landing_files(lines.filter("volume % 5 < 3"), name, folder)
    inputs.landing_files(lines.filter("volume % 5 = 3").drop("close"), name, folder)
    inputs.landing_files(lines.filter("volume % 5 = 4"), F.lit("notes"), folder)
    return folder


@query
def batch_job_report(spark, sf):
    """What became of each file of a drop folder."""
    root = scratch_path(spark, "batch-job")
    report = batch_job.load_recent(spark, _drop_folder(spark, sf), root, 1, _load_time())
    return report.withColumn("file_name", F.element_at(F.split("file_name", "/"), -1))


@query
def batch_job_prices(spark, sf):
    """The prices of a drop folder after the job and its repetition."""
    root, folder = scratch_path(spark, "batch-job"), _drop_folder(spark, sf)
    for batch in (1, 1, 2):
        batch_job.load_recent(spark, folder, root, batch, _load_time())
    return batch_job.stock_prices(spark, root).join(
        batch_job.companies(spark, root).select("company_id", "symbol", "sector"), "company_id"
    ).select("price_id", "company_id", "symbol", "sector", "trade_date", "close_price", "volume")


def _inventory(spark, sf):
    """Orders as files of eight symbols in a folder per status, listed."""
    folder = scratch_path(spark, "files")
    rows = inputs.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    symbol = F.concat(F.lit("C"), (F.col("o_custkey") % 8).cast("string"))
    for status in ("F", "O", "P"):
        of_status = rows.filter(F.col("o_orderstatus") == status).select("o_orderkey", "o_custkey")
        inputs.landing_files(of_status, symbol, f"{folder}/{status}")
    return files.inventory(files.list_files(spark, folder, "*.csv"), folder)


@query
def file_inventory(spark, sf):
    """Files, bytes, types and first names per folder of a written dataset."""
    return _inventory(spark, sf).withColumns(
        {"extensions": F.concat_ws(",", "extensions"), "sample": F.concat_ws(",", "sample")}
    )


@query
def expected_folders(spark, sf):
    """Whether the folders a load expects hold files."""
    return files.expected_prefixes(_inventory(spark, sf), ["F/", "O", "P", "TVH/"])


@query
def recent_file_rows(spark, sf):
    """Rows of the files changed in the last days, and of no other file."""
    folder = scratch_path(spark, "recent")
    rows = inputs.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    symbol = F.concat(F.lit("C"), (F.col("o_custkey") % 8).cast("string"))
    inputs.landing_files(rows, symbol, folder)
    old = F.col("file_name").rlike("/C[0-2][.]csv$")
    listing = files.list_files(spark, folder).withColumn(
        "modified", F.when(old, F.lit(RUNS[0])).otherwise(F.col("modified"))
    )
    recent = files.recent_files(listing, datetime.now() + timedelta(minutes=1), 3)
    typed = files.scan_csv_typed(
        spark, folder, T.StructType.fromDDL("o_orderkey bigint, o_totalprice double, o_custkey int")
    ).withColumn("file_name", F.col("_metadata.file_path"))
    return typed.join(recent.select("file_name"), "file_name", "left_semi").select(
        "o_orderkey", "o_totalprice", files.symbol_of(F.col("file_name")).alias("symbol")
    )


@query
def materialize_incremental(spark, sf):
    """A table created by a first run and merged into by a second."""
    name = f"quotelake_{scratch_path(spark, 't').rsplit('-', 1)[1]}"
    rows = inputs.company(spark, sf).select("company_id", "symbol", "sector")
    path = scratch_path(spark, "table")
    rows.filter("company_id < 1000").write.option("path", path).saveAsTable(name)
    updates = rows.filter("company_id >= 500").withColumn("sector", F.lit("Updated"))
    try:
        merged = sinks.materialize(updates, name, sinks.INCREMENTAL, ["company_id"])
        kept = scratch_path(spark, "result")
        merged.write.parquet(kept)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.parquet(kept)


# --- streams ----------------------------------------------------------------


def _event_stream(spark, sf):
    source = inputs.table(spark, sf, "events")
    reader = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet")
    return reader.parquet(sf)


def _tick_messages(spark, sf):
    return _as_messages(_event_stream(spark, sf))


def _as_messages(events):
    """Ticks as the JSON messages a producer sends, with an ISO time."""
    cells = inputs.tick_columns(events).withColumnRenamed("time", "timestamp")
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    sent = cells.withColumn("timestamp", iso).withColumns(
        {c: F.col(c).cast("double") for c in
         ("price", "open", "high", "low", "price_change", "price_change_percent")}
    )
    return tick_stream.keyed_messages(sent)


@query
def stream_ticks(spark, sf):
    """The tick stream: JSON messages to a typed day-partitioned table."""
    out = scratch_path(spark, "ticks")
    decoded = tick_stream.decode_ticks(_tick_messages(spark, sf))
    stream = tick_stream.start_tick_stream(
        decoded, tick_stream.tick_sink(f"{out}/table", f"{out}/rejected"), f"{out}/state", None
    )
    stream.awaitTermination()
    return tick_stream.read_ticks(spark, f"{out}/table").select(
        "ticker", "time", "price", "volume", "market_status", "trade_date"
    )


@query
def stream_days_closed(spark, sf):
    """Ticks after two streams of several batches, days closed by the watermark after each."""
    out = scratch_path(spark, "closing")
    events = inputs.table(spark, sf, "events")
    middle = events.agg(F.percentile_approx("ts", 0.6)).scalar()
    for lot in (F.col("ts") < middle, F.col("ts") >= middle):
        events.filter(lot).repartitionByRange(3, "ts").write.mode("append").parquet(f"{out}/events")
        arriving = (
            spark.readStream.schema(events.schema)
            .option("maxFilesPerTrigger", 1)
            .parquet(f"{out}/events")
        )
        stream = tick_stream.start_tick_stream(
            tick_stream.decode_ticks(_as_messages(arriving)),
            tick_stream.tick_sink(f"{out}/table", f"{out}/rejected"),
            f"{out}/state",
            None,
        )
        stream.awaitTermination()
        tick_stream.close_days(spark, f"{out}/table", tick_stream.watermark_day(stream))
    return tick_stream.read_ticks(spark, f"{out}/table").select(
        "ticker", "time", "price", "volume", "market_status", "trade_date"
    )


@query
def stream_live_stats(spark, sf):
    """Rolling statistics from the stream, for windows the watermark has closed."""
    out = scratch_path(spark, "rolling")
    ticks = inputs.tick_columns(_event_stream(spark, sf)).select(
        "ticker", F.col("time").cast("timestamp").alias("time"), "price", "volume"
    )
    stats = live.rolling_statistics(live.once_per_tick(ticks), "1 hour", "30 minutes", None)
    stream = (
        stats.writeStream.outputMode("append")
        .option("checkpointLocation", f"{out}/state")
        .option("path", f"{out}/table")
        .format("parquet")
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return spark.read.parquet(f"{out}/table")


@query
def rolling_statistics(spark, sf):
    """The rolling statistics as a batch over the whole tick table."""
    ticks = inputs.ticks(spark, sf).select("ticker", "time", "price", "volume")
    return live.rolling_statistics(ticks, "1 hour", "30 minutes", None)


@query
def stream_latest(spark, sf):
    """The live state of every ticker from the stream."""
    out = scratch_path(spark, "latest")
    ticks = inputs.tick_columns(_event_stream(spark, sf)).select(
        "ticker", "time", "price", "price_change_percent", "volume"
    )
    stream = live.start_latest_state(ticks, f"{out}/state", None)
    stream.awaitTermination()
    return live.read_latest_state(spark, f"{out}/state")
