"""Market inputs derived from the supplied tables.

No stock tables are supplied, so each logical input is a projection or
aggregation of whole supplied tables. Money is DECIMAL, so that sums do not
depend on how rows are spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions.calendar import market_state
from quotelake.functions.text import MINUS_SIGN, MISSING_SIGN, NARROW_SPACE
from quotelake.session import scratch_path, tune

MONEY = "decimal(18,4)"
BATCH_TS = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def tick_columns(events: DataFrame) -> DataFrame:
    """Ticks from event rows; sign-ups stand for index quotes. Also works on a stream."""
    size = F.get_json_object("props", "$.k").cast("bigint")
    price = money("value")
    return events.select(
        F.concat(
            F.when(F.col("event_type") == "signup", "EGX").otherwise("S"),
            F.col("user_id").cast("string"),
        ).alias("ticker"),
        F.concat(F.lit("Company "), F.col("user_id").cast("string")).alias("company_name"),
        price.alias("price"),
        price.alias("open"),
        (price + size.cast(MONEY)).cast(MONEY).alias("high"),
        (price - F.lit("0.5").cast(MONEY)).cast(MONEY).alias("low"),
        size.alias("volume"),
        (price - size.cast(MONEY)).cast(MONEY).alias("price_change"),
        (price - size.cast(MONEY) * 2).cast(MONEY).alias("price_change_percent"),
        F.col("ts").alias("time"),
        market_state(F.col("ts")).alias("market_status"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tick_columns(table(spark, sf_dir, "events"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks(spark, sf_dir).select(
        F.col("ticker").alias("symbol"), "time", "open", "high", "low",
        F.col("price").alias("close"), "volume",
    )


def clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest tick's time, as a table of one row."""
    return table(spark, sf_dir, "events").agg(F.max("ts").alias("now"))


def midnight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end of the newest tick's day, as a table of one row."""
    day = F.date_trunc("day", F.max("ts")) + F.expr("INTERVAL 1 DAY")
    return table(spark, sf_dir, "events").agg(day.alias("now"))


def landing_files(df: DataFrame, symbol: Column, folder: str, suffix: str = ".csv") -> None:
    """A CSV file ``<symbol><suffix>`` per symbol, as a scraper leaves them."""
    spark = df.sparkSession
    written = scratch_path(spark, "parts")
    rows = df.withColumn("_symbol", symbol).repartition("_symbol")
    (
        rows.write.partitionBy("_symbol")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(written)
    )
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    found = hadoop.Path(f"{written}/_symbol=*/part-*")
    store = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(hadoop.Path(folder))
    for status in store.globStatus(found):
        path = status.getPath()
        name = path.getParent().getName().split("=", 1)[1] + suffix
        store.rename(path, hadoop.Path(f"{folder}/{name}"))


def touch(spark: SparkSession, path: str, text: str = "") -> None:
    """A file that holds just this text."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    name = hadoop.Path(path)
    out = name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(name)
    out.writeBytes(text)
    out.close()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back as a table."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def tick_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of the ticks."""
    bars = (
        ticks(spark, sf_dir)
        .groupBy(F.col("ticker").alias("symbol"), F.to_date("time").alias("trade_date"))
        .agg(
            F.min(F.struct("time", "price")).alias("_first"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max(F.struct("time", "price")).alias("_last"),
            F.sum("volume").alias("volume"),
        )
    )
    return bars.select(
        "symbol",
        "trade_date",
        F.col("_first.price").alias("open_price"),
        "high_price",
        "low_price",
        F.col("_last.price").alias("close_price"),
        "volume",
        F.lit("STREAMING_API").alias("data_source"),
    )


def stock_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large price table; a part and day may hold several rows."""
    base = money("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("price_id"),
        F.col("l_partkey").cast("int").alias("company_id"),
        F.to_date("l_shipdate").alias("trade_date"),
        base.alias("open_price"),
        (base + money("l_quantity")).cast(MONEY).alias("high_price"),
        (base - money("l_discount")).cast(MONEY).alias("low_price"),
        (base + money("l_tax")).cast(MONEY).alias("close_price"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.concat(F.lit(" "), F.lower("l_returnflag"), F.lit(" ")).alias("data_source"),
        F.timestamp_add("DAY", F.col("l_suppkey").cast("int"), F.col("l_shipdate")).alias(
            "created_at"
        ),
    )


def part_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large price table, one row per symbol and day."""
    from quotelake.plans.prices import latest_stock_prices

    symbol = F.concat(F.lit("P"), F.col("company_id").cast("string"))
    rows = stock_price(spark, sf_dir).withColumn("symbol", symbol)
    return latest_stock_prices(rows, "symbol").select(
        "symbol", "trade_date", "open_price", "high_price", "low_price", "close_price", "volume",
        "data_source",
    )


def company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies from parts; small ones lack a sector, a rating or a flag."""
    small = F.col("p_size") <= 10
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("company_id"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"),
        F.col("p_name").alias("company_name"),
        F.when(~small, F.col("p_type")).alias("sector"),
        F.col("p_brand").alias("industry"),
        F.col("p_retailprice").cast("decimal(20,2)").alias("market_cap"),
        F.lit(None).cast("string").alias("logo_url"),
        F.when(F.col("p_size") > 25, "Buy").alias("analyst_rating"),
        F.when(~small, F.col("p_size") < 40).alias("is_active"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
        F.lit("2024-01-02 00:00:00").cast("timestamp_ntz").alias("updated_at"),
    )


def brand_number() -> Column:
    return F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int")


def index_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One index per brand."""
    return table(spark, sf_dir, "part").select("p_brand").distinct().select(
        brand_number().alias("index_id"),
        F.concat(F.lit(" "), F.col("p_brand")).alias("index_code"),
        F.concat(F.lit("Index of "), F.col("p_brand"), F.lit(" ")).alias("index_name"),
        F.col("p_brand").alias("description"),
        F.lit(True).alias("is_active"),
    )


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part is a member of its brand's index, weighted by size."""
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("membership_id"),
        brand_number().alias("index_id"),
        F.col("p_partkey").cast("int").alias("company_id"),
        F.when(size > 5, size.cast("decimal(8,4)")).alias("weight"),
        F.date_add(F.lit("1995-01-01").cast("date"), size * 20).alias("effective_date"),
        (size < 45).alias("is_current"),
    )


def market_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market snapshots from orders; finished ones name no sector."""
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("stat_id"),
        F.col("o_custkey").cast("int").alias("company_id"),
        F.col("o_orderdate").alias("snapshot_datetime"),
        money(price).alias("price"),
        F.lit("1.5").cast("decimal(8,4)").alias("change_pct"),
        F.col("o_orderkey").alias("volume"),
        F.lit("1").cast("decimal(10,2)").alias("relative_volume"),
        price.cast("decimal(20,2)").alias("market_cap"),
        F.when(F.col("o_orderstatus") != "P", money(price)).alias("pe_ratio"),
        money(price).alias("eps_ttm"),
        F.lit("0.5").cast("decimal(8,4)").alias("eps_growth_yoy"),
        F.lit("2.25").cast("decimal(8,4)").alias("div_yield_pct"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("sector"),
        F.when(F.col("o_orderstatus") == "O", "Sell").alias("analyst_rating"),
        F.col("o_orderdate").alias("created_at"),
    )


def raw_rows(df: DataFrame, file_name: Column | str, load_ts: Column) -> DataFrame:
    """Rows as a bronze table (file_name, load_ts, raw)."""
    name = F.lit(file_name) if isinstance(file_name, str) else file_name
    cells = [c for c in df.columns if not c.startswith("_meta_")]
    return df.select(
        name.alias("file_name"), load_ts.cast("timestamp").alias("load_ts"),
        F.to_variant_object(F.struct(*cells)).alias("raw"),
    )


def bronze_table(df: DataFrame, file_name: Column | str, load_ts: Column) -> DataFrame:
    """Raw rows as a stored bronze table of several files, as ingest leaves it."""
    files = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(raw_rows(df.repartition(files), file_name, load_ts), "bronze")


def companies_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw company rows from suppliers; two loads of each, the second with a sector."""
    nation = table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, "supplier").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    rows = rows.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("_meta_load"))
    first = F.col("_meta_load") == 1
    cells = rows.select(
        "_meta_load",
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"),
        F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("company_name"),
        F.when(F.col("s_nationkey") < 12, "EGP").otherwise(" usd ").alias("currency"),
        F.when(~first, F.concat(F.lit(" Sector "), F.col("n_regionkey").cast("string"))).alias(
            "sector"
        ),
        F.when(F.col("s_nationkey") > 4, F.col("n_name")).alias("industry"),
        F.lit("Head").alias("ceo_name"),
        F.lit(None).cast("string").alias("website"),
        F.concat(F.col("n_name"), F.lit(" - Block,"), F.col("s_nationkey").cast("string")).alias(
            "headquarters"
        ),
        F.lit("1999").alias("founded_date"),
        F.concat(F.lit("EG"), F.col("s_suppkey").cast("string")).alias("isin"),
        F.col("s_acctbal").cast("decimal(18,2)").cast("string").alias("market_cap"),
        F.lit(None).cast("string").alias("logo_url"),
    )
    load_ts = F.timestamp_add("DAY", F.col("_meta_load"), F.lit(BATCH_TS).cast("timestamp"))
    return raw_rows(cells, F.concat(F.lit("companies/"), F.col("_meta_load")), load_ts)


def prices_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw typed prices from lineitems; some lack the open or the volume."""
    cells = stock_price(spark, sf_dir).select(
        F.concat(F.lit("P"), F.col("company_id").cast("string")).alias("_ingest_symbol"),
        F.col("trade_date").cast("string").alias("trade_date"),
        F.when(F.col("volume") > 10, F.col("open_price")).cast("string").alias("open"),
        F.col("high_price").cast("string").alias("high"),
        F.col("low_price").cast("string").alias("low"),
        F.when(F.col("volume") > 2, F.col("close_price")).cast("string").alias("close"),
        F.when(F.col("volume") < 45, F.col("volume")).cast("string").alias("volume"),
        F.col("created_at").alias("_meta_created"),
    )
    return bronze_table(cells, "prices/all.csv", F.col("_meta_created"))


def magnitude_text(value: Column, kind: Column) -> Column:
    """A number as the sites print it; ``kind`` 1..5 picks the notation."""
    plain = value.cast("decimal(18,2)").cast("string")
    return (
        F.when(kind == 1, F.concat(plain, F.lit(NARROW_SPACE + "M")))
        .when(kind == 2, F.concat(plain, F.lit("K")))
        .when(kind == 3, F.concat(F.lit(MINUS_SIGN), plain, F.lit(" B")))
        .when(kind == 4, F.lit(MISSING_SIGN))
        .otherwise(plain)
    )


def priority_kind() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


def quarter_text(day: Column) -> Column:
    return F.concat(
        F.lit("Q"), F.quarter(day).cast("string"), F.lit(" '"), F.date_format(day, "yy")
    )


def finance_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text statements, one per order."""
    kind = priority_kind()
    total = F.col("o_totalprice")
    cells = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("_ingest_symbol"),
        F.when(F.col("o_orderstatus") != "P", quarter_text(F.col("o_orderdate")))
        .otherwise("TTM")
        .alias("Quarter"),
        magnitude_text(total, kind).alias("total_revenue"),
        magnitude_text(total * 2, F.lit(1)).alias("net_income"),
        F.concat(
            F.when(kind == 2, MINUS_SIGN).otherwise(""),
            F.col("o_custkey").cast("string"),
            F.lit(".25"),
        ).alias("eps"),
        magnitude_text(total, kind % 5 + 1).alias("operating_expense"),
        magnitude_text(total, F.lit(2)).alias("total_assets"),
        F.lit("n/a").alias("total_liabilities"),
        F.when(kind != 3, magnitude_text(total, kind)).alias("free_cash_flow"),
        F.col("o_orderkey").alias("_meta_order"),
        F.col("o_orderdate").alias("_meta_loaded"),
    )
    return bronze_table(
        cells,
        F.concat(F.lit("finances/"), F.col("_meta_order").cast("string")),
        F.col("_meta_loaded"),
    )


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed statements per customer and quarter, summed over orders."""
    day = F.col("o_orderdate")
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    status = F.col("o_orderstatus")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"),
            F.to_date(F.date_trunc("quarter", day)).alias("quarter"),
        )
        .agg(
            F.sum(F.when(status != "P", amount)).cast("double").alias("total_revenue"),
            F.sum(F.when(status == "F", amount)).cast("double").alias("gross_profit"),
            F.sum(F.when(status == "O", amount)).cast("double").alias("net_income"),
            F.max(amount).cast("double").alias("eps"),
            F.min(amount).cast("double").alias("operating_expense"),
            F.sum(amount).cast("double").alias("total_assets"),
            F.sum(F.when(status == "P", amount)).cast("double").alias("total_liabilities"),
            F.count("*").cast("double").alias("free_cash_flow"),
        )
    )
