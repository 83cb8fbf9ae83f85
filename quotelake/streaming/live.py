"""Live statistics over the tick stream, bounded by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def once_per_tick(ticks: DataFrame, delay: str = "5 minutes") -> DataFrame:
    """Ticks without the copies that an at-least-once producer sends again."""
    return ticks.withWatermark("time", delay).dropDuplicatesWithinWatermark(["ticker", "time"])


def rolling_statistics(
    ticks: DataFrame, span: str = "5 minutes", step: str = "1 minute", delay: str | None = "5 minutes"
) -> DataFrame:
    """Tickers, average price and volume of every sliding window.

    The first aggregation makes one row per window and ticker, so a busy ticker
    is summed up in each map task; the second counts those rows, which is an
    exact count of distinct tickers without keeping the tickers as a set. Also
    runs on a batch, with ``delay=None``.
    """
    if delay is not None:
        ticks = ticks.withWatermark("time", delay)
    per_ticker = ticks.groupBy(F.window("time", span, step), "ticker").agg(
        F.count("price").alias("_n"),
        F.sum("price").alias("_price"),
        F.sum("volume").alias("_volume"),
    )
    totals = per_ticker.groupBy("window").agg(
        F.count("*").alias("tickers"),
        F.sum("_price").alias("_price"),
        F.sum("_n").alias("_n"),
        F.sum("_volume").alias("total_volume"),
    )
    return totals.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "tickers",
        F.try_divide(F.col("_price").cast("double"), F.col("_n")).alias("avg_price"),
        "total_volume",
    )


def latest_state(ticks: DataFrame) -> DataFrame:
    """The newest tick of every ticker; state is one row per ticker."""
    rest = [c for c in ticks.columns if c not in ("ticker", "time")]
    newest = ticks.groupBy("ticker").agg(F.max(F.struct("time", *rest)).alias("_row"))
    return newest.select("ticker", "_row.*")


def start_latest_state(
    ticks: DataFrame, checkpoint: str, every: str | None = "10 seconds"
) -> StreamingQuery:
    """Keep the newest tick per ticker in the state store of the checkpoint.

    The state is the table, so nothing is written beside it. A stream that starts
    again from the checkpoint goes on with the state it left.
    """
    writer = (
        latest_state(ticks)
        .writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def read_latest_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The newest row per ticker as of the last finished batch.

    Read from the state store: as many rows as there are tickers, however many
    batches there were.
    """
    state = spark.read.format("statestore").load(checkpoint)
    newest = state.schema["value"].dataType.names[0]
    return state.select("key.ticker", f"value.{newest}.*")
