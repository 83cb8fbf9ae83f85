"""Message shapes: daily bars, tagged points, scraped links and statements."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.text import scraped_value
from quotelake.schemas import STATEMENT_METRICS

# Defaults of a tagged point, and the closing time stamped on a bar.
POINT_DEFAULTS = {"symbol": "UNKNOWN", "exchange": "EGX", "interval": "Daily"}
CLOSING_TIME = "T16:00:00"
BAR_SOURCE = "EODHD"
QUARTERS_KEPT = 8


def bar_messages(
    bars: DataFrame, ingested_at: datetime | Column, exchange: str = POINT_DEFAULTS["exchange"]
) -> DataFrame:
    """Daily bars (symbol, date, prices, volume) as stream messages."""
    adjusted = F.col("close").cast("double")
    if "adjusted_close" in bars.columns:
        adjusted = F.coalesce(F.col("adjusted_close").cast("double"), adjusted)
    stamp = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    return bars.select(
        "symbol",
        F.concat(F.col("date").cast("string"), F.lit(CLOSING_TIME)).alias("datetime"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.col("volume").cast("bigint").alias("volume"),
        adjusted.alias("adjusted_close"),
        F.lit(POINT_DEFAULTS["interval"]).alias("interval"),
        F.lit(exchange).alias("exchange"),
        F.lit(BAR_SOURCE).alias("data_source"),
        F.date_format(stamp.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias(
            "ingestion_timestamp"
        ),
    )


def tagged_points(messages: DataFrame, now: datetime | Column) -> DataFrame:
    """Messages as points with defaults; an unreadable time becomes ``now``."""
    stamp = (now if isinstance(now, Column) else F.lit(now)).cast("timestamp")

    def value(name: str, kind: str, default: object) -> Column:
        if name not in messages.columns:
            return F.lit(default).cast(kind).alias(name)
        return F.coalesce(F.col(name).cast(kind), F.lit(default).cast(kind)).alias(name)

    return messages.select(
        *[value(name, "string", default) for name, default in POINT_DEFAULTS.items()],
        *[value(name, "double", 0) for name in ("open", "high", "low", "close")],
        value("volume", "bigint", 0),
        F.coalesce(F.try_to_timestamp(F.col("datetime")), stamp).alias("time"),
    )


def field_rows(points: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Points in long form: (symbol, time, field, value)."""
    return points.unpivot(
        ["symbol", "time"],
        [F.col(f).cast("double").alias(f) for f in fields],
        "field",
        "value",
    )


def first_links(links: DataFrame) -> DataFrame:
    """The first row of every URL by its position on the page."""
    first = links.groupBy("url").agg(F.min(F.struct("position", "text")).alias("_row"))
    return first.select("_row.position", "_row.text", "url")


def statement_rows(
    scraped: DataFrame, keys: Sequence[str], metrics: Sequence[str] = STATEMENT_METRICS
) -> DataFrame:
    """One row per quarter from arrays of quarters and of metric values.

    The last eight quarters are kept; a metric list longer than that loses its
    last element, a trailing total. Missing metrics give null.
    """
    quarters = F.filter("quarters", lambda q: q.contains("Q"))
    # slice() refuses to start before the first element.
    start = F.greatest(F.size(quarters) - QUARTERS_KEPT + 1, F.lit(1))
    kept = scraped.withColumn("_quarters", F.slice(quarters, start, QUARTERS_KEPT))
    trimmed = []
    for name in metrics:
        values = F.transform(name, lambda v: scraped_value(v))
        longer = F.size(values) > F.size("_quarters")
        trimmed.append(
            F.when(longer, F.slice(values, F.lit(1), F.size(values) - 1))
            .otherwise(values)
            .alias(f"_{name}")
        )
    rows = kept.select(*keys, "_quarters", *trimmed).select(
        *keys, F.posexplode("_quarters").alias("_i", "quarter"), *[f"_{m}" for m in metrics]
    )
    return rows.select(
        *keys,
        "quarter",
        *[F.get(F.col(f"_{name}"), F.col("_i")).alias(name) for name in metrics],
    )
