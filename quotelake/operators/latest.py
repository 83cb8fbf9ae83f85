"""Latest row per key, top rows per key, and top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The greatest row of every key by ``order``; other columns break ties.

    Written as one ``max`` over a struct, so each map task sends at most one
    row per key and a hot key costs no more than any other.
    """
    return _extreme(df, keys, order, F.max)


def earliest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The smallest row of every key by ``order``; other columns break ties."""
    return _extreme(df, keys, order, F.min)


def _extreme(df, keys, order, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(pick(F.struct(*order, *rest)).alias("_row"))
    return picked.select(
        *[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns]
    )


def latest_of_few(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], along: str | None = None
) -> DataFrame:
    """As ``latest_by`` for keys that hardly repeat, such as (symbol, day).

    Combining in the map tasks would save nothing there, so rows are shuffled once
    by key and sorted once. With ``along``, one of the keys, they are shuffled by
    that alone: series along it need no further shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = Window.partitionBy(*keys).orderBy(F.struct(*order, *rest).desc())
    return (
        df.repartition(*([along] if along else keys))
        .withColumn("_place", F.row_number().over(ranked))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def latest_unordered(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """As ``latest_by`` for rows that hold values without an order, such as VARIANT.

    ``order`` has to settle ties by itself. Spark drops all but the first row
    per key in each map task before the shuffle.
    """
    ranked = Window.partitionBy(*keys).orderBy(
        *[(F.col(o) if isinstance(o, str) else o).desc() for o in order]
    )
    return (
        df.withColumn("_place", F.row_number().over(ranked))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def first_rows_per(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int
) -> DataFrame:
    """The first ``n`` rows of every key. Map tasks send at most ``n`` rows per key."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_place", F.row_number().over(ranked))
        .filter(F.col("_place") <= n)
        .drop("_place")
    )


def top_rows(df: DataFrame, measure: str | Column, tie: str, n: int, ascending: bool = False):
    """A top-``n`` report; ``tie`` makes the cut repeatable. Nulls come last."""
    column = F.col(measure) if isinstance(measure, str) else measure
    first = column.asc_nulls_last() if ascending else column.desc_nulls_last()
    return df.orderBy(first, F.col(tie)).limit(n)
