"""Ordered calculations along a time series: previous value, trailing averages.

A daily series has one row per key and day, so its length is bounded by the
calendar and one window per key is the cheapest plan. A tick series has no such
bound: one key, or one hour of it, may hold a large share of all rows. Such a
series is cut into slices that run as separate tasks, and ``with_lookback`` hands
each slice the few earlier rows it needs, so results equal those of the uncut
window. ``range_slices`` makes slices of even size whatever the skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.session import scratch_path

SLICE = "_slice"
CARRIED = "_carried"


def range_slices(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None
) -> DataFrame:
    """The rows with a slice number, each slice an even share of all rows.

    Spark samples (keys, order) and sends each range of it to one task, so a key
    with a third of all rows gets a third of the slices and small keys share one.
    The rows are written to the shared folder: all later steps then see the same
    slices, also when a lost task is run again.
    """
    spark = df.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "slices")
    ranged = df.repartitionByRange(slices, *keys, *order)
    ranged.withColumn(SLICE, F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def with_lookback(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_of: Column | None, rows: int
) -> DataFrame:
    """Rows of ``df`` with their slice, plus the ``rows`` rows before each slice.

    ``slice_of`` has to grow with ``order``, e.g. the hour of the tick; without
    it the slices are made by ``range_slices``. Added rows carry the slice they
    serve and ``_carried`` true; the caller drops them after its window over
    ``(keys, _slice)``.

    Only the last ``rows`` rows of each slice are looked at for this, and map
    tasks send no more than that. What is gathered per key is ``rows`` times the
    number of its slices.
    """
    columns = df.columns
    if slice_of is None:
        sliced = range_slices(df, keys, order)
    else:
        sliced = df.withColumn(SLICE, slice_of)
    backwards = Window.partitionBy(*keys, SLICE).orderBy(*[F.col(o).desc() for o in order])
    tails = (
        sliced.withColumn("_back", F.row_number().over(backwards))
        .filter(F.col("_back") <= rows)
        .drop("_back")
    )
    forwards = Window.partitionBy(*keys).orderBy(*order)
    carried = (
        tails.withColumn("_before", F.lag(SLICE).over(forwards))
        .withColumn(
            "_rows",
            F.collect_list(F.struct(*columns)).over(forwards.rowsBetween(-rows, -1)),
        )
        .filter(F.col("_before") != F.col(SLICE))
        .select(SLICE, F.explode("_rows").alias("_row"))
        .select("_row.*", SLICE)
        .withColumn(CARRIED, F.lit(True))
    )
    return sliced.withColumn(CARRIED, F.lit(False)).unionByName(carried)


def drop_carried(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(CARRIED)).drop(CARRIED, SLICE)


def consecutive_difference(
    df: DataFrame, key: str, order: Sequence[str], value: str, slice_of: Column | None = None
) -> DataFrame:
    """Each value minus the one before it; the first row of a key is left out."""
    rows = with_lookback(df, [key], order, slice_of, rows=1)
    along = Window.partitionBy(key, SLICE).orderBy(*order)
    return (
        drop_carried(rows.withColumn("difference", F.col(value) - F.lag(value).over(along)))
        .filter(F.col("difference").isNotNull())
    )


def last_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows of every key, e.g. what the next incremental run needs."""
    backwards = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order])
    return (
        df.withColumn("_back", F.row_number().over(backwards))
        .filter(F.col("_back") <= n)
        .drop("_back")
    )
