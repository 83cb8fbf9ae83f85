"""Dense ids 1..n in name order, without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.session import scratch_path


# ``monotonically_increasing_id`` counts the rows of a task in its lower 33 bits.
_COUNT_BITS = 33


def dense_ids(
    names: DataFrame, column: str | Sequence[str], id_name: str, kind: str = "int"
) -> DataFrame:
    """Number distinct names from 1 in their order, by one column or several.

    The names are cut into ranges of even size, one per shuffle partition, sorted
    and stored with their range and their place in it, so that both stay as they
    are when a task is repeated. Places are shifted by the number of names before
    their range; the stored rows are not shuffled again.
    """
    order = [column] if isinstance(column, str) else list(column)
    spark = names.sparkSession
    path = scratch_path(spark, "dense-ids")
    cut = names.repartitionByRange(*order).sortWithinPartitions(*order)
    cut.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    schema = T.StructType([*names.schema.fields, T.StructField("_at", T.LongType())])
    ranged = spark.read.schema(schema).parquet(path).withColumns(
        {
            "_range": F.shiftright("_at", _COUNT_BITS),
            "_place": F.col("_at").bitwiseAND((1 << _COUNT_BITS) - 1) + 1,
        }
    )
    # One row per range, so at most one per shuffle partition.
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(id_name, (F.col("_offset") + F.col("_place")).cast(kind))
        .select(*names.columns, id_name)
    )
