"""Ids that go on after the greatest one given, and stay with their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.operators.dense_ids import dense_ids
from quotelake.operators.incremental import without_keys
from quotelake.operators.latest import latest_by

BATCH = "batch_id"


def continue_ids(
    rows: DataFrame, order: Sequence[str], id_name: str, known: DataFrame, kind: str = "bigint"
) -> DataFrame:
    """Rows numbered in the order of some columns, after the greatest id in ``known``.

    Rows are cut into ranges that are numbered apart, so no task sees them all;
    ranges are stored, so a repeated task gives the same ids.
    """
    if id_name in rows.columns:
        raise ValueError(f"the rows have a column {id_name} already")
    placed = dense_ids(rows, order, "_id", "bigint")
    greatest = known.agg(F.coalesce(F.max(id_name).cast("bigint"), F.lit(0))).scalar()
    return placed.select(*rows.columns, (F.col("_id") + greatest).cast(kind).alias(id_name))


def _latest_unknown(
    rows: DataFrame, known: DataFrame, keys: Sequence[str], latest: Sequence[str]
) -> DataFrame:
    """The latest row of every key that ``known`` does not hold; null keys are equal.

    Known keys go along as the greatest rows of their keys, so that one shuffle serves both.
    """
    marked = rows.withColumn("_known", F.lit(False)).unionByName(
        known.select(*keys).withColumn("_known", F.lit(True)), allowMissingColumns=True
    )
    return latest_by(marked, keys, ["_known", *latest]).filter(~F.col("_known")).drop("_known")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches of a table under its schema, with their ``batch_id``; none if it is new."""
    whole = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(path)


def append_batch(
    path: str,
    batch_id: int,
    rows: DataFrame,
    schema: T.StructType,
    id_name: str,
    order: Sequence[str],
    keys: Sequence[str] = (),
    latest: Sequence[str] = (),
) -> DataFrame:
    """Append rows as one batch of a table and give the table up to that batch.

    Ids go on after those of earlier batches. With ``keys`` a key is stored once:
    of the rows of a key the latest by ``latest`` counts, and keys that an earlier
    batch holds are left alone; null keys are equal. A batch that is repeated
    replaces itself and numbers the same rows alike. Columns that rows lack are null.
    """
    spark = rows.sparkSession
    earlier = read_batches(spark, path, schema).filter(F.col(BATCH) < batch_id)
    absent = [f for f in schema.fields if f.name not in rows.columns and f.name != id_name]
    filled = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
    if keys and latest:
        filled = _latest_unknown(filled, earlier, keys, latest)
    elif keys:
        filled = without_keys(filled.dropDuplicates(list(keys)), earlier, keys)
    numbered = continue_ids(filled, order, id_name, earlier, schema[id_name].dataType.simpleString())
    typed = numbered.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    typed.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}")
    table = read_batches(spark, path, schema)
    return table.filter(F.col(BATCH) <= batch_id).drop(BATCH)
