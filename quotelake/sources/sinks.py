"""Writing results: views, whole tables, incremental tables, reclustering."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.operators.incremental import merge_upsert, sync_schema
from quotelake.session import scratch_path

VIEW, TABLE, INCREMENTAL = "view", "table", "incremental"


def materialize(
    df: DataFrame, name: str, mode: str, keys: Sequence[str] = (), order: Sequence[str] = ()
) -> DataFrame:
    """Publish a result under a name and give it back as a table.

    ``incremental`` merges into an existing table by key, after bringing both to
    the result's columns. The merged rows are staged first, because a table
    cannot be read while it is overwritten. For tables that are large against
    their updates, use ``incremental.upsert_table``, which rewrites only touched
    partitions.
    """
    spark = df.sparkSession
    if mode == VIEW:
        df.createOrReplaceTempView(name)
    elif mode == TABLE or not spark.catalog.tableExists(name):
        df.write.mode("overwrite").saveAsTable(name)
    elif mode == INCREMENTAL:
        target = sync_schema(spark.table(name), df.limit(0))
        staged = scratch_path(spark, name)
        merge_upsert(target, df, keys, order).write.parquet(staged)
        spark.read.parquet(staged).write.mode("overwrite").saveAsTable(name)
    else:
        raise ValueError(f"unknown mode {mode}")
    return spark.table(name)


def write_ticks(ticks: DataFrame, path: str) -> None:
    """Append ticks to a table with one folder per day."""
    (
        ticks.withColumn("trade_date", F.to_date("time"))
        .hint("rebalance", "trade_date")
        .sortWithinPartitions("trade_date", "ticker", "time")
        .write.mode("append")
        .partitionBy("trade_date")
        .parquet(path)
    )


def recluster(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Rewrite in the order of ``columns`` so that readers can skip row groups."""
    df.repartitionByRange(*columns).sortWithinPartitions(*columns).write.parquet(path)


def key_buckets(spark: SparkSession) -> int:
    """The buckets ``store_by_key`` writes under the session's settings."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def store_by_key(
    df: DataFrame, path: str, key: str, sort: Sequence[str], together: bool = False
) -> DataFrame:
    """Store rows in buckets of a key, sorted along it, and read them back.

    What groups, joins or orders by the key then needs no shuffle. A bucket is one
    file, written by one task; there are as many as shuffle partitions. The table's
    name is needed only while it is written and read; its files stay at ``path``.
    ``together`` says that the rows of a key are in one task already, as after a
    window over the key, so that they need not be shuffled for it.
    """
    spark, buckets = df.sparkSession, key_buckets(df.sparkSession)
    name = f"by_key_{uuid.uuid4().hex}"
    rows = df if together else df.repartition(buckets, key)
    try:
        (
            rows.write.bucketBy(buckets, key)
            .sortBy(key, *sort)
            .option("path", path)
            .saveAsTable(name)
        )
        return spark.table(name)
    finally:
        # The table is external: this drops its name, not its files.
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def read_by_key(
    spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int
) -> DataFrame:
    """The rows that ``store_by_key`` left at a path in this number of buckets."""
    name = f"by_key_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    try:
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet"
            f" CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
