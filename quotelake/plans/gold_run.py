"""Batch runs of the gold facts that carry their state from run to run.

A run reads the prices past the last run's newest day, and of everything before
only its state: the last rows per symbol and the last day per index. It writes
its rows and the new state to folders of its own batch id and, last of all, notes
itself. A run that broke off noted nothing: it starts again from the state of the
run before and replaces what it had written. A run that has noted itself changes
nothing when it is called again. Cost and state do not grow with the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.operators.latest import latest_by
from quotelake.plans import indices, prices
from quotelake.sources.sinks import key_buckets, read_by_key, store_by_key

BATCH = "batch_id"
ARRIVED, PRICES, CARRY, INDEX, INDEX_CARRY, RUNS = (
    "arrived", "prices", "carry", "index", "index_carry", "runs"
)
_RUN = f"watermark date, {BATCH} bigint, buckets int"
_ALONG = ["trade_date", "data_source"]


def _folder(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _batch(root: str, table: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/{table}/{BATCH}={batch_id}"


def runs(spark: SparkSession, root: str) -> DataFrame:
    """(watermark, batch_id, buckets) of the finished runs.

    The watermark is the newest day so far, the buckets are those of the run's state.
    """
    store, folder = _folder(spark, f"{root.rstrip('/')}/{RUNS}")
    if not store.exists(folder):
        return spark.createDataFrame([], _RUN)
    return spark.read.schema(_RUN).parquet(folder.toString())


def _write(rows: DataFrame, root: str, table: str, batch_id: int) -> DataFrame:
    path = _batch(root, table, batch_id)
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _write_by_symbol(
    rows: DataFrame, root: str, table: str, batch_id: int, together: bool = False
) -> DataFrame:
    path = _batch(root, table, batch_id)
    store, folder = _folder(rows.sparkSession, path)
    store.delete(folder, True)  # what a broken run left
    return store_by_key(rows, path, "symbol", _ALONG, together)


def _carried(spark: SparkSession, root: str, batch_id: int, kinds: T.StructType, buckets):
    path = _batch(root, CARRY, batch_id)
    if buckets is None:  # a run that did not store its state by symbol
        return spark.read.schema(kinds).parquet(path)
    return read_by_key(spark, path, kinds, "symbol", buckets)


def run_gold(
    spark: SparkSession, root: str, batch_id: int, all_prices: DataFrame, members: DataFrame
) -> bool:
    """Add the days of ``all_prices`` past the last run to the facts below ``root``.

    ``batch_id`` grows from run to run. Gives whether there was anything to do: a
    finished run is not done again. Days up to the watermark are taken as loaded.
    """
    last = (
        runs(spark, root)
        .agg(
            F.max(BATCH).alias("last"),
            F.max("watermark").alias("watermark"),
            F.max(F.col(BATCH) == batch_id).alias("done"),
            F.max_by("buckets", BATCH).alias("buckets"),
        )
        .first()
    )
    if last["done"]:
        return False
    before, watermark = last["last"], last["watermark"]
    if before is not None and before > batch_id:
        raise ValueError(f"run {before} has followed run {batch_id}")
    arriving = prices.price_input(all_prices)
    if watermark is not None:
        arriving = arriving.filter(F.col("trade_date") > F.lit(watermark))
    # Facts and state are made from the same rows, whatever the source does meanwhile.
    # Stored by symbol, these need no further shuffle for the facts, state and index.
    arrived = _write_by_symbol(arriving, root, ARRIVED, batch_id)
    slim = arrived.select(*prices.CARRY_COLUMNS)
    if before is None:
        carried, last_days = slim.limit(0), None
    else:
        carried = _carried(spark, root, before, slim.schema, last["buckets"])
        last_days = spark.read.parquet(_batch(root, INDEX_CARRY, before))
    _write(prices.daily_prices_increment(arrived, carried, True), root, PRICES, batch_id)
    _write_by_symbol(prices.next_carry(arrived, carried), root, CARRY, batch_id, together=True)
    days = indices.index_performance(members, arrived, last_days)
    added = _write(days, root, INDEX, batch_id)
    if last_days is not None:
        added = added.select(*last_days.columns).unionByName(last_days)
    _write(
        latest_by(added, ["index_code", "index_name"], ["trade_date"]), root, INDEX_CARRY, batch_id
    )
    newest = arrived.agg(
        F.greatest(F.max("trade_date"), F.lit(watermark).cast("date")).alias("watermark"),
        F.lit(key_buckets(spark)).alias("buckets"),
    )
    _write(newest, root, RUNS, batch_id)
    _forget(spark, root, batch_id, before)
    return True


def _forget(spark: SparkSession, root: str, batch_id: int, before: int | None) -> None:
    """Drop the rows a run started from, and all state but the last two runs'."""
    kept = {f"{BATCH}={i}" for i in (batch_id, before) if i is not None}
    for table in (ARRIVED, CARRY, INDEX_CARRY):
        store, folder = _folder(spark, f"{root.rstrip('/')}/{table}")
        for status in store.listStatus(folder):
            if table == ARRIVED or status.getPath().getName() not in kept:
                store.delete(status.getPath(), True)


def _read(spark: SparkSession, root: str, table: str) -> DataFrame:
    rows = spark.read.parquet(f"{root.rstrip('/')}/{table}")
    finished = runs(spark, root).select(BATCH)
    return rows.join(finished, BATCH, "left_semi").drop(BATCH)


def read_prices(spark: SparkSession, root: str) -> DataFrame:
    """The gold daily fact of all finished runs."""
    return _read(spark, root, PRICES)


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """The index performance of all finished runs."""
    return _read(spark, root, INDEX)
