"""Tick stream: JSON messages to a typed, day-partitioned table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quotelake.functions.calendar import iso_time
from quotelake.operators.incremental import write_partitions
from quotelake.schemas import TICK_MESSAGE
from quotelake.session import scratch_path

MALFORMED = "_malformed"
BATCH = "batch_id"

# The table under its partition columns; `trade_date` is the UTC day of `time`.
TICK_TABLE = T.StructType(
    [
        T.StructField("time", T.TimestampType()) if f.name == "timestamp" else f
        for f in TICK_MESSAGE.fields
    ]
    + [T.StructField(BATCH, T.LongType()), T.StructField("trade_date", T.DateType())]
)


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str
) -> DataFrame:
    """Messages of a topic as (key, value). Needs Spark's Kafka package on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load().select("key", "value")


def file_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """One message per line of the text files arriving in a folder."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def keyed_messages(rows: DataFrame, key: str = "ticker") -> DataFrame:
    """Rows as (key, value) messages; equal keys go to one topic partition, in order."""
    return rows.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value")
    )


def decode_ticks(messages: DataFrame) -> DataFrame:
    """Typed ticks; a message that is no valid tick keeps its text in ``_malformed``.

    That is a message that is not JSON, or one without a ticker or a readable
    time: what a reject table stores can be decoded again.
    """
    text = F.col("value").cast("string")
    bad = "_corrupt"
    with_bad = T.StructType([*TICK_MESSAGE.fields, T.StructField(bad, T.StringType())])
    data = F.from_json(text, with_bad, {"columnNameOfCorruptRecord": bad})
    rows = messages.select(text.alias("_text"), data.alias("data")).select("_text", "data.*")
    timed = rows.withColumnRenamed("timestamp", "time").withColumn("time", iso_time(F.col("time")))
    usable = F.col(bad).isNull() & F.col("ticker").isNotNull() & F.col("time").isNotNull()
    return timed.withColumn(MALFORMED, F.when(~usable, F.col("_text"))).drop("_text", bad)


def valid_ticks(decoded: DataFrame) -> DataFrame:
    """Decoded ticks that have a ticker and a time."""
    return decoded.filter(
        F.col(MALFORMED).isNull() & F.col("ticker").isNotNull() & F.col("time").isNotNull()
    ).drop(MALFORMED)


def tick_sink(table: str, rejected: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that keeps good ticks and rejected messages apart.

    Ticks go to a folder per day and batch, which a repeated batch replaces: after
    a failure a batch comes again with the same messages, so the table stays as it
    was. Errors are raised: the stream stops and the checkpoint does not move past
    an unwritten batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        good = (
            F.col(MALFORMED).isNull() & F.col("ticker").isNotNull() & F.col("time").isNotNull()
        )
        batch = batch.persist()
        try:
            (
                batch.filter(good)
                .drop(MALFORMED)
                .withColumn("trade_date", F.to_date("time"))
                .withColumn(BATCH, F.lit(batch_id).cast("bigint"))
                .hint("rebalance", "trade_date")
                .sortWithinPartitions("trade_date", "ticker", "time")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("trade_date", BATCH)
                .parquet(_open(table))
            )
            (
                batch.filter(~good)
                .write.mode("overwrite")
                .parquet(f"{rejected.rstrip('/')}/{BATCH}={batch_id}")
            )
        finally:
            batch.unpersist()

    return write


def jdbc_sink(url: str, table: str, properties: dict[str, str]) -> Callable[[DataFrame, int], None]:
    """A batch writer into a database table that has a ``batch_id`` column.

    The id lets readers drop what a repeated batch wrote twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = valid_ticks(batch).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        rows.write.option("batchsize", "5000").jdbc(
            url, table, mode="append", properties=properties
        )

    return write


def start_tick_stream(
    decoded: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = "10 seconds",
    delay: str = "1 hour",
) -> StreamingQuery:
    """Run the sink on each batch; ``every=None`` takes all that is there and stops.

    The watermark, ``delay`` behind the newest tick, drops nothing; it tells which
    days can be closed.
    """
    writer = (
        decoded.withWatermark("time", delay).writeStream.outputMode("append")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def _open(table: str) -> str:
    return f"{table.rstrip('/')}/open"


def _closed(table: str) -> str:
    return f"{table.rstrip('/')}/closed"


def _days(spark: SparkSession, folder: str) -> list[date]:
    """Days that have a folder, by their names alone."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    names = [status.getPath().getName() for status in store.listStatus(path)]
    return sorted(date.fromisoformat(n.split("=")[1]) for n in names if n.startswith("trade_date="))


def _read_days(spark: SparkSession, folder: str, days: Sequence[date]) -> DataFrame:
    """The rows of some days; only their folders are listed."""
    if not days:
        return spark.createDataFrame([], TICK_TABLE)
    paths = [f"{folder}/trade_date={day}" for day in days]
    return spark.read.schema(TICK_TABLE).option("basePath", folder).parquet(*paths)


def _together(spark: SparkSession, table: str, opened: Sequence[date], closed: Sequence[date]):
    """Rows of open and closed days, each batch once.

    A batch of a day is in both only after a run of ``close_days`` broke off, or when
    a batch was repeated after its day had been closed.
    """
    rows = _read_days(spark, _open(table), opened)
    both = sorted(set(opened) & set(closed))
    if both:
        known = _read_days(spark, _closed(table), both).select("trade_date", BATCH).distinct()
        rows = rows.join(known, ["trade_date", BATCH], "left_anti").select(*rows.columns)
    return _read_days(spark, _closed(table), closed).unionByName(rows)


def read_ticks(spark: SparkSession, table: str) -> DataFrame:
    """All ticks."""
    return _together(spark, table, _days(spark, _open(table)), _days(spark, _closed(table)))


def read_ticks_of(spark: SparkSession, table: str, day: date) -> DataFrame:
    """The ticks of one day; folders of other days are not listed."""
    opened = [day] if day in _days(spark, _open(table)) else []
    closed = [day] if day in _days(spark, _closed(table)) else []
    return _together(spark, table, opened, closed)


def watermark_day(stream: StreamingQuery) -> date | None:
    """The day of the stream's watermark: no tick before it is expected any more."""
    progress = stream.lastProgress
    mark = ((progress or {}).get("eventTime") or {}).get("watermark")
    return datetime.fromisoformat(mark.replace("Z", "+00:00")).date() if mark else None


def close_days(spark: SparkSession, table: str, before: date) -> list[date]:
    """Turn the batch folders of the days before ``before`` into one folder a day.

    Ticks that come later for a closed day are taken in by the next run. A run that
    broke off is repeated without doubling ticks: a closed day knows its batches,
    and batch folders are deleted only after they have been written. Only folders
    seen at the start are deleted.
    """
    days = [day for day in _days(spark, _open(table)) if day < before]
    if not days:
        return []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for day in days:
        path = hadoop.Path(f"{_open(table)}/trade_date={day}")
        store = path.getFileSystem(settings)
        seen += [status.getPath().toString() for status in store.listStatus(path)]
    closed = sorted(set(days) & set(_days(spark, _closed(table))))
    listed = spark.read.schema(TICK_TABLE).option("basePath", _open(table)).parquet(*seen)
    rows = listed
    if closed:
        known = _read_days(spark, _closed(table), closed)
        pairs = known.select("trade_date", BATCH).distinct()
        rows = rows.join(pairs, ["trade_date", BATCH], "left_anti").select(*listed.columns)
        rows = rows.unionByName(known)
    staged = scratch_path(spark, "closing")
    rows.write.parquet(staged)
    write_partitions(
        spark.read.schema(rows.schema).parquet(staged),
        _closed(table),
        "trade_date",
        ["ticker", "time"],
    )
    for name in seen:
        path = hadoop.Path(name)
        path.getFileSystem(settings).delete(path, True)
    for day in days:
        path = hadoop.Path(f"{_open(table)}/trade_date={day}")
        store = path.getFileSystem(settings)
        if not store.listStatus(path):
            store.delete(path, False)
    return days
