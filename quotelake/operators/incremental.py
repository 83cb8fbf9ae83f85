"""Incremental loads: high-watermark filters, merges, schema sync, retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.operators.latest import latest_by
from quotelake.operators.ranges import Clock, moment
from quotelake.session import scratch_path

# Fixed value: the watermark of an empty target.
BEGINNING = "1900-01-01"

# Folder of an archived day that holds the rows of one source file.
ARCHIVED_FILE = "archived_file"


def newer_than_target(updates: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Updates past the target's greatest ``column``.

    The greatest value is a scalar subquery: Spark runs it first and uses the
    result to skip partitions and row groups of ``updates``.
    """
    kind = updates.schema[column].dataType
    highest = target.select(
        F.coalesce(F.max(column).cast(kind), F.lit(BEGINNING).cast(kind)).alias("highest")
    )
    return updates.filter(F.col(column) > highest.scalar())


def latest_day_only(df: DataFrame, column: str) -> DataFrame:
    """Rows of the last calendar day found in ``column``."""
    kind = df.schema[column].dataType
    last = F.to_date(F.max(column))
    first = df.select(last.cast(kind).alias("first")).scalar()
    end = df.select(F.date_add(last, 1).cast(kind).alias("end")).scalar()
    return df.filter((F.col(column) >= first) & (F.col(column) < end))


def merge_upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Target with whole rows replaced or added by key.

    With ``order`` the updates may hold several rows per key; the latest wins.
    """
    source = latest_by(updates, keys, order) if order else updates
    return without_keys(target, source, keys).unionByName(source.select(target.columns))


def without_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the source does not hold; null keys are equal."""
    named = source.select(*[F.col(k).alias(f"_key_{k}") for k in keys])
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    )
    return target.join(named, same, "left_anti")


def merge_columns(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    columns: Sequence[str],
    insert: bool = True,
    order: Sequence[str] = (),
) -> DataFrame:
    """Target with ``columns`` set from the matching update.

    An update sets its value even when that is null. With ``insert`` unmatched
    updates become new rows, whose other columns are null. Null keys are equal.
    """
    source = latest_by(updates, [key], order) if order else updates
    source = source.select(
        F.col(key).alias("_key"),
        F.lit(True).alias("_hit"),
        *[F.col(c).alias(f"_new_{c}") for c in columns],
    )
    joined = target.join(
        source,
        target[key].eqNullSafe(source["_key"]),
        "full_outer" if insert else "left_outer",
    )
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    fields = []
    for field in target.schema.fields:
        name = field.name
        if name == key:
            value = F.coalesce(F.col(name), F.col("_key"))
        elif name in columns:
            value = F.when(hit, F.col(f"_new_{name}")).otherwise(F.col(name))
        else:
            value = F.col(name)
        fields.append(value.cast(field.dataType).alias(name))
    return joined.select(*fields)


def sync_schema(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Both tables under the updates' columns: new ones added, removed ones dropped."""
    return target.unionByName(updates, allowMissingColumns=True).select(updates.columns)


def _archive_limit(df: DataFrame, column: str, as_of: Clock, days: int):
    return moment(df, column, as_of, lambda now: F.date_sub(now.cast("date"), days))


def archive_due(df: DataFrame, column: str, as_of: Clock, days: int) -> DataFrame:
    """Rows with ``due``: whether they lie more than ``days`` back."""
    limit = _archive_limit(df, column, as_of, days)
    return df.withColumn("due", F.coalesce(F.col(column) < limit, F.lit(False)))


def split_retention(
    df: DataFrame, column: str, as_of: Clock, days: int
) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, rows to archive): archived rows lie more than ``days`` back."""
    limit, stamp = _archive_limit(df, column, as_of, days), F.col(column)
    return df.filter((stamp >= limit) | stamp.isNull()), df.filter(stamp < limit)


def upsert_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    partition: str,
    order: Sequence[str] = (),
) -> None:
    """Merge updates into a parquet table partitioned by a key column.

    A row never leaves its partition because ``partition`` is part of the key,
    so only the partitions the updates touch are read and rewritten: a semi join
    picks them, rows without a partition value apart. Null keys are equal. The
    table is read under the updates' types, so partition values such as ``01``
    stay text, and gets the updates' new columns; columns the updates lack are
    null in their rows. Updates and merged rows are staged in the shared folder:
    the updates are computed once, and the table is never read while it is being
    replaced.
    """
    if partition not in keys:
        raise ValueError(f"{partition} has to be one of the keys {list(keys)}")
    arriving = scratch_path(spark, "updates")
    updates.write.parquet(arriving)
    updates = spark.read.parquet(arriving)
    target = _read_as(spark, path, updates.schema)
    named = updates.select(partition).distinct()
    unnamed = named.agg(F.coalesce(F.max(F.col(partition).isNull()), F.lit(False))).scalar()
    touched = target.join(named, partition, "left_semi").select(*target.columns).unionByName(
        target.filter(F.col(partition).isNull() & unnamed)
    )
    source = latest_by(updates, keys, order) if order else updates
    merged = without_keys(touched, source, keys).unionByName(source, allowMissingColumns=True)
    staged = scratch_path(spark, "merge")
    merged.write.parquet(staged)
    write_partitions(spark.read.schema(merged.schema).parquet(staged), path, partition)


def _read_as(spark: SparkSession, path: str, wanted: T.StructType) -> DataFrame:
    """A parquet table under wanted types; columns only one side has are kept."""
    stored = spark.read.option("mergeSchema", True).parquet(path).schema
    names = set(wanted.names)
    extra = [f for f in stored.fields if f.name not in names]
    return spark.read.schema(T.StructType([*wanted.fields, *extra])).parquet(path)


def write_partitions(
    df: DataFrame, path: str, partition: str, sort: Sequence[str] = ()
) -> None:
    """Replace exactly the partitions present in ``df``.

    Rows are spread by partition value through AQE's rebalance, which splits a
    large partition over several tasks and files. Sorting inside files lets
    readers skip row groups by their minimum and maximum.
    """
    spread = df.hint("rebalance", partition)
    if sort:
        spread = spread.sortWithinPartitions(partition, *sort)
    (
        spread.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def archive_table(
    spark: SparkSession,
    path: str,
    archive_path: str,
    partition: str,
    as_of: date | str,
    days: int,
) -> int:
    """Move the day partitions more than ``days`` before ``as_of`` to the archive.

    ``partition`` is the DATE the table is partitioned by, so whole partitions
    expire at once and nothing that stays is rewritten. The archive has a folder
    per day and source file: a run that broke off before the files were deleted is
    repeated without doubling rows, on whatever day. Just the files that were
    copied are deleted, so rows that arrive meanwhile wait for the next run. Gives
    the number of partitions moved.
    """
    _, expired = split_retention(spark.read.parquet(path), partition, as_of, days)
    expired = expired.withColumn("_path", F.col("_metadata.file_path"))
    copied = expired.withColumn(ARCHIVED_FILE, F.element_at(F.split("_path", "/"), -1))
    listed = scratch_path(spark, "archived")
    expired.select(partition, "_path").distinct().write.parquet(listed)
    files = spark.read.parquet(listed)
    names = files.select(F.col("_path").alias("_listed"))
    (
        # Only listed files are copied: a file that came since the listing stays.
        copied.join(names, F.col("_path") == F.col("_listed"), "left_semi")
        .drop("_path")
        .hint("rebalance", partition, ARCHIVED_FILE)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition, ARCHIVED_FILE)
        .parquet(archive_path)
    )
    moved = files.select(partition).distinct().count()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    for row in files.select("_path").toLocalIterator():
        name = hadoop.Path(spark.sparkContext._jvm.java.net.URI.create(row[0]))
        name.getFileSystem(settings).delete(name, False)
    return moved
