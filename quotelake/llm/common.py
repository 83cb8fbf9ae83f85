"""Text expressions and staged tables the operators share."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.session import scratch_path

# White space of the contracts: space and the controls 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Texts without wider characters take the fast path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def words(text: Column) -> Column:
    """The words of a text: runs of anything but white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK_RUN, -1), lambda w: w != "")


def held_out(doc_id: Column, remainder: int) -> Column:
    """Whether the CRC of the id, as text, leaves the remainder modulo 5 (null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == remainder, F.lit(False))


def free_prefix(columns: list[str]) -> str:
    """A prefix that no column has: helper columns named with it clash with none."""
    prefix = "__"
    while any(c.startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


_PATHS: dict[str, list[str]] = {}


def staged_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder that ``release`` knows of."""
    path = scratch_path(spark, name)
    _PATHS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete what operators have staged so far; their results must have been written."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _PATHS.pop(spark.sparkContext.applicationId, []):
        folder = hadoop.Path(path)
        folder.getFileSystem(settings).delete(folder, True)


def staged(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = staged_path(spark, name)
    writer = df.write
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def literal_table(values: list, kind: str) -> Column:
    """A bounded flat list as one folded literal of type ``array<kind>``."""
    text = json.dumps(values, separators=(",", ":"))
    return F.from_json(F.lit(text), f"array<{kind}>")
